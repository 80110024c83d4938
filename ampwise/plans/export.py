"""Bulk-index document export.

Each row becomes two lines: an action line naming the index and the JSON
document. Coordinates ``<p>_latitude`` / ``<p>_longitude`` for the prefixes
start, mean and end become one ``<p>_location`` object when both are present
and are dropped as flat fields (F11). Columns keep their types, so numbers are
written as numbers (F10). Empty strings and nulls are left out of a document;
numeric zero is kept (deviation D8).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GEO_PREFIXES = ("start", "mean", "end")
DOCS_PER_FILE = 10_000        # fixed value of the reference: documents per upload file
DOC_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def documents(df: DataFrame, index_name: str, geo_prefixes=GEO_PREFIXES, keep=()) -> DataFrame:
    """K9: ``value`` = action line + newline + document JSON, one row per
    record (``keep`` columns are passed through beside it)."""
    cols, used = [], set()
    for p in geo_prefixes:
        lat, lon = f"{p}_latitude", f"{p}_longitude"
        if lat in df.columns and lon in df.columns:
            used |= {lat, lon}
            la, lo = F.col(lat).cast("double"), F.col(lon).cast("double")
            cols.append((f"{p}_location", F.when(la.isNotNull() & lo.isNotNull(),
                                                 F.struct(la.alias("lat"), lo.alias("lon")))))
    out = []
    for f in df.schema.fields:
        if f.name in used:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit(""))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, DOC_TIMESTAMP_FORMAT)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    out += [c.alias(n) for n, c in cols]
    action = json.dumps({"index": {"_index": index_name, "_type": "doc"}}, separators=(",", ":"))
    doc = F.to_json(F.struct(*out), {"ignoreNullFields": "true"})
    return df.select(*keep, F.concat_ws("\n", F.lit(action), doc).alias("value"))


def write_documents(docs: DataFrame, path: str, per_file: int = DOCS_PER_FILE) -> None:
    """Text files of at most ``per_file`` documents each."""
    docs.write.mode("overwrite").option("maxRecordsPerFile", per_file).text(path)
