"""Helpers shared by the training-data operators.

Python workers receive Arrow batches and are given whole texts; a batch is
worked on in slices of bounded characters, so memory does not follow the batch
size. Fitted objects reach the workers through broadcasts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampwise.session import own_path, remove_own, stored  # noqa: F401

#: Characters that a worker handles at once; one longer text is a slice of its own.
SLICE_CHARS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def crc_mod(col: str, m: int):
    """crc32 of the id's decimal text, modulo ``m`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(m)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with at most ``limit`` bytes of text (or one row)."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, lo = np.cumsum(sizes), 0
    while lo < n:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


#: Rows of an Arrow batch, where the session keeps Spark's default of ten thousand.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let batches of texts take a few megabytes in the JVM and in the worker; a session's own
    setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def append_columns(df: DataFrame, text: str, fields: list[tuple[str, str]],
                   make: Callable[[], Callable[[list], dict]], arrow_texts: bool = False, limit: int = SLICE_CHARS) -> DataFrame:
    """Add columns computed from the texts: ``make()`` runs in the worker and returns
    a function from a list of texts (None allowed) to ``{field: values}``; with ``arrow_texts``
    from the Arrow column to Arrow arrays.
    Incoming columns named like a new field (in any case) are replaced by it."""
    small_batches(df.sparkSession)
    new = {n.lower() for n, _ in fields}
    kept = [c for c in df.columns if c.lower() not in new or c == text]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    arrow = {n: arrow_type(t) for n, t in fields}

    def run(batches):
        fn = make()
        for batch in batches:
            for part in slices(batch, text, limit):
                got = fn(part.column(text) if arrow_texts else part.column(text).to_pylist())
                cols = [part.column(c) for c in kept] + [got[n].cast(t) if arrow_texts else pa.array(got[n], t) for n, t in arrow.items()]
                yield pa.RecordBatch.from_arrays(cols, names=kept + list(arrow))
        pa.default_memory_pool().release_unused()  # a worker lives on after its task

    return df.select(*kept).mapInArrow(run, schema)


def arrow_type(ddl: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(T._parse_datatype_string(ddl))


def range_bounds(df: DataFrame, key: str, buckets: int) -> list[int]:
    """At most ``buckets`` ascending lower bounds of an integer key, the first being its
    minimum. Bounds are values that occur. The list has one entry per bucket, so its
    size follows the number of partitions, not of rows."""
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.min(key).alias("lo"),
                 (F.percentile_approx(key, shares, 10 * buckets) if shares else F.array().cast("array<bigint>")).alias("qs")).first()
    if row is None or row["lo"] is None:
        return []
    return sorted({int(row["lo"]), *(int(q) for q in (row["qs"] or []))})


def n_buckets(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_bytes(spark: SparkSession, name: str, data: bytes) -> str:
    """One file below the shared folder, on whatever file system that is; returns its path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{own_path(spark, 'file')}/{name}")
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(data))
    out.close()
    return at.toString()


def hash_sample(df: DataFrame, rows: int, key) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with the smallest hash of ``key``. The rows are
    counted first, and a task passes on only those whose hash is small enough for about half
    as many again, so what reaches the driver does not follow the number of tasks."""
    total = df.count()
    h = F.xxhash64(key)
    if total > 2 * rows:
        df = df.where(F.pmod(h, F.lit(1 << 62)) < F.lit(int((1 << 62) * min(1.0, 1.5 * rows / total + 100 / total))))
    return df.orderBy(F.pmod(h, F.lit(1 << 62)), key).limit(rows)


#: Characters of a text that a model is fitted on, from its beginning.
FITTED_CHARS = 200_000


def one_text(docs: DataFrame, pick: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(id, text, more) of the ids in ``pick``, one row for each id however often it occurs: the
    smallest text, of which at most ``FITTED_CHARS`` characters are passed on."""
    rows = docs.join(F.broadcast(pick), id_col).where(F.col(text_col).isNotNull())
    first = rows.groupBy(id_col).agg(F.min(F.struct(F.substring(text_col, 1, FITTED_CHARS).alias("_t"), *more)).alias("_r"))
    return first.select(id_col, "_r._t", *[f"_r.{c}" for c in more])


def distinct_sample(df: DataFrame, rows: int, key: str) -> DataFrame:
    """At most ``rows`` distinct values of ``key``, those with the smallest hash, each once however
    many copies it has. Their number is estimated first (a sketch), so that tasks pass on few."""
    total = df.agg(F.approx_count_distinct(key, 0.02)).first()[0]
    h = F.pmod(F.xxhash64(key), F.lit(1 << 62))
    if total > 2 * rows:
        df = df.where(h < F.lit(int((1 << 62) * min(1.0, 1.6 * rows / total + 100 / total))))
    return df.select(key).distinct().orderBy(h, key).limit(rows)


def labelled_sample(docs: DataFrame, labelled: DataFrame, target: str, rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most ``rows`` labelled rows, taken in the order of a hash of the id, as
    (text, label) on the driver, one for an id (:func:`one_text`). ``labelled`` has ``id_col`` and
    ``target``."""
    rows_ = labelled.where(F.col(target).isNotNull() & F.col(id_col).isNotNull()).select(id_col, F.col(target).cast("int").alias("_y"))
    pick = hash_sample(rows_, rows, F.col(id_col).cast("string"))
    got = one_text(docs.select(id_col, F.col(text_col).alias("_text")), pick, id_col, "_text", "_y")
    return [(r["_t"], r["_y"]) for r in got.orderBy(id_col).select("_t", "_y").collect()]


#: Rows of a two-column table of ids up to which it is broadcast; beyond that it is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def join_ids(big: DataFrame, ids: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join with a narrow table whose rows are counted first: broadcast only if few."""
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return big.join(F.broadcast(ids) if few else ids, on, how)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_1, name_2, ... that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if n.lower() not in taken)
