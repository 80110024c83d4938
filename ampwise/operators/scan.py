"""Ordered scans over a key's time series that stay parallel under skew.

Many reference operators walk one vehicle's records in time order (previous
value, running counters, last valid value). A plain
``Window.partitionBy("vin").orderBy("ts")`` sends a vehicle's whole history to
one task, which fails when one vehicle holds a large share of the rows.

:func:`ordered_scan` splits each key's sequence into ordered *buckets* (for
example the day, or the hour of the timestamp), runs the window inside
``(key, bucket)`` and then repairs the bucket edges from a small per-bucket
summary (tail row, last non-null values, totals). The summary has one row per
(key, bucket); its cross-bucket window is over buckets, not rows, and it is
joined back on ``(key, bucket)``, which is also how the main side is already
partitioned. With ``bucket=None`` it is a plain per-key window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_scan_bucket"


def scalar(df: DataFrame, agg: Column):
    """Resolve a one-value aggregate to a Python value (one small job); for
    driver-side decisions only. Inside a plan use :func:`scalar_column`."""
    return df.agg(agg.alias("_v")).first()["_v"]


def scalar_column(df: DataFrame, agg: Column) -> Column:
    """A one-value aggregate (e.g. ``max(day)``) as a scalar subquery column:
    evaluated once within the same plan, no one-row table joined to every
    row and no round trip through the driver."""
    return df.agg(agg.alias("_v")).scalar()


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 bucket: Column | str | None = None,
                 lags: Mapping[str, Column | str] | None = None,
                 lasts: Mapping[str, Column | str] | None = None,
                 cums: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Add per-row scan columns in the order of ``order`` within ``keys``.

    * ``lags[name]``: value of the expression on the previous row (null on the
      first row of a key).
    * ``lasts[name]``: last non-null value of the expression on an earlier row.
    * ``cums[name]``: running sum of the expression up to and including the
      row (nulls count as 0).

    ``bucket`` must be non-decreasing along ``order`` within a key (a time
    truncation of the ordering timestamp, for instance).
    """
    lags, lasts, cums = dict(lags or {}), dict(lasts or {}), dict(cums or {})
    keys, order = list(keys), list(order)
    ocols = [F.col(c) for c in order]
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*ocols)
        prev = w.rowsBetween(Window.unboundedPreceding, -1)
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = df
        for n, e in lags.items():
            out = out.withColumn(n, F.lag(_as_col(e)).over(w))
        for n, e in lasts.items():
            out = out.withColumn(n, F.last(_as_col(e), ignorenulls=True).over(prev))
        for n, e in cums.items():
            out = out.withColumn(n, F.sum(F.coalesce(_as_col(e), F.lit(0))).over(run))
        return out

    # Partition on the bucket column itself when it is one: the output then
    # stays hash-partitioned on (keys, bucket), so a following scan, join or
    # aggregation on the same keys needs no new shuffle.
    if isinstance(bucket, str) and bucket in df.columns:
        src, bname, own_bucket = df, bucket, False
    else:
        src, bname, own_bucket = df.withColumn(_B, _as_col(bucket)), _B, True
    wb = Window.partitionBy(*keys, bname).orderBy(*ocols)
    prev = wb.rowsBetween(Window.unboundedPreceding, -1)
    run = wb.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    local = src.withColumn("_scan_first", F.row_number().over(wb) == 1)
    for n, e in lags.items():
        local = local.withColumn(f"_l_{n}", F.lag(_as_col(e)).over(wb))
    for n, e in lasts.items():
        local = local.withColumn(f"_l_{n}", F.last(_as_col(e), ignorenulls=True).over(prev))
    for n, e in cums.items():
        local = local.withColumn(f"_l_{n}", F.sum(F.coalesce(_as_col(e), F.lit(0))).over(run))

    # one summary row per (key, bucket), aggregated from the input with
    # map-side partial aggregation, so only partial summaries are shuffled
    order_key = F.struct(*ocols)
    aggs = []
    if lags:
        aggs.append(F.max_by(F.struct(*[_as_col(e).alias(n) for n, e in lags.items()]),
                             order_key).alias("_tail"))
    for n, e in lasts.items():
        c = _as_col(e)
        aggs.append(F.max_by(c, F.when(c.isNotNull(), order_key)).alias(f"_t_{n}"))
    for n, e in cums.items():
        aggs.append(F.sum(F.coalesce(_as_col(e), F.lit(0))).alias(f"_t_{n}"))
    summ = src.groupBy(*keys, bname).agg(*aggs)
    wk = Window.partitionBy(*keys).orderBy(bname)
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    sel = [*keys, bname]
    if lags:
        sel.append(F.lag("_tail").over(wk).alias("_ptail"))
    for n in lasts:
        sel.append(F.last(f"_t_{n}", ignorenulls=True).over(before).alias(f"_p_{n}"))
    for n in cums:
        sel.append(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_p_{n}"))
    summ = summ.select(*sel)

    out = local.join(summ, [*keys, bname], "left")
    for n in lags:
        out = out.withColumn(n, F.when(F.col("_scan_first"), F.col(f"_ptail.{n}"))
                             .otherwise(F.col(f"_l_{n}")))
    for n in lasts:
        out = out.withColumn(n, F.coalesce(F.col(f"_l_{n}"), F.col(f"_p_{n}")))
    for n in cums:
        out = out.withColumn(n, F.col(f"_l_{n}") + F.col(f"_p_{n}"))
    drop = ["_scan_first", *[f"_l_{n}" for n in (*lags, *lasts, *cums)],
            *[f"_p_{n}" for n in (*lasts, *cums)]]
    if own_bucket:
        drop.append(_B)
    if lags:
        drop.append("_ptail")
    return out.drop(*drop)


def last_n_per_key(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str],
                   bucket: str = "day") -> DataFrame:
    """The ``n`` latest rows of each key by ``order`` (descending), without
    a window over a key's whole history.

    Rows are counted per (key, bucket); a window over those counts (one row
    per bucket) gives the number of rows in later buckets. Buckets entirely
    inside the latest ``n`` are kept whole; only the cutoff bucket is ranked,
    inside (key, bucket)."""
    keys = list(keys)
    counts = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_cnt"))
    wk = Window.partitionBy(*keys).orderBy(F.col(bucket).desc())
    later = F.coalesce(F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    budget = (counts.withColumn("_later", later)
              .where(F.col("_later") < n)
              .select(*keys, bucket, (F.lit(n) - F.col("_later")).alias("_budget"), "_cnt"))
    kept = df.join(budget, [*keys, bucket], "inner")
    wb = Window.partitionBy(*keys, bucket).orderBy(*[F.col(c).desc() for c in order])
    ranked = kept.withColumn("_rn", F.when(F.col("_cnt") > F.col("_budget"), F.row_number().over(wb)))
    return ranked.where(F.col("_rn").isNull() | (F.col("_rn") <= F.col("_budget"))) \
                 .drop("_budget", "_cnt", "_rn")
