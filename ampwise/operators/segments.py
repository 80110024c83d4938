"""Island statistics by segment combination (a parallel scan).

An *island* is a run of a key's rows (in ``order``) in which consecutive rows
are at most ``max_gap_s`` apart (and, optionally, no extra split condition
holds). Trips and charging/driving periods are islands.

Instead of numbering every row with a window over the key's whole history,
rows are windowed only inside (key, bucket), e.g. one vehicle-day:

1. each (key, bucket) is cut into local segments where a break occurs or the
   bucket starts; per-row and per-pair (row with its predecessor in the
   segment) contributions are aggregated per local segment, together with
   the segment's first and last row. That aggregation needs no shuffle (the
   rows are already clustered by key and bucket) and shrinks the data to one
   row per segment;
2. on the segment table, a window over the key's segments decides whether a
   segment continues the previous one (the gap between the previous tail and
   this head is no break); pair contributions across such joins are computed
   from the two boundary rows;
3. segments are combined per island with ordinary aggregates.

The only shuffle of raw rows is the one into (key, bucket); everything after
works on per-segment rows. The result is the same as a sequential scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import gap_seconds

Accessor = Callable[[str], Column]
RowFn = Callable[[Accessor], Column]
PairFn = Callable[[Accessor, Accessor], Column]

_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def _combine(kind: str, seg: Column, boundary: Column | None) -> Column:
    if kind == "sum":
        s = F.sum(seg)
        if boundary is None:
            return s
        b = F.sum(boundary)
        return F.when(s.isNull() & b.isNull(), F.lit(None)).otherwise(
            F.coalesce(s, F.lit(0)) + F.coalesce(b, F.lit(0)))
    if kind == "min":
        return F.min(seg) if boundary is None else F.least(F.min(seg), F.min(boundary))
    if kind == "max":
        return F.max(seg) if boundary is None else F.greatest(F.max(seg), F.max(boundary))
    raise ValueError(kind)


def breaks(max_gap_s: float, split: PairFn | None = None) -> PairFn:
    """Whether a new island starts between two rows."""
    def brk(prev: Accessor, cur: Accessor) -> Column:
        b = F.coalesce(gap_seconds(prev("ts"), cur("ts")) > max_gap_s, F.lit(False))
        return b | F.coalesce(split(prev, cur), F.lit(False)) if split is not None else b
    return brk


def cut(rows: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str, brk: PairFn,
        carry: Sequence[str]) -> DataFrame:
    """Number the local segments of ``rows`` inside (key, bucket) as ``_seg``; ``_brk`` marks a
    segment's first row, ``_lag_<c>`` is column ``c`` of the row before in (key, bucket)."""
    w = Window.partitionBy(*keys, bucket).orderBy(*order)
    r = rows.withColumns({f"_lag_{c}": F.lag(c).over(w) for c in carry})
    r = r.withColumn("_brk", F.col("_lag_ts").isNull() | brk(lagged, here))
    return r.withColumn("_seg", F.sum(F.col("_brk").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


lagged: Accessor = lambda c: F.col(f"_lag_{c}")
here: Accessor = lambda c: F.col(c)
#: The last row of the segment before, and a segment's first row.
tail_before: Accessor = lambda c: F.col(f"_ptail.{c}")
head: Accessor = lambda c: F.col(f"_head.{c}")


def joined(segs: DataFrame, keys: Sequence[str], bucket: str, brk: PairFn, id_col: str) -> DataFrame:
    """Number the islands of a segment table (``_seg``, ``_head``, ``_tail``): ``_merge`` says that a
    segment goes on with the island of the one before, whose last row is ``_ptail``."""
    ws = Window.partitionBy(*keys).orderBy(bucket, "_seg")
    segs = segs.withColumn("_ptail", F.lag("_tail").over(ws))
    segs = segs.withColumn("_merge", F.col("_ptail").isNotNull() & ~brk(tail_before, head))
    return segs.withColumn(id_col, F.sum((~F.col("_merge")).cast("long")).over(
        ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1)


def island_stats(rows: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str,
                 max_gap_s: float, carry: Sequence[str],
                 row_aggs: Mapping[str, tuple[str, RowFn]] | None = None,
                 pair_aggs: Mapping[str, tuple[str, PairFn]] | None = None,
                 split: PairFn | None = None, id_col: str = "island_no") -> DataFrame:
    """Aggregate the islands of ``rows``.

    * ``carry``: columns kept for each island's first (``_head``) and last
      (``_tail``) row, as structs.
    * ``row_aggs[name] = (kind, fn(cur))``: ``kind`` in sum/min/max over rows.
    * ``pair_aggs[name] = (kind, fn(prev, cur))``: over consecutive rows of
      the same island (the island's first row has no pair).
    * ``split(prev, cur)``: extra break condition besides the gap.

    Returns ``keys, id_col, _n, _head, _tail`` and one column per aggregate;
    ``id_col`` counts breaks since the key's first row (0-based)."""
    rows = rows.where(F.col("ts").isNotNull())  # a row without a time has no place in any order
    keys, order = list(keys), list(order)
    row_aggs, pair_aggs = dict(row_aggs or {}), dict(pair_aggs or {})
    carry = list(dict.fromkeys([*order, "ts", *carry]))

    brk = breaks(max_gap_s, split)
    # 1. local segments inside (key, bucket)
    r = cut(rows, keys, order, bucket, brk, carry)
    segs = r.groupBy(*keys, bucket, "_seg").agg(*_segment_aggs(order, carry, row_aggs, pair_aggs, lagged, F.col("_brk")))
    # 2. join segments across buckets, 3. combine them per island
    return _combined(joined(segs, keys, bucket, brk, id_col), keys, bucket, row_aggs, pair_aggs, id_col)


def _segment_aggs(order, carry, row_aggs, pair_aggs, prev: Accessor, starts: Column) -> list[Column]:
    okey, row = F.struct(*[F.col(c) for c in order]), F.struct(*[F.col(c) for c in carry])
    return [F.count(F.lit(1)).alias("_n"), F.min_by(row, okey).alias("_head"), F.max_by(row, okey).alias("_tail"),
            *[_AGG[kind](fn(here)).alias(name) for name, (kind, fn) in row_aggs.items()],
            *[_AGG[kind](F.when(~starts, fn(prev, here))).alias(name) for name, (kind, fn) in pair_aggs.items()]]


def _combined(segs: DataFrame, keys: Sequence[str], bucket: str, row_aggs, pair_aggs, id_col: str) -> DataFrame:
    segs = segs.withColumns({f"_b_{name}": F.when(F.col("_merge"), fn(tail_before, head)) for name, (_, fn) in pair_aggs.items()}) if pair_aggs else segs
    sk = F.struct(F.col(bucket), F.col("_seg"))
    final = [F.sum("_n").alias("_n"), F.min_by("_head", sk).alias("_head"), F.max_by("_tail", sk).alias("_tail")]
    final += [_combine(kind, F.col(name), None).alias(name) for name, (kind, _) in row_aggs.items()]
    final += [_combine(kind, F.col(name), F.col(f"_b_{name}")).alias(name) for name, (kind, _) in pair_aggs.items()]
    return segs.groupBy(*keys, id_col).agg(*final)


def islands_by_kind(rows: DataFrame, flags: Mapping[int, Column], keys: Sequence[str], order: Sequence[str],
                    bucket: str, max_gap_s: float, carry: Sequence[str],
                    row_aggs: Mapping[str, tuple[str, RowFn]] | None = None,
                    pair_aggs: Mapping[str, tuple[str, PairFn]] | None = None,
                    splits: Mapping[int, PairFn] | None = None, id_col: str = "island_no") -> DataFrame:
    """:func:`island_stats` of several kinds of islands in one pass.

    ``flags`` says for each kind (an integer) which rows qualify; a row may qualify for several. A
    kind's islands are runs of its own rows: its previous row is the last one before with the flag,
    whatever lies between. The rows go through one window into (key, bucket), in which each kind
    has its own previous row and segment number, and are then grouped where they are, a row once
    for each kind it belongs to. The result has a column ``kind``; aggregates may refer to it."""
    keys, order, splits = list(keys), list(order), dict(splits or {})
    row_aggs, pair_aggs = dict(row_aggs or {}), dict(pair_aggs or {})
    carry = list(dict.fromkeys([*order, "ts", *carry]))
    r = rows.where(F.col("ts").isNotNull()).withColumns({f"_f{k}": F.coalesce(f, F.lit(False)) for k, f in flags.items()})
    any_ = F.lit(False)
    for k in flags:
        any_ = any_ | F.col(f"_f{k}")
    r = r.where(any_)
    w = Window.partitionBy(*keys, bucket).orderBy(*order)
    row = F.struct(*[F.col(c) for c in carry])
    r = r.withColumns({f"_p{k}": F.last(F.when(F.col(f"_f{k}"), row), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) for k in flags})

    def starts(k):
        prev: Accessor = lambda c: F.col(f"_p{k}.{c}")
        return F.col(f"_f{k}") & (F.col(f"_p{k}").isNull() | breaks(max_gap_s, splits.get(k))(prev, here))

    r = r.withColumns({f"_s{k}": starts(k) for k in flags})
    r = r.withColumns({f"_n{k}": F.sum(F.col(f"_s{k}").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for k in flags})
    of = F.array_compact(F.array(*[F.when(F.col(f"_f{k}"), F.struct(F.lit(k).alias("kind"), F.col(f"_p{k}").alias("prev"), F.col(f"_s{k}").alias("brk"), F.col(f"_n{k}").alias("seg")))
                                   for k in flags]))
    r = r.withColumn("_of", F.explode(of)).withColumn("kind", F.col("_of.kind")).withColumn("_seg", F.col("_of.seg"))
    prev_k: Accessor = lambda c: F.col(f"_of.prev.{c}")
    segs = r.groupBy(*keys, bucket, "kind", "_seg").agg(*_segment_aggs(order, carry, row_aggs, pair_aggs, prev_k, F.col("_of.brk")))

    def split(p, c):
        s = F.lit(False)
        for k, fn in splits.items():
            s = s | ((F.col("kind") == k) & F.coalesce(fn(p, c), F.lit(False)))
        return s

    keyed = [*keys, "kind"]
    return _combined(joined(segs, keyed, bucket, breaks(max_gap_s, split if splits else None), id_col), keyed, bucket, row_aggs, pair_aggs, id_col)
