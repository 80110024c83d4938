"""Exact top-k by inner product with block-at-a-time pruning.

The vectors (integers; a dimension is a term) are ordered by the nearest of a few
centres and dealt in ranges of that order, the shards. A shard is cut into blocks of
``BLOCK`` neighbouring rows. Of each block the largest and smallest value of every
term are kept, besides its rows (the forward index). For a query, the sum over terms
of the larger of weight times maximum and weight times minimum bounds the score of
every row of a block. Blocks are taken in the order of falling bounds and scored
through the forward index until the next bound is below the k-th score found so far,
or equal to it with no smaller id in the block.

A query meets a bounded sample of the vectors first (``SAMPLE``, by a hash), whose k-th
score is a floor, then its own shard, while the shard is made. The k-th score so far
goes with it to the other shards, so most blocks elsewhere are never scored. Queries
travel in packed blocks: each shard is one packed row, and the query blocks come to it
after it, sorted, so a task holds one shard and one block of queries. The index is a
written table. The centres come from the same sample; they fix an order only, results
don't depend on them.

Defined cases: null vectors, and those with a null or non-finite component, take no
part, nor do rows with a null id; shorter vectors count as filled up with zeros; rows
with one id are one vector, the smallest of them in the order of their components;
equal scores go to the smaller id; fewer candidates than k give fewer rows; an empty
table gives none; further columns are not read. Scores that do not fit 63 bits raise
an error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampwise.llm.common import hash_sample, n_buckets, stored

#: Rows of a block, of a shard (about), and queries of a block.
BLOCK, SHARD, QUERIES = 64, 32_768, 512
#: Vectors of the sample that gives the first floors and the centres, and centres.
SAMPLE, CENTRES = 20_000, 256

_LEAST = -np.iinfo(np.int64).max
_MOST = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, components): floor(scale * x) of every component, one row for an id."""
    v = F.col(vector_col)
    fine = F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(fine).select(F.col(id_col).cast("bigint").alias("id"),
                                       F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint")).alias("components"))
            .groupBy("id").agg(F.min("components").alias("components")))


def sampled(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, rows) of a bounded sample."""
    got = hash_sample(vectors, SAMPLE, F.col("id")).select("id", "components").collect()
    x = np.zeros((len(got), dims), np.int64)
    for i, r in enumerate(got):
        x[i, :len(r[1])] = r[1]
    return np.array([r[0] for r in got], np.int64), x


def centres(x: np.ndarray) -> np.ndarray:
    """Centres by a few rounds of k-means."""
    x = x.astype(np.float64)
    c = x[:: max(1, len(x) // CENTRES)][:CENTRES].copy()
    for _ in range(8):
        near = nearest(x, c)
        for j in np.unique(near):
            c[j] = x[near == j].mean(0)
    return c


def in_order(ids: np.ndarray, rows: np.ndarray, centre: np.ndarray) -> "Shard":
    by = np.lexsort((ids, centre))
    return Shard(ids[by], rows[by])


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2.0 * (x @ c.T), axis=1) if len(c) else np.zeros(len(x), np.int64)


class Shard:
    """The rows of a shard in blocks, with each block's largest and smallest terms."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        at = np.arange(0, len(ids), BLOCK)
        self.high, self.low = np.maximum.reduceat(rows, at), np.minimum.reduceat(rows, at)
        self.first = np.minimum.reduceat(ids, at)
        self.size = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
        self.as_type: dict = {}

    def typed(self, kind) -> tuple:
        """Rows and terms as a number type in which scores are exact."""
        if kind not in self.as_type:
            self.as_type = {kind: (self.rows.astype(kind), self.high.astype(kind), self.low.astype(kind))}
        return self.as_type[kind]


def exact_type(a: int, b: int, dims: int):
    most = a * b * max(1, dims)
    if most >= 1 << 63:
        raise ValueError("scores do not fit a long")
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def search(shard: Shard, own: np.ndarray, weights: np.ndarray, k: int, best: np.ndarray, best_ids: np.ndarray) -> None:
    """Take the shard's rows into each query's ``k`` best (scores falling, equal ones by id;
    unused places hold the least score and the largest id)."""
    m = len(own)
    if not m or not len(shard.ids):
        return
    size = max(abs(int(weights.max())), abs(int(weights.min())))
    kind = exact_type(size, shard.size, weights.shape[1])
    rows, high, low = shard.typed(kind)
    q = weights.astype(kind)
    bounds = (np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T).astype(np.int64)
    order = np.argsort(-bounds, axis=1, kind="stable")
    ranked = np.take_along_axis(bounds, order, 1)
    n_blocks, done, width = bounds.shape[1], 0, 4
    left = np.arange(m)
    while done < n_blocks and len(left):
        part = slice(done, done + width)
        score, block = ranked[left, part], order[left, part]
        kth, kth_id = best[left, -1][:, None], best_ids[left, -1][:, None]
        open_ = (score > kth) | ((score == kth) & (shard.first[block] < kth_id))
        i, j = np.nonzero(open_)
        who, what = left[i], block[i, j]
        by = np.argsort(what, kind="stable")
        who, what = who[by], what[by]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(what)) + 1, [len(what)])) if len(what) else [0]
        found = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            b, some = int(what[lo]), who[lo:hi]
            at = slice(b * BLOCK, (b + 1) * BLOCK)
            ids = shard.ids[at]
            got = (q[some] @ rows[at].T).astype(np.int64)
            kth, kth_id = best[some, -1][:, None], best_ids[some, -1][:, None]
            better = ((got > kth) | ((got == kth) & (ids < kth_id))) & (ids != own[some][:, None])
            y, x = np.nonzero(better)
            found.append((some[y], got[y, x], ids[x]))
        if found:
            take(best, best_ids, *(np.concatenate(c) for c in zip(*found)), k)
        done += width
        width *= 2
        if done < n_blocks:
            left = left[ranked[left, done] >= best[left, -1]]


def take(best: np.ndarray, best_ids: np.ndarray, who: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> None:
    """Merge candidates into the best of the queries concerned."""
    if not len(who):
        return
    some = np.unique(who)
    w = np.concatenate((np.repeat(some, k), who))
    s = np.concatenate((best[some].ravel(), score))
    i = np.concatenate((best_ids[some].ravel(), ids))
    by = np.lexsort((i, -s, w))
    w, s, i = w[by], s[by], i[by]
    start = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
    rank = np.arange(len(w)) - np.repeat(start, np.diff(np.append(start, len(w))))
    keep = rank < k
    best[some], best_ids[some] = s[keep].reshape(-1, k), i[keep].reshape(-1, k)


def packed(a: np.ndarray) -> tuple[bytes, str]:
    """An integer matrix in the narrowest type that holds it."""
    for kind in ("<i1", "<i2", "<i4", "<i8"):
        info = np.iinfo(kind)
        if not a.size or (a.min() >= info.min and a.max() <= info.max):
            return a.astype(kind).tobytes(), kind
    raise AssertionError


def unpacked(data: bytes, kind: str, dims: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, dims).astype(np.int64)


_INDEX = "shard long, queries boolean, ids binary, rows binary, kind string, kth binary, kth_id binary, query_ids array<bigint>, vec_ids array<bigint>, scores array<bigint>"


def build(vectors: DataFrame, is_query: Column, k: int) -> tuple[DataFrame, int] | None:
    """The written index of ``vectors`` (id, components): shards, and blocks of queries with what
    they found in their own shard. None for an empty table."""
    import pyarrow as pa
    spark = vectors.sparkSession
    vectors = stored(vectors.withColumn("query", F.coalesce(is_query, F.lit(False))), "topk-vectors")
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("components")).alias("dims")).first()
    n, dims = facts["n"], max(1, facts["dims"] or 1)
    if not n:
        return None
    ids, rows = sampled(vectors, dims)
    middle = spark.sparkContext.broadcast((centres(rows), ids, rows))  # SAMPLE rows at most
    shards = max(-(-n // SHARD), min(n_buckets(spark), -(-n // 2048)))

    def matrix(column) -> np.ndarray:
        flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
        out = np.zeros((len(sizes), dims), np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return out

    def place(batches):
        for b in batches:
            centre = nearest(matrix(b.column(1)).astype(np.float64), middle.value[0])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(centre, pa.int64())], names=["id", "components", "query", "centre"])

    def row(shard, queries, ids, rows, kth=b"", kth_id=b"", found=([], [], [])):
        data, kind = packed(rows)
        values = [shard, queries, ids.astype("<i8").tobytes(), data, kind, kth, kth_id, *found]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    lists = pa.list_(pa.int64())
    schema = pa.schema([("shard", pa.int64()), ("queries", pa.bool_()), ("ids", pa.binary()), ("rows", pa.binary()), ("kind", pa.string()),
                        ("kth", pa.binary()), ("kth_id", pa.binary()), ("query_ids", lists), ("vec_ids", lists), ("scores", lists)])

    def shard_rows(number, parts, sample):
        ids, rows, query, centre = (np.concatenate(c) for c in zip(*parts))
        by = np.lexsort((ids, centre))
        ids, rows, query = ids[by], rows[by], query[by]
        yield row(number, False, ids, rows)
        shard, at = Shard(ids, rows), np.flatnonzero(query)
        for lo in range(0, len(at), QUERIES):
            some = at[lo:lo + QUERIES]
            best, best_ids = np.full((len(some), k), _LEAST), np.full((len(some), k), _MOST)
            search(sample, ids[some], rows[some], k, best, best_ids)
            # what ranks below the sample's k-th is out; that row itself is found again
            known = best[:, -1] > _LEAST
            floor, floor_id = best[:, -1:].copy(), np.where(known, best_ids[:, -1] + 1, _MOST)[:, None]
            best[:], best_ids[:] = floor, floor_id
            search(shard, ids[some], rows[some], k, best, best_ids)
            used = (best != floor) | (best_ids != floor_id)
            yield row(number, True, ids[some], rows[some], best[:, -1].astype("<i8").tobytes(), best_ids[:, -1].astype("<i8").tobytes(),
                      (np.repeat(ids[some], k)[used.ravel()], best_ids[used], best[used]))

    def pack(batches):
        from pyspark import TaskContext
        number, held, parts = TaskContext.get().partitionId() << 32, 0, []
        centre, ids, rows = middle.value
        sample = in_order(ids, rows, nearest(rows.astype(np.float64), centre))
        for b in batches:
            parts.append((b.column(0).to_numpy(), matrix(b.column(1)), b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy()))
            held += b.num_rows
            if held >= 2 * SHARD:  # a range that came out too long is several shards
                yield from shard_rows(number, parts, sample)
                number, held, parts = number + 1, 0, []
        if held:
            yield from shard_rows(number, parts, sample)

    placed = vectors.mapInArrow(place, "id bigint, components array<bigint>, query boolean, centre bigint")
    return stored(placed.repartitionByRange(shards, "centre", "id").mapInArrow(pack, _INDEX), "topk-index"), dims


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` (id, components) with the
    highest inner product for each row that is a query, but itself."""
    import pyarrow as pa
    spark = vectors.sparkSession
    built = build(vectors, is_query, k)
    if built is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    index, dims = built
    shards = sorted(r[0] for r in index.where(~F.col("queries")).select("shard").collect())  # one number a shard
    columns = ["shard", "queries", "ids", "rows", "kind", "kth", "kth_id"]
    data = index.where(~F.col("queries")).select(*columns)
    # every block of queries goes to each shard but its own
    asked = index.where("queries").select(F.col("shard").alias("home"), *columns[1:])
    listed = F.split(F.lit(",".join(map(str, shards))), ",").cast("array<bigint>")
    sent = asked.withColumn("shard", F.explode(listed)).where("shard <> home").select(*columns)

    def run(batches):
        shard = None
        for b in batches:
            for r in b.to_pylist():
                ids, rows = np.frombuffer(r["ids"], "<i8"), unpacked(r["rows"], r["kind"], dims)
                if not r["queries"]:
                    shard = Shard(ids, rows)
                    continue
                m = len(ids)
                best, best_ids = np.full((m, k), _LEAST), np.full((m, k), _MOST)
                # only what beats the k-th of the own shard counts: it stands in all places
                best[:], best_ids[:] = np.frombuffer(r["kth"], "<i8")[:, None], np.frombuffer(r["kth_id"], "<i8")[:, None]
                search(shard, ids, rows, k, best, best_ids)
                new = (best != np.frombuffer(r["kth"], "<i8")[:, None]) | (best_ids != np.frombuffer(r["kth_id"], "<i8")[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, k)[new.ravel()]), pa.array(best_ids[new]), pa.array(best[new])],
                                                 names=["query_id", "vec_id", "score"])

    dealt = data.unionByName(sent).repartition(max(len(shards), n_buckets(spark)), "shard").sortWithinPartitions("shard", "queries")
    far = dealt.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    home = index.where("queries").select(F.explode(F.arrays_zip("query_ids", "vec_ids", "scores")).alias("r")).select(
        F.col("r.query_ids").alias("query_id"), F.col("r.vec_ids").alias("vec_id"), F.col("r.scores").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return home.unionByName(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
