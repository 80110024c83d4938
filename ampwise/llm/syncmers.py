"""Document fingerprints from closed syncmers.

A k-mer of characters is a closed syncmer if the smallest of its inner
substrings of length s (by hash) is its first or its last one. Whether a k-mer is
chosen depends on the k-mer alone, so an edit changes anchors only where it
touches them. A fingerprint keeps every distinct anchor, with the position of its
first occurrence, so it grows with the text (about one anchor for six characters).

Two fingerprints are likened by position: the common anchors are put in the order
of the first text, and the longest subset that also ascends in the second is
counted. The likeness is that subset's share of the union of anchors: the Jaccard
similarity of the anchors that keep their order.

Defined cases: a null text counts as empty; the empty text's fingerprint is the
empty string, alike 1 to another empty one and 0 to any other; a text shorter
than a k-mer is one anchor; repeated rows have equal fingerprints; rows with
equal ids follow each other in the order of their texts' hash; null ids come
first; columns beyond those named are ignored.
"""

from __future__ import annotations

import base64
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampwise.llm.common import arrow_type, n_buckets, range_bounds, small_batches

#: Characters of a k-mer and of its inner substrings.
K, S = 16, 5

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _M2
    return x ^ (x >> np.uint64(29))


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def anchors(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (32 bit) and positions of the closed syncmers, by position."""
    n = len(codes)
    if not n:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    c = codes.astype(np.uint64) + np.uint64(1)
    if n < K:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for x in c:
                h = (h ^ x) * _M1
        return (_mix(np.array([h])) >> np.uint64(32)).astype(np.uint32), np.zeros(1, np.int64)
    # inner substrings hash their S characters packed in 64 bits (12 bits each, mixed)
    inner = np.zeros(n - S + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(S):
            inner *= _M1
            inner += c[j:n - S + 1 + j]
        inner = _mix(inner)
        order = (inner >> np.uint64(32)).astype(np.uint32)
        w = K - S + 1
        low, span = order, 1
        while 2 * span <= w:  # minimum of windows by doubling
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        m = len(order) - w + 1
        low = np.minimum(low[:m], low[w - span:w - span + m])
        at = np.flatnonzero((order[:m] == low) | (order[w - 1:w - 1 + m] == low))
        h = np.zeros(len(at), np.uint64)
        for j in range(0, K, S):  # inner substrings cover the k-mer
            h = (h * _M1) ^ inner[np.minimum(at + j, at + K - S)]
        return (_mix(h) >> np.uint64(32)).astype(np.uint32), at


def distinct(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes with their first positions, ascending by hash."""
    u, first = np.unique(hashes, return_index=True)
    return u, at[first]


def encode(u: np.ndarray, at: np.ndarray) -> str:
    if not len(u):
        return ""
    return base64.b64encode(np.stack([u, at.astype(np.uint32)], 1).astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    a = np.frombuffer(base64.b64decode(fingerprint), "<u4").reshape(-1, 2)
    return a[:, 0], a[:, 1].astype(np.int64)


def fingerprint(text: str | None) -> str:
    return encode(*distinct(*anchors(characters(text or ""))))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1; equal fingerprints give 1."""
    (ua, pa), (ub, pb) = a, b
    if not len(ua) or not len(ub):
        return float(len(ua) == len(ub))
    both, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    total = len(ua) + len(ub) - len(both)
    there = pb[ib][np.argsort(pa[ia])]  # positions in the second text, in the order of the first
    if (there[1:] > there[:-1]).all():
        return len(there) / total
    tails: list[int] = []  # longest ascending subsequence
    for p in there.tolist():
        i = bisect_left(tails, p)
        tails[i:i + 1] = [p]
    return len(tails) / total


def edited(codes: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last quarter (rounded down) replaced by as many first characters of the next text, or all."""
    q = len(codes) // 4
    return np.concatenate([codes[:len(codes) - q], following[:q]])


def fingerprints_in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, fingerprint, edited_text, edited_fingerprint,
    near_edited, near_next. The next document is that with the next id; after the last
    comes the first.

    Documents are dealt into ranges of ids; those with a null id, which come first, into ranges
    of their texts' hash. A range's first document is also sent to the
    range before it (the very first to the last), so every task has all neighbours of its
    own documents and goes through them in order, two texts at a time."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # upper bits of the hash that rows with equal ids are ordered by: percentiles are exact to 53 bits
    placed = rows.select(F.when(F.col("id").isNull(), F.shiftright(F.xxhash64("text"), 12)).alias("h"), "id", "text")
    nulls = placed.where(F.col("id").isNull())
    hashes = range_bounds(nulls, "h", 4 * n_buckets(spark)) if nulls.limit(1).count() else []
    bounds, m = range_bounds(rows, "id", 4 * n_buckets(spark)), len(hashes)
    n = m + len(bounds)
    if n < 2:
        return _walk(_one_range(rows, id_col), docs.schema[id_col].dataType.simpleString(), id_col)
    edges = spark.sparkContext.broadcast((np.array(hashes, np.int64), np.array(bounds, np.int64)))

    def deal(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        by_hash, by_id = edges.value
        lows = np.concatenate((by_hash, by_id))
        for batch in batches:
            null = pc.is_null(batch.column(1)).to_numpy(zero_copy_only=False)
            ids = pc.coalesce(batch.column(1).cast(pa.int64()), batch.column(0)).to_numpy(zero_copy_only=False)
            part = np.where(null, np.searchsorted(by_hash, ids, side="right"), m + np.searchsorted(by_id, ids, side="right")) - 1
            batch = batch.select(["id", "text"])
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.zeros(len(ids), np.int8), pa.int8()), *batch.columns], names=["part", "guest", "id", "text"])
            at = np.flatnonzero(lows[part] == ids)
            if len(at):
                guest = batch.take(pa.array(at))
                to = (part[at] - 1) % len(lows)
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(np.ones(len(at), np.int8), pa.int8()), *guest.columns], names=["part", "guest", "id", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    dealt = placed.mapInArrow(deal, f"part int, guest tinyint, id {kind}, text string")
    return _walk(dealt, kind, id_col, n_buckets(spark))


def _one_range(rows: DataFrame, id_col: str) -> DataFrame:
    """All rows in one range, the first sent again as the guest at its end."""
    first = rows.orderBy(F.col("id").asc_nulls_first(), F.xxhash64("text")).limit(1)
    own = rows.select(F.lit(0).cast("int").alias("part"), F.lit(0).cast("tinyint").alias("guest"), "id", "text")
    return own.unionByName(first.select(F.lit(0).cast("int").alias("part"), F.lit(1).cast("tinyint").alias("guest"), "id", "text"))


def _walk(dealt: DataFrame, kind: str, id_col: str, parts: int = 1) -> DataFrame:
    schema = (f"{id_col} {kind}, n_chars bigint, fingerprint string, edited_text string, "
              "edited_fingerprint string, near_edited double, near_next double")

    names = [part.split()[0] for part in schema.split(", ")]
    types = [arrow_type(part.split()[1]) for part in schema.split(", ")]

    def walk(batches):
        import pyarrow as pa
        out, chars = [], 0

        def flush():
            nonlocal out, chars
            cols, out, chars = list(zip(*out)), [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        held = None  # (part, id, codes, all anchors, sketch) of the document whose next one is awaited
        for batch in batches:
            cols = [batch.column(i) for i in range(4)]
            for r in range(batch.num_rows):
                part, guest, key = cols[0][r].as_py(), cols[1][r].as_py(), cols[2][r].as_py()
                if held is None and guest:
                    continue  # a further copy of the guest's id, or a range without documents
                codes = characters(cols[3][r].as_py())
                found = anchors(codes)
                own = distinct(*found)
                if held is not None:
                    _, id0, codes0, found0, own0 = held
                    new, sketch = _edited_sketch(codes0, found0, codes)
                    text = new.tobytes().decode("utf-32-le", "surrogatepass")
                    prints = encode(*own0), encode(*sketch)
                    out.append((id0, len(codes0), prints[0], text, prints[1], likeness(own0, sketch), likeness(own0, own)))
                    chars += len(new) + sum(map(len, prints))
                    if chars > 4_000_000:
                        yield flush()
                held = None if guest else (part, key, codes, found, own)
        if out:
            yield flush()

    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "guest", F.col("id").asc_nulls_first(), F.xxhash64("text"))
    return ordered.mapInArrow(walk, schema)


def _edited_sketch(codes: np.ndarray, found: tuple[np.ndarray, np.ndarray], following: np.ndarray):
    """The edited text and its sketch. Anchors wholly inside the part that stays are reused:
    a k-mer is chosen by its own characters alone."""
    new = edited(codes, following)
    stay = len(codes) - len(codes) // 4
    if stay < K or len(new) < K:
        return new, distinct(*anchors(new))
    hashes, at = found
    keep = int(np.searchsorted(at, stay - K, side="right"))
    tail = stay - K + 1
    if len(new) - tail < K:
        return new, distinct(hashes[:keep], at[:keep])
    h2, at2 = anchors(new[tail:])
    return new, distinct(np.concatenate([hashes[:keep], h2]), np.concatenate([at[:keep], at2 + tail]))
