"""Similarity join on word shingles by T-occurrence search (DivideSkip).

Two documents link when the Jaccard similarity of their sets of distinct word
shingles is at least ``SIMILAR``. With sizes n and m that asks for an overlap of
T = ceil((n + m) * SIMILAR / (1 + SIMILAR)) shingles; no document is too far in
size by the same rule. A query's shingles are ordered from rare to frequent. Its
T - 1 longest inverted lists may be left out of the merge, for a partner must
still occur in at least one of the other, short ones.

1. How frequent a shingle is comes from a table of counts over all documents
   (2 ** ``SKETCH_BITS`` counters chosen by the hash, kept as logarithms; it only
   fixes the order, any order gives the same result).
2. Each document keeps its set's size, a hash of the whole set and its short
   lists' shingles. Equal sets become one class, represented by its smallest id.
3. Postings (shingle, class, size) of the short lists meet by shingle. As all sets
   keep one order, linked sets must share ``least_shared`` shingles of their short
   lists, not just one. Pairs of a list that may link by size are therefore counted
   over all lists, and those met often enough fall into one neighbourhood (a
   component of that relation), so every pair that can link is within one. Pairs
   whose smallest hashes agree (``signature``) are put together at once and not
   counted; that only makes neighbourhoods larger. So is a list of more than
   ``LONG`` postings: all its neighbouring size bands are joined. A very frequent
   shingle's list is dealt by salt, and joined by its bands' heads.
4. Neighbourhoods are searched apart. A task has the whole sets of one and takes
   them by size. It merges each query's short lists with a heap, which counts how
   often an earlier set occurs in them and where the last common shingle stands in
   both; if that count and what is left behind those places can still reach T,
   the long lists are probed by binary search. A list holds only sets of which it
   is one of the n - T(n, n) + 1 rarest, as larger partners must meet them there:
   texts of one template that are not similar enough share no such list. Lists
   whose members already belong to the query's component are skipped, so a large
   group of near copies costs about its postings.
5. Neighbourhoods with more than ``UNIT`` shingles aren't gathered. Where they are
   the lesser part of the shingles, steps 1 to 4 are done anew for their documents
   alone, with a table that counts only those and so tells rare from frequent
   better. Else they are dealt into blocks of bounded size. Each block is searched
   by itself, and so are, in new blocks, the smallest members of the components
   found, as long as that links any. Then sets in lists whose members still belong
   to several components are searched for each pair of blocks.

A set's identity is a 64-bit hash of its hashed shingles (64 bits as well), so an
error needs a collision.

Defined cases: null or empty texts and texts of white space have no shingles, link
with nothing and are their own component; rows with a null id take no part and
have a null component; repeated rows have equal sets and link; without documents
there are no rows; columns beyond those named are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampwise.llm.common import join_ids, n_buckets, slices, small_batches, stored
from ampwise.llm.components import FOREST_NODES, Forest, components
from ampwise.llm.shingles import mix, shingle_sets

#: Words of a shingle; least similarity in hundredths.
WORDS, SIMILAR = 5, 80
#: log2 of the counters of the frequency table, and how many of them a row carries. The table
#: has one byte for each.
SKETCH_BITS, SKETCH_ROW = 23, 1 << 16
#: Postings of a list from which on it is dealt by salt.
HEAVY = 50_000
#: Postings of a list up to which its pairs are counted one by one.
LONG = 32
#: Shingles of a neighbourhood that one task may gather.
UNIT = 4_000_000
#: Pairs to be counted that a task passes on at once.
PAIRS = 100_000


def required(n: int, m: int, similar: int = SIMILAR) -> int:
    """Least overlap of linked sets of sizes n and m: 100 i >= similar (n + m - i)."""
    return -(-(n + m) * similar // (100 + similar))


def short_lists(n: int, similar: int = SIMILAR) -> int:
    """How many of a set's rarest shingles are merged: n - T + 1 with the least T of any partner."""
    return n - -(-n * similar // 100) + 1


def least_shared(n: int, m: int, similar: int = SIMILAR) -> int:
    """Of how many shingles linked sets of sizes n and m have both in their short lists, at least:
    the common shingles beyond either's short list are the last ones in the order of both."""
    return required(n, m, similar) - max(n - short_lists(n, similar), m - short_lists(m, similar))


def frequencies(docs: DataFrame, text_col: str = "text", words: int = WORDS) -> np.ndarray:
    """Occurrences of shingles by their hash's upper bits, over all documents: eight times the
    binary logarithm of one more than the count, in a byte."""
    size, shift = 1 << SKETCH_BITS, np.uint64(64 - SKETCH_BITS)

    def count(batches):
        import zstandard
        total = np.zeros(size, np.uint32)
        for batch in batches:
            for part in slices(batch, text_col):
                sets = shingle_sets(part.column(0).to_pylist(), words)
                if sets:
                    at, n = np.unique((np.concatenate(sets) >> shift).astype(np.int64), return_counts=True)
                    total[at] += n.astype(np.uint32)
        press = zstandard.ZstdCompressor(level=1)
        rows = [press.compress(total[i:i + SKETCH_ROW].tobytes()) for i in range(0, size, SKETCH_ROW)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.binary())], names=["row", "z"])

    def add(batches):
        import zstandard
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint32)
                sums[row] = np.minimum(sums.get(row, np.uint64(0)) + got.astype(np.uint64), np.uint64(0xFFFFFFFF))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([level(a).tobytes() for a in sums.values()], pa.binary())], names=["row", "z"])

    got = docs.select(text_col).mapInArrow(count, "row int, z binary").repartition("row").mapInArrow(add, "row int, z binary")
    table = np.zeros(size, np.uint8)
    for r in got.collect():  # the table's size is fixed
        table[r["row"] * SKETCH_ROW:(r["row"] + 1) * SKETCH_ROW] = np.frombuffer(r["z"], np.uint8)
    return table


def level(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.round(8 * np.log2(1.0 + counts))).astype(np.uint8)


def count_of(levels: np.ndarray) -> np.ndarray:
    return np.round(np.exp2(levels / 8.0) - 1).astype(np.int64)


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit hash of a set of hashes."""
    with np.errstate(over="ignore"):
        h = mix(np.array([np.bitwise_xor.reduce(mix(s)) + np.add.reduce(s) * np.uint64(3) + np.uint64(len(s))]))
    return int(h.view(np.int64)[0])


def rarest(s: np.ndarray, table: np.ndarray, similar: int = SIMILAR) -> np.ndarray:
    """The shingles of the short lists: rare ones first, then by hash."""
    k = short_lists(len(s), similar)
    f = table[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    return s[np.lexsort((s, f))[:k]]


#: Where the quarters of the hashes begin.
_QUARTERS = np.arange(4, dtype=np.uint64) << np.uint64(62)


def signature(s: np.ndarray) -> int:
    """The last four bits of the smallest hash of each quarter (or of the next hash), in 16 bits."""
    low = (s[np.minimum(np.searchsorted(s, _QUARTERS), len(s) - 1)] & np.uint64(15)).tolist()
    return low[0] | low[1] << 4 | low[2] << 8 | low[3] << 12


#: Whether signatures that differ in these bits agree in three quarters at least.
_AGREE = bytes(sum(not x >> i & 15 for i in (0, 4, 8, 12)) >= 3 for x in range(1 << 16))


class Search:
    """T-occurrence search within a unit: sets of hashes, with links found as a forest."""

    def __init__(self, similar: int = SIMILAR) -> None:
        self.similar = similar

    def links(self, sets: list[np.ndarray], forest: Forest, names: list[int], same_block: list[int] | None = None) -> None:
        """Unite in ``forest`` the names of linked sets. With ``same_block``, pairs of one
        block are not asked for."""
        if len(sets) < 2:
            return
        sizes = [len(s) for s in sets]
        flat = np.concatenate(sets)
        tokens, number, df = np.unique(flat, return_inverse=True, return_counts=True)
        ends = np.cumsum(sizes)
        of = [number[e - n:e] for e, n in zip(ends.tolist(), sizes)]
        lists: dict[int, list[int]] = {}  # token -> sets before by rank, each with the token's place in it
        whole: dict[int, int] = {}  # token -> a member, if all members are of one component
        find = forest.find
        by_rank = sorted(range(len(sets)), key=lambda i: (sizes[i], names[i]))
        for r, x in enumerate(by_rank):
            n, name = sizes[x], names[x]
            place = np.lexsort((of[x], df[of[x]]))  # from rare to frequent
            own = of[x][place]
            root = find(name)
            merged = []
            for i, t in enumerate(own[:short_lists(n, self.similar)].tolist()):
                members = lists.get(t)
                if not members:
                    continue
                at = whole.get(t)
                if at is not None and find(at) == root:
                    continue
                merged.append([(m, i) for m in members])
            rare = None
            last, common, i_last, j_last = -1, 0, 0, 0
            for m, i in [*(heapq.merge(*merged) if len(merged) > 1 else merged[0] if merged else ()), (-1, 0)]:
                at, j = divmod(m, _PLACE)
                if at == last:
                    common, i_last, j_last = common + 1, i, j
                    continue
                if last >= 0:
                    y = by_rank[last]
                    need = required(n, sizes[y], self.similar)
                    # beyond the last place met in both sets, no more can be common than is left of either
                    if (100 * sizes[y] >= self.similar * n and common + min(n - i_last, sizes[y] - j_last) - 1 >= need
                            and not (same_block and same_block[x] == same_block[y]) and find(names[y]) != find(name)):
                        if rare is None:
                            rare = sets[x][place]
                        # y is in a list exactly if the list's shingle is in y: probe the other lists in y's sorted set
                        left = rare[i_last + 1:]
                        got = np.searchsorted(sets[y], left)
                        got[got == sizes[y]] = 0
                        if common + int((sets[y][got] == left).sum()) >= need:
                            forest.union(name, names[y])
                last, common, i_last, j_last = at, 1, i, j
            # a set is met by larger ones: its rarest shingles, of which such a partner must have one
            for j, t in enumerate(own[:n - required(n, n, self.similar) + 1].tolist()):
                if df[t] < 2:
                    continue
                members = lists.get(t)
                if members is None:
                    lists[t] = [r * _PLACE + j]
                    whole[t] = name
                else:
                    members.append(r * _PLACE + j)
                    at = whole.get(t)
                    if at is not None:
                        if find(at) != find(name):
                            del whole[t]
                    elif len(members) & (len(members) - 1) == 0:  # now and then: have they come together
                        first = find(name)
                        if all(find(names[by_rank[q // _PLACE]]) == first for q in members):
                            whole[t] = name


#: A list's entries are a set's rank times this, plus the shingle's place in the set.
_PLACE = 1 << 40


def _band(n: int, similar: int = SIMILAR) -> int:
    """Geometric size bands: linked sets are in the same band or neighbouring ones."""
    edges = _edges(similar)
    return bisect_left(edges, n + 1) - 1


_EDGES: dict[int, list[int]] = {}


def _edges(similar: int) -> list[int]:
    """Band k begins at _edges[k]; a size's largest partner is below the end of the next band."""
    if similar not in _EDGES:
        e = [1]
        while e[-1] < 1 << 40:
            e.append(e[-1] * 100 // similar + 1)
        _EDGES[similar] = e
    return _EDGES[similar]


def prepare(docs: DataFrame, table, id_col: str, text_col: str, words: int, similar: int) -> DataFrame:
    """(id, n, key, sig, lists) of every document with an id; ``lists`` holds the short lists' shingles."""
    def run(batches):
        freq = table.value
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column(1).to_pylist(), words)
                short = [rarest(s, freq, similar).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets]
                offsets = np.concatenate(([0], np.cumsum([len(s) for s in short]))).astype(np.int32)
                values = np.concatenate(short) if short else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) if len(s) else 0 for s in sets], pa.int64()),
                    pa.array([signature(s) if len(s) else 0 for s in sets], pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                    names=["id", "n", "key", "sig", "lists"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    return rows.mapInArrow(run, "id bigint, n bigint, key bigint, sig int, lists array<bigint>")


def _neighbour_edges(classes: DataFrame, table, parts: int, similar: int) -> DataFrame:
    """Edges (a, b) that put together all classes that may link: those that share enough of
    their short lists' shingles, and some more."""
    # size and signature in one column, as the size comes first in the lists' order
    postings = classes.select(F.col("id").alias("a"), F.expr("n * 65536 + sig").alias("w"), F.explode("lists").alias("t"))

    def salted(batches):
        """The salt of a heavy list's posting, else -1."""
        freq = table.value
        shift = np.uint64(64 - SKETCH_BITS)
        for batch in batches:
            a, t = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            f = count_of(freq[(t.view(np.uint64) >> shift).astype(np.int64)])
            with np.errstate(over="ignore"):
                salt = (mix(a.view(np.uint64) ^ t.view(np.uint64)) % (f // HEAVY + 1).astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.where(f >= HEAVY, salt, np.int32(-1)))], names=["a", "w", "t", "salt"])

    dealt = postings.mapInArrow(salted, "a bigint, w bigint, t bigint, salt int").repartition(parts, "t", "salt").sortWithinPartitions("t", "salt", "w", "a")
    kind = "a bigint, b bigint, t bigint, band int, need int"

    def walk(batches):
        """One forest for the task's lists; pairs to be counted go on as (a, b, need), and heads of
        heavy lists' bands as (t, band, a), one for each salt."""
        forest = Forest()
        heads: dict[tuple, int] = {}
        xs: list[int] = []
        ys: list[int] = []
        needs: list[int] = []

        def rows(a, b, t=None, band=None, need=None):
            n = len(a)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.nulls(n, pa.int64()) if b is None else pa.array(b, pa.int64()),
                                               pa.nulls(n, pa.int64()) if t is None else pa.array(t, pa.int64()), pa.nulls(n, pa.int32()) if band is None else pa.array(band, pa.int32()),
                                               pa.nulls(n, pa.int32()) if need is None else pa.array(need, pa.int32())], names=["a", "b", "t", "band", "need"])

        def short(members):
            """Unite or count the pairs of a list, which ascends by size."""
            open_pairs, lo = [], 0
            for i, (a, w) in enumerate(members):
                n = w >> 16
                while 100 * (members[lo][1] >> 16) < similar * n:
                    lo += 1
                for b, v in members[lo:i]:
                    if a != b:
                        need = least_shared(n, v >> 16, similar)
                        if need <= 1 or _AGREE[(w ^ v) & 65535]:
                            forest.union(a, b)
                        else:
                            open_pairs.append((a, b, need))
            for a, b, need in open_pairs:
                if forest.find(a) != forest.find(b):
                    xs.append(max(a, b))
                    ys.append(min(a, b))
                    needs.append(need)

        def joined(members, at, head):
            """Unite a long list's neighbouring bands, whose heads so far are ``head``."""
            for a, w in members:
                band = _band(w >> 16, similar)
                if band not in head:
                    head[band] = a
                    if at[1] >= 0:
                        heads[(*at, band)] = a  # a task may hold several salts of a list
                    if band - 1 in head:
                        forest.union(a, head[band - 1])
                else:
                    forest.union(a, head[band])

        def done(members, at, head):
            if head is not None or members and at[1] >= 0:
                joined(members, at, {} if head is None else head)
            elif len(members) > 1:
                short(members)

        now, members, head = None, [], None
        for batch in batches:
            t, salt = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            if not len(t):
                continue
            # lists of one posting go, but those at the batch's ends may go on, and heavy ones have heads
            same = (t[1:] == t[:-1]) & (salt[1:] == salt[:-1])
            keep = np.flatnonzero(np.concatenate(([True], same)) | np.concatenate((same, [True])) | (salt >= 0))
            for a, w, *at in zip(batch.column(0).to_numpy()[keep].tolist(), batch.column(1).to_numpy()[keep].tolist(), t[keep].tolist(), salt[keep].tolist()):
                if at != now:
                    done(members, now, head)
                    now, members, head = at, [], None
                members.append((a, w))
                if len(members) > LONG:
                    head = {} if head is None else head
                    joined(members, now, head)
                    members = []
            if len(xs) > PAIRS:
                yield rows(xs, ys, need=needs)
                del xs[:], ys[:], needs[:]
            if len(forest.parent) > FOREST_NODES:
                yield rows(*forest.stars())
                forest.parent.clear()
        done(members, now, head)
        keys = list(heads)
        yield rows(xs, ys, need=needs)
        yield rows(*forest.stars())
        yield rows([heads[k] for k in keys], None, [k[0] for k in keys], [k[2] for k in keys])

    met = dealt.mapInArrow(walk, kind).groupBy("a", "b", "t", "band", "need").agg(F.count("*").alias("lists"))
    found = stored(met.where("need is null or lists >= need").select("a", "b", "t", "band"), "neighbours")
    # heads of a heavy list's salts: those of one band meet at the smallest, and with the next band's
    heads = found.where(F.col("t").isNotNull()).select("t", "band", "a")
    low = heads.groupBy("t", "band").agg(F.min("a").alias("b"))
    own = heads.join(low, ["t", "band"]).select("a", "b")
    up = low.select("t", (F.col("band") + 1).alias("band"), F.col("b").alias("a")).join(low, ["t", "band"]).select("a", "b")
    return found.where(F.col("t").isNull()).select("a", "b").union(own).union(up)


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int, extra: list[str]) -> DataFrame:
    """The whole sets of the documents in ``wanted`` (id, key, ...): id, extra columns, set (binary).
    A row whose text has another key (an id used twice) is left out."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    picked = join_ids(rows, wanted, "id")
    kinds = "".join(f", {c} {wanted.schema[c].dataType.simpleString()}" for c in extra)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column(part.schema.get_field_index("text")).to_pylist(), words)
                keys = part.column(part.schema.get_field_index("key")).to_pylist()
                keep = pa.array([i for i, (s, k) in enumerate(zip(sets, keys)) if len(s) and set_key(s) == k], pa.int64())
                cols = [part.column(part.schema.get_field_index(c)).take(keep) for c in ("id", *extra)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([sets[i].tobytes() for i in keep.to_pylist()], pa.binary())], names=["id", *extra, "set"])

    return picked.select("id", "key", *extra, "text").mapInArrow(run, f"id bigint{kinds}, set binary")


def _searched(rows: DataFrame, unit: list[str], parts: int, similar: int, block: str | None = None, name: str = "id") -> DataFrame:
    """Search each unit's sets; edges (a, b) of the found forests. Rows: unit columns, id, set. With
    ``block``, only pairs of different blocks; sets with the same ``name`` are linked already."""
    keys = len(unit)
    cols = [*unit, "id", "set", *([block] if block else []), *([name] if name != "id" else [])]

    def run(batches):
        def units():
            now, ids, sets, blocks, names = None, [], [], [], []
            for batch in batches:
                for row in zip(*(batch.column(i).to_pylist() for i in range(len(cols)))):
                    if row[:keys] != now:
                        if ids:
                            yield names, sets, blocks
                        now, ids, sets, blocks, names = row[:keys], [], [], [], []
                    if ids and ids[-1] == row[keys]:
                        continue  # a repeated row
                    ids.append(row[keys])
                    sets.append(np.frombuffer(row[keys + 1], np.uint64))
                    blocks.append(row[keys + 2] if block else 0)
                    names.append(row[-1] if name != "id" else row[keys])
            if ids:
                yield names, sets, blocks

        search = Search(similar)
        for names, sets, blocks in units():
            forest = Forest()
            search.links(sets, forest, names, blocks if block else None)
            a, b = forest.stars()
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.select(*cols).repartition(parts, *unit).sortWithinPartitions(*unit, "id").mapInArrow(run, "a bigint, b bigint")


def _large(docs: DataFrame, members: DataFrame, parts: int, id_col: str, text_col: str, words: int, similar: int, unit: int) -> DataFrame:
    """Links within neighbourhoods too large for one task, whose sets are searched in blocks."""
    sets = stored(_sets_of(docs, members.select("id", "key", "near"), id_col, text_col, words, ["near"]).withColumn("n", F.expr("octet_length(set) div 8")), "large")

    def dealt(rows, salt):
        """``rows`` with their block, one of ``blocks`` of half a unit at most on average: two of them make a unit."""
        blocks = rows.groupBy("near").agg(F.sum("n").alias("all")).select("near", F.ceil(F.col("all") / F.lit(max(1, unit // 2))).cast("int").alias("blocks"))
        return join_ids(rows, blocks, "near").withColumn("block", F.pmod(F.xxhash64("id", F.lit(salt)), F.col("blocks")).cast("int"))

    def classed(rows):
        return rows.join(classes, "id", "left").withColumn("component", F.coalesce("component", "id"))

    edges = stored(_searched(dealt(sets, 0), ["near", "block"], parts, similar), "links")
    classes = components(edges).withColumnRenamed("node", "id")
    heads, salt = sets.count() - edges.count(), 0
    while True:
        # the smallest member of each component, in new blocks
        salt += 1
        more = stored(_searched(dealt(classed(sets).where("component = id").select("near", "id", "n", "set"), salt), ["near", "block"], parts, similar), "links")
        linked = more.count()
        heads -= linked
        if linked:
            edges = edges.union(more)
            classes = components(edges).withColumnRenamed("node", "id")
        if linked <= heads:  # fewer than half of them
            break
    # the rest: sets in lists of several components, for those pairs of blocks that such a list has
    blocks = stored(dealt(sets, 0).select("near", "id", "block"), "blocks")
    placed = stored(classed(members.select("id", F.explode("lists").alias("t"))), "lists")
    several = placed.groupBy("t").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("t")
    left = stored(placed.join(several, "t", "left_semi").join(blocks, "id"), "left")
    span = left.groupBy("near", "t", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    other = span.select("near", "t", F.col("block").alias("j"), F.col("lo").alias("lo_j"), F.col("hi").alias("hi_j"))
    needed = span.withColumnRenamed("block", "i").join(other, ["near", "t"]).where("i < j and (lo != hi or lo_j != hi_j or lo != lo_j)").select("near", "i", "j").distinct()
    sent = left.select("near", "id", "block", "component").distinct().join(needed.select("*", F.explode(F.array("i", "j")).alias("block")), ["near", "block"])
    units = sets.select("id", "set").join(sent, "id")
    return edges.union(stored(_searched(units, ["near", "i", "j"], parts, similar, "block", "component"), "links"))


def _links(docs: DataFrame, classes: DataFrame, table, id_col: str, text_col: str, words: int, similar: int, unit: int) -> list[DataFrame]:
    """Tables of links (a, b) between classes (id, key, n, lists) of ``docs``."""
    spark = docs.sparkSession
    parts = n_buckets(spark)
    near = components(_neighbour_edges(classes, table, parts, similar), "neighbourhoods")
    members = stored(join_ids(classes.select("id", "key", "n"), near.select(F.col("node").alias("id"), F.col("component").alias("near")), "id"), "members")
    sizes = members.groupBy("near").agg(F.sum("n").alias("all"))
    large = stored(sizes.where(F.col("all") > unit), "large")
    normal = members.join(large, "near", "left_anti").select("id", "key", "near")
    out = [stored(_searched(_sets_of(docs, normal, id_col, text_col, words, ["near"]), ["near"], parts, similar), "links")]
    in_large = large.agg(F.sum("all")).first()[0]
    if in_large:
        big = members.join(large, "near", "left_semi")
        if 2 * in_large > classes.agg(F.sum("n")).first()[0]:
            return [*out, _large(docs, big.join(classes.select("id", "key", "lists"), ["id", "key"]), parts, id_col, text_col, words, similar, unit)]
        rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
        sub = stored(join_ids(rows, big.select("id").distinct(), "id", "left_semi"), "again")
        finer = spark.sparkContext.broadcast(frequencies(sub, "text", words))
        again = prepare(sub, finer, "id", "text", words, similar).join(big.select("id", "key"), ["id", "key"], "left_semi").dropDuplicates(["id"])
        out += _links(sub, stored(again.select("id", "key", "n", "sig", "lists"), "classes"), finer, "id", "text", words, similar, unit)
    return out


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similar: int = SIMILAR, unit: int = UNIT) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id reachable by links)."""
    small_batches(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(frequencies(docs, text_col, words))
    sets = stored(prepare(docs, table, id_col, text_col, words, similar), "sets")
    # grouped anew where needed: only the first use reads the lists
    classes = sets.where("n > 0").groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("lists").alias("lists"))
    links = _links(docs, classes, table, id_col, text_col, words, similar, unit)
    linked = components(reduce(DataFrame.union, links), "linked")
    of_key = classes.select("key", "id").join(linked.withColumnRenamed("node", "id"), "id", "left").select("key", F.coalesce("component", "id").alias("component_id"))
    placed = sets.select("id", "n", "key").join(of_key, "key", "left")
    got = placed.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    without = docs.where(F.col(id_col).cast("bigint").isNull()).select(F.lit(None).cast("bigint").alias(id_col), F.col(text_col).alias("_t"))

    def count(batches):
        for batch in batches:
            for part in slices(batch, "_t"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in shingle_sets(part.column(1).to_pylist(), words)], pa.int64()), part.column(0)],
                                                 names=[id_col, "n_shingles", "component_id"])

    return got.unionByName(without.mapInArrow(count, f"{id_col} bigint, n_shingles bigint, component_id bigint"))
