"""Spelling variants by k-d trees over letter-count vectors.

Two words are near if one inserted, deleted or replaced letter makes one from the
other. A word's letters counted by kind are a point; a replaced letter moves it by two
in all (L1), an inserted or deleted one by one. So the near words of a word of length n
lie within two among the words of length n, and within one among those of length n - 1
and n + 1: three range searches in k-d trees, one for each pair of lengths, in which a
box further away than that is not entered. What a box's words have left to differ is
then checked letter by letter.

Words are dealt to tasks by trees of the same kind over a bounded sample of words
(``SAMPLE``), whose boxes are the cells. A word lies in one cell and is sent to every
later cell (of its length, or of one letter more) that its searches reach, so a pair
meets once. A task builds the k-d tree of a cell's words, searches it for those words
themselves, then for the visiting words as they come. A cell with too many words (of
one point, say) is split by a hash, and visited in all its parts. A task passes on one
row for a word that found others: how many, and which of them is the most frequent.

A word's form is its most frequent near word, where that is ``TIMES`` times as
frequent; forms of forms are followed to the last, doubling the step.

Defined cases: null and empty texts have no words; a null id counts as an empty one
where letters are left out; repeated rows are counted each; an empty table gives no
rows; ties go to the smaller word in code-point order; words of any length are words;
further columns are not read.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampwise.llm.common import SLICE_CHARS, hash_sample, n_buckets, slices, small_batches, stored

#: Letters of a word at least, occurrences of a word at least, and how much more frequent a form is.
CHARS, OCCURRENCES, TIMES = 7, 2, 10
#: Words of a cell (about) and of a box that is not cut; words that the cells are drawn from.
CELL, BOX, SAMPLE = 32_768, 12, 60_000
#: Words that a task counts before it passes them on; visiting words searched for at once.
COUNTED_AT_ONCE, VISITING = 400_000, 20_000
#: Pairs checked letter by letter at once.
PAIRS = 200_000

#: The letters: a to z and U+00C0 to U+00FF.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_DIM = np.zeros(0x100, np.uint8)
_DIM[LETTERS] = np.arange(len(LETTERS))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", left_out: int | None = None,
                chars: int = CHARS, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): the maximal runs of letters, A to Z lower-cased, with at least ``chars`` letters
    and ``occurrences`` over all texts. With ``left_out``, a letter of a run is left out where that
    number divides the crc32 of ``id:run`` (the letter that crc32 points to)."""
    import pyarrow as pa
    small_batches(docs.sparkSession)
    least = chars

    def run(batches):
        from collections import Counter
        find = re.compile(r"[a-zÀ-ÿ]{%d,}" % least).findall
        counts: Counter = Counter()

        def flush():
            words = list(counts)
            for i in range(0, len(words), 50_000):
                part = words[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[w] for w in part], pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for part in slices(batch, text_col, SLICE_CHARS):
                for key, text in zip(part.column(0), part.column(1)):
                    t = text.as_py()
                    if not t:
                        continue
                    found = Counter(find(t.encode("utf-8").lower().decode("utf-8")))  # bytes: A to Z alone
                    if left_out:
                        base = crc32(f"{'' if key.as_py() is None else key.as_py()}:".encode())
                        for w, c in found.items():
                            h = crc32(w.encode("utf-8"), base)
                            if h % left_out == 0:
                                at = h % len(w)
                                w = w[:at] + w[at + 1:]
                                if len(w) < least:
                                    continue
                            counts[w] += c
                    else:
                        counts.update(found)
                    if len(counts) > COUNTED_AT_ONCE:
                        yield from flush()
        yield from flush()

    counted = docs.select(F.col(id_col), F.col(text_col)).toDF("id", text_col).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


class Words:
    """Words of one length as codes, letter counts by letter, and the parity of the counts."""

    def __init__(self, words: list[str]) -> None:
        n, m = len(words), len(words[0]) if words else 0
        self.codes = _DIM[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(n, m)
        kind = np.int16 if m < 1 << 14 else np.int32
        self.counts = np.zeros((len(LETTERS), n), kind)
        for j in range(m):
            self.counts[self.codes[:, j], np.arange(n)] += 1  # one letter of each word, so no cell twice
        bit = np.uint64(1) << (np.arange(len(LETTERS), dtype=np.uint64) % np.uint64(64))
        self.parity = np.zeros(n, np.uint64)
        for j in range(m):
            self.parity ^= bit[self.codes[:, j]]


class Tree:
    """A k-d tree over letter counts (letters by points) with boxes of at most ``box`` points, but
    for points that are all equal."""

    def __init__(self, counts: np.ndarray, box: int) -> None:
        #: for each node its letter, cut, the node's range of that letter, and its children; a leaf has letter -1 and its number
        self.nodes: list[tuple] = []
        self.leaves: list[np.ndarray] = []
        some = np.flatnonzero(counts.any(1)) if counts.shape[1] else np.arange(0)
        counts = counts[some]
        low, high = np.zeros(len(some), np.int64), np.full(len(some), np.iinfo(counts.dtype).max // 2)
        todo = [(np.arange(counts.shape[1]), low, high, -1, 0)]
        while todo:
            idx, low, high, parent, side = todo.pop()
            me = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][4 + side] = me
            cut = self._cut(counts, idx) if len(idx) > box else None
            if cut is None:
                self.nodes.append([-1, len(self.leaves), 0, 0, 0, 0])
                self.leaves.append(idx)
                continue
            d, t = cut
            self.nodes.append([int(some[d]), t, int(low[d]), int(high[d]), 0, 0])
            right = counts[d, idx] >= t
            low2, high2 = low.copy(), high.copy()
            high2[d], low2[d] = t - 1, t
            todo.append((idx[right], low2, high, me, 1))
            todo.append((idx[~right], low, high2, me, 0))

    @staticmethod
    def _cut(counts: np.ndarray, idx: np.ndarray):
        """The letter and count that divide the points most evenly."""
        x, best, at = counts[:, idx], len(idx), None
        t = 1
        while True:
            share = np.count_nonzero(x >= t, axis=1)
            if not share.any():
                return at
            off = np.abs(2 * share - len(idx))
            d = int(np.argmin(off))
            if off[d] < best:
                best, at = int(off[d]), (d, t)
            t += 1
            if t > 3 and at is not None:
                return at
            if t > 3:  # rare: only high counts tell the points apart
                top = x.max(1)
                differ = np.flatnonzero(top != x.min(1))
                if not len(differ):
                    return None
                d = int(differ[0])
                return d, int(top[d])

    def reach(self, counts: np.ndarray, within: int):
        """(leaf, points) for every leaf whose box lies within an L1 distance of some of the points."""
        todo = [(0, np.arange(counts.shape[1]), np.full(counts.shape[1], within, counts.dtype))]
        while todo:
            node, who, left = todo.pop()
            d, t, low, high, a, b = self.nodes[node]
            if d < 0:
                yield t, who
                continue
            # the distance within this letter so far gives way to that from the child's range
            v = counts[d, who]
            to_a = left + np.maximum(v - high, 0) - np.maximum(v - (t - 1), 0)
            to_b = left + np.maximum(low - v, 0) - np.maximum(t - v, 0)
            for child, rest in ((a, to_a), (b, to_b)):
                go = np.flatnonzero(rest >= 0)
                if len(go):
                    todo.append((child, who[go], rest[go]))


def one_letter_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, whether one edit makes one word from the other; the lengths differ by one at most."""
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    n = a.shape[1]
    if n == b.shape[1]:
        return np.count_nonzero(a != b, axis=1) == 1
    front = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= n


class Cell:
    """A cell's words in their k-d tree."""

    def __init__(self, words: list[str], n: list[int]) -> None:
        self.names, self.n = np.array(words, object), np.array(n, np.int64)
        self.words = Words(words)
        self.tree = Tree(self.words.counts, BOX)

    def near(self, asking: Words) -> tuple[np.ndarray, np.ndarray]:
        """(asking word, word of the cell) for all near pairs."""
        mine = self.words
        within = 2 if asking.codes.shape[1] == mine.codes.shape[1] else 1
        found, held, waiting = [], 0, []

        def check():
            q, p = (np.concatenate(c) for c in zip(*waiting))
            ok = one_letter_apart(asking.codes[q], mine.codes[p])
            found.append((q[ok], p[ok]))
            waiting.clear()

        for leaf, who in self.tree.reach(asking.counts, within):
            points = self.tree.leaves[leaf]
            step = max(1, PAIRS // max(1, len(points)))
            for lo in range(0, len(who), step):
                some = who[lo:lo + step]
                for at in range(0, len(points), PAIRS):
                    to = points[at:at + PAIRS]
                    i, j = np.nonzero(np.bitwise_count(asking.parity[some][:, None] ^ mine.parity[to]) <= within)
                    waiting.append((some[i], to[j]))
                    held += len(i)
                    if held * asking.codes.shape[1] >= 16 * PAIRS:
                        check()
                        held = 0
        if waiting:
            check()
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))

    def answers(self, words: list[str] | None = None, n: list[int] | None = None) -> tuple[list[str], list[int], list[int], list[str]]:
        """Words with near words, how many these are, and the most frequent: of the cell's words
        among themselves, or of visiting words (of one length) and the cell's."""
        if words is None:
            return self._told(self.names, *self.near(self.words), self.names, self.n)
        names, n_ = np.array(words, object), np.array(n, np.int64)
        q, p = self.near(Words(words))
        return tuple(a + b for a, b in zip(self._told(names, q, p, self.names, self.n), self._told(self.names, p, q, names, n_)))

    @staticmethod
    def _told(to: np.ndarray, q: np.ndarray, p: np.ndarray, names: np.ndarray, n: np.ndarray) -> tuple[list[str], list[int], list[int], list[str]]:
        if not len(q):
            return [], [], [], []
        rank = np.empty(len(names), np.int64)
        rank[np.lexsort((names.astype(str), -n))] = np.arange(len(names))
        by = np.lexsort((rank[p], q))
        q, p = q[by], p[by]
        start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        top = p[start]
        return to[q[start]].tolist(), np.diff(np.append(start, len(q))).tolist(), n[top].tolist(), names[top].tolist()


def cells(counts: DataFrame) -> dict[int, Tree]:
    """For each length, the tree whose boxes are its cells, drawn from a bounded sample of words."""
    total = counts.count()
    sample = [r[0] for r in hash_sample(counts.select("word"), SAMPLE, F.col("word")).collect()]
    by_length: dict[int, list[str]] = {}
    for w in sample:
        by_length.setdefault(len(w), []).append(w)
    box = max(1, int(CELL * len(sample) / max(1, total)))
    return {m: Tree(Words(ws).counts, box) for m, ws in by_length.items()}


def _lengths(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


def _reached(trees: dict[int, Tree], words: list[str], length: int, within: int):
    """(cell, numbers of the words) for the cells of ``length`` that words of one length reach."""
    if length not in trees:
        yield length << 24, np.arange(len(words))
    else:
        for leaf, who in trees[length].reach(Words(words).counts, within):
            yield length << 24 | leaf, who


def near_words(counts: DataFrame) -> DataFrame:
    """(word, n_near, top_n, top): for words with near words, how many, and the most frequent
    (the smallest of equal ones)."""
    import pyarrow as pa
    spark = counts.sparkSession
    trees = spark.sparkContext.broadcast(cells(counts))

    def homes(batches):
        from collections import Counter
        sizes: Counter = Counter()
        for b in batches:
            words = b.column(0).to_pylist()
            for m, idx in _lengths(words).items():
                for cell, who in _reached(trees.value, [words[i] for i in idx], m, 0):
                    sizes[cell] += len(who)
        yield pa.RecordBatch.from_arrays([pa.array(list(sizes), pa.int64()), pa.array(list(sizes.values()), pa.int64())], names=["cell", "n"])

    # a row a cell; only the cells that came out too full are sent to the tasks
    full = counts.select("word").mapInArrow(homes, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    parts = {r["cell"]: -(-r["n"] // CELL) for r in full if r["n"] > 2 * CELL}

    def deal(batches):
        for b in batches:
            words, n = b.column(0).to_pylist(), b.column(1).to_pylist()
            for m, idx in _lengths(words).items():
                some = [words[i] for i in idx]
                out: dict[str, list] = {"cell": [], "part": [], "visits": [], "word": [], "n": []}

                def add(cell, part, visits, i):
                    out["cell"].append(cell)
                    out["part"].append(part)
                    out["visits"].append(visits)
                    out["word"].append(some[i])
                    out["n"].append(n[idx[i]])

                home = np.zeros(len(some), np.int64)
                for cell, who in _reached(trees.value, some, m, 0):
                    home[who] = cell
                    for i in who.tolist():
                        own = crc32(some[i].encode()) % parts.get(cell, 1)
                        add(cell, own, False, i)
                        for part in range(own + 1, parts.get(cell, 1)):
                            add(cell, part, True, i)
                for length, within in ((m, 2), (m + 1, 1)):
                    for cell, who in _reached(trees.value, some, length, within):
                        for i in who[home[who] < cell].tolist():
                            for part in range(parts.get(cell, 1)):
                                add(cell, part, True, i)
                yield pa.RecordBatch.from_arrays([pa.array(out["cell"], pa.int64()), pa.array(out["part"], pa.int32()), pa.array(out["visits"], pa.bool_()),
                                                  pa.array(out["word"], pa.string()), pa.array(out["n"], pa.int64())], names=list(out))

    def search(batches):
        at, cell, words, n = None, None, [], []

        def rows(cols):
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                                              names=["word", "n_near", "top_n", "top"])

        def work():
            """The words held are a cell's own, or visitors of the cell that stands."""
            nonlocal cell
            if words and cell is None:
                cell = Cell(words, n)
                yield rows(cell.answers())
            elif words and cell:
                for idx in _lengths(words).values():
                    yield rows(cell.answers([words[i] for i in idx], [n[i] for i in idx]))
            words.clear()
            n.clear()

        for b in batches:
            for key, part, visits, word, k in zip(*(c.to_pylist() for c in b.columns)):
                if (key, part) != at:
                    yield from work()
                    at, cell = (key, part), None
                if visits and cell is None:
                    yield from work()
                    cell = cell or False  # False: a cell without words
                words.append(word)
                n.append(k)
                if visits and len(words) >= VISITING:
                    yield from work()
        yield from work()

    dealt = counts.select("word", "n").mapInArrow(deal, "cell bigint, part int, visits boolean, word string, n bigint")
    tasks = max(n_buckets(spark), 2 * (len(full) + sum(parts.values())))
    found = dealt.repartition(tasks, "cell", "part").sortWithinPartitions("cell", "part", "visits").mapInArrow(search, "word string, n_near bigint, top_n bigint, top string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("top_n")).alias("less"), "top")).alias("_t")).select(
        "word", "n_near", (-F.col("_t.less")).alias("top_n"), F.col("_t.top").alias("top"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last. A form is more frequent than its
    word by a factor, so chains are short and never close."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_up"))
        step = stored(reached.join(further, "root", "left").select("word", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_on")), "variant-roots")
        reached = step.select("word", "root")
        if not step.where("_on").limit(1).count():
            return reached


def group(counts: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of words with their occurrences."""
    counts = stored(counts, "variant-words")
    near = near_words(counts)
    formed = stored(counts.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("top_n") >= times * F.col("n"), F.col("top")).alias("form"), F.when(F.col("top_n") >= times * F.col("n"), F.col("top_n")).alias("form_n")), "variant-forms")
    last = roots(formed.where("form is not null"))
    return formed.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
