"""Benchmark decontamination with suffix arrays of the training text.

Each shard of training documents (a slice of a task's rows) gets a suffix array
over its words, built in numpy by prefix doubling. Every suffix of every
benchmark item is looked up by binary search, all suffixes of all items side by
side, which yields its longest verbatim match in the shard. For suffixes that
match a whole window (``window`` words, or the whole item if it has fewer) a
second search gives the range of the array that holds all its occurrences, from
which hit words, contaminated documents, items and each item's longest match in
a document follow.

A training word that no benchmark item holds ends every match, and a run of
known words shorter than the shortest window cannot hold one. The array is
therefore built over the runs of known words that are long enough; nothing that
could match a window is left out; matches are thus found from the shortest
window's length on.

The benchmark reaches workers by broadcast in blocks of items of at most
``BLOCK_WORDS`` words; every block passes over all documents, and what the
blocks find is joined per document.

Defined cases: null and empty texts have no words; an item without words has no
window; repeated rows are separate documents with equal results; without
documents or items no hit is found; an item that occurs twice in the benchmark
counts by its distinct id; columns beyond those named are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampwise.llm.common import append_columns, fresh

WINDOW = 13
#: Words of a block of benchmark items that is broadcast.
BLOCK_WORDS = 2_000_000

# words are runs of [0-9a-z] and of characters from U+0080 on
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words (ASCII case only)."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Tests:
    """A block of benchmark items: word numbers (from 1) of all items, each followed by 0."""

    def __init__(self, items: list[tuple], window: int = WINDOW) -> None:
        self.number: dict[bytes, int] = {}
        self.ids: list[str] = []
        flat, starts, sizes = [], [], []
        for key, text in items:
            w = words_of(text)
            if not w:
                continue
            self.ids.append(str(key))
            starts.append(len(flat))
            sizes.append(len(w))
            flat += [self.number.setdefault(x, len(self.number) + 1) for x in w] + [0]
        self.flat = np.array(flat or [0], np.int32)
        self.starts, self.sizes = np.array(starts, np.int64), np.array(sizes, np.int64)
        # every window of every item: where it starts, its length, its item
        at, size, item = [], [], []
        for k, (s, n) in enumerate(zip(starts, sizes)):
            w = min(window, n)
            at += range(s, s + n - w + 1)
            size += [w] * (n - w + 1)
            item += [k] * (n - w + 1)
        self.at, self.size, self.item = np.array(at, np.int64), np.array(size, np.int64), np.array(item, np.int64)
        self.shortest = int(self.size.min()) if len(self.size) else 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in ascending order, by prefix doubling; a smaller suffix at the end comes first."""
    n = len(text)
    rank = text.astype(np.int64)
    span = 1
    order = np.argsort(rank, kind="stable")
    while True:
        follow = np.full(n, -1, np.int64)
        follow[:max(0, n - span)] = rank[span:]
        key = rank * (int(rank.max(initial=0)) + 2 if span == 1 else n + 1) + (follow + 1)
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
        rank, span = new, span * 2
        if n == 0 or rank[order[-1]] == n - 1 or span >= n:
            return order


def search(text: np.ndarray, order: np.ndarray, query: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For queries ``query[at:at + size]`` the range [lo, hi) of ``order`` whose suffixes begin
    with the whole query; all queries take each step of the binary search together."""
    n, longest = len(text), int(size.max(initial=0))
    padded = np.concatenate([text, np.full(longest + 1, -1, text.dtype)])

    def bound(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), n, np.int64)
        while True:
            live = lo < hi
            if not live.any():
                return lo
            mid = (lo + hi) >> 1
            suffix = order[np.minimum(mid, n - 1)]
            sign = np.zeros(len(at), np.int8)  # suffix against query
            for j in range(longest):
                open_ = (sign == 0) & (j < size) & live
                if not open_.any():
                    break
                d = padded[suffix[open_] + j] - query[at[open_] + j]
                sign[open_] = np.sign(d)
            below = (sign < 0) | (upper & (sign == 0))
            lo = np.where(live & below, mid + 1, lo)
            hi = np.where(live & ~below, mid, hi)

    return bound(False), bound(True)


def longest_matches(text: np.ndarray, order: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every suffix of every item: (place in tests.flat, longest match in words, a place in
    the text). The longest common prefix is with a neighbour of the suffix in the array."""
    at = np.concatenate([np.arange(s, s + n) for s, n in zip(tests.starts, tests.sizes)]) if len(tests.starts) else np.empty(0, np.int64)
    size = np.concatenate([np.arange(n, 0, -1) for n in tests.sizes]) if len(tests.starts) else np.empty(0, np.int64)
    best, place = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
    n = len(text)
    if not n or not len(at):
        return at, best, place
    lo, _ = search(text, order, tests.flat, at, size)
    padded = np.concatenate([text, np.full(int(size.max()) + 1, -1, text.dtype)])
    for side in (-1, 0):
        k = lo + side
        ok = (k >= 0) & (k < n)
        start = order[np.clip(k, 0, n - 1)]
        length, going = np.zeros(len(at), np.int64), ok.copy()
        for j in range(int(size.max())):
            going &= j < size
            if not going.any():
                break
            going[going] = padded[start[going] + j] == tests.flat[at[going] + j]
            length[going] += 1
        better = length > best
        best[better], place[better] = length[better], start[better]
    return at, best, place


class Shard:
    """The known-word runs of some documents, with the document and word of each place."""

    def __init__(self, texts: list, tests: Tests) -> None:
        get = tests.number.get
        flat: list[int] = []
        n_words = []
        for t in texts:
            w = words_of(t)
            n_words.append(len(w))
            flat.append(0)
            flat += [get(x, 0) for x in w]
        flat.append(0)
        a = np.array(flat, np.int32)
        self.n_words = np.array(n_words, np.int64)
        first = np.cumsum(self.n_words + 1) - self.n_words  # place of each document's first word
        zero = np.flatnonzero(a == 0)
        run = np.diff(zero) - 1
        long = np.flatnonzero(run >= max(1, tests.shortest)) if tests.shortest else np.empty(0, np.int64)
        places = [np.arange(zero[i] + 1, zero[i] + run[i] + 2) for i in long]  # with the 0 that ends the run
        self.place = np.concatenate(places) if places else np.empty(0, np.int64)
        self.text = a[self.place]
        self.doc = np.searchsorted(first, self.place, side="right") - 1
        self.word = self.place - first[self.doc] if len(self.place) else self.place
        self.order = suffix_array(self.text) if len(self.text) else np.empty(0, np.int64)

    def occurrences(self, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, document, first word) of every occurrence of a window."""
        none = np.empty(0, np.int64)
        if not len(self.text) or not len(tests.at):
            return none, none, none
        at, best, _ = longest_matches(self.text, self.order, tests)
        whole = np.flatnonzero(best[np.searchsorted(at, tests.at)] >= tests.size)  # suffixes that match their window
        if not len(whole):
            return none, none, none
        lo, hi = search(self.text, self.order, tests.flat, tests.at[whole], tests.size[whole])
        count = hi - lo
        window = np.repeat(whole, count)
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        at = self.order[k]
        return window, self.doc[at], self.word[at]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """Items in blocks of bounded size, streamed to the driver one partition at a time."""
    block, size = [], 0
    for r in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        n = len(words_of(r[1]))
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += n
    yield block


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
         window: int = WINDOW, out: str = "contamination") -> DataFrame:
    """Append ``out``: struct(n_words, hits, items, matches). ``hits`` are the hit words as
    ranges [first, end), ``items`` the ids of items with an occurring window, ``matches``
    the longest verbatim match of each such item with its place in the document
    (item, its first word, the document's first word, words). Several blocks of items
    give one pass each; their finds are united in ``out``."""
    match = "array<struct<item:string,item_word:int,word:int,words:int>>"
    spec = f"struct<n_words:bigint,hits:array<struct<first:int,end:int>>,items:array<string>,matches:{match}>"
    names, got = [], docs.drop(out)
    for items in _blocks(benchmark, item_col, item_text):
        name = fresh(got, out)
        got = append_columns(got, text_col, [(name, spec)], _maker(docs.sparkSession.sparkContext.broadcast(Tests(items, window)), name))
        names.append(name)
    if len(names) == 1:
        return got if names[0] == out else got.withColumnRenamed(names[0], out)
    united = F.struct(
        F.col(f"{names[0]}.n_words").alias("n_words"),
        F.flatten(F.array(*(F.col(f"{n}.hits") for n in names))).alias("hits"),
        F.array_distinct(F.flatten(F.array(*(F.col(f"{n}.items") for n in names)))).alias("items"),
        F.flatten(F.array(*(F.col(f"{n}.matches") for n in names))).alias("matches"))
    return got.withColumn(out, united).drop(*(n for n in names if n != out))


def _maker(shared, name: str):
    def make():
        tests = shared.value

        def fn(texts: list) -> dict:
            shard = Shard(texts, tests)
            window, doc, word = shard.occurrences(tests)
            rows = [{"n_words": int(n), "hits": [], "items": [], "matches": []} for n in shard.n_words]
            if len(doc):
                order = np.lexsort((word, doc))
                window, doc, word = window[order], doc[order], word[order]
                end = word + tests.size[window]
                for d in np.unique(doc):
                    s = slice(*np.searchsorted(doc, [d, d + 1]))
                    rows[d]["hits"] = ranges(word[s], end[s])
                    items = tests.item[window[s]]
                    rows[d]["items"] = sorted({tests.ids[i] for i in items})
                    rows[d]["matches"] = joined(window[s], word[s], tests)
            return {name: rows}
        return fn
    return make


def ranges(first: np.ndarray, end: np.ndarray) -> list[dict]:
    """The union of ranges given in ascending order of their first word."""
    out: list[list[int]] = []
    for a, b in zip(first.tolist(), end.tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"first": a, "end": b} for a, b in out]


def joined(window: np.ndarray, word: np.ndarray, tests: Tests) -> list[dict]:
    """The longest match of each item in a document: occurrences of neighbouring windows of an
    item, one word apart in both texts, are one match."""
    item = tests.item[window]
    offset = tests.at[window] - tests.starts[item]
    order = np.lexsort((offset, word - offset, item))
    best: dict[str, tuple] = {}
    last = None
    for i in order.tolist():
        k, o, w, n = int(item[i]), int(offset[i]), int(word[i]), int(tests.size[window[i]])
        if last and last[0] == k and last[2] - last[1] == w - o and o == last[4] + 1:
            last = (k, last[1], last[2], o + n - last[1], o)
        else:
            last = (k, o, w, n, o)
        key = tests.ids[k]
        if key not in best or last[3] > best[key][3]:
            best[key] = last
    return [{"item": key, "item_word": m[1], "word": m[2], "words": m[3]} for key, m in sorted(best.items())]


def n_hit(found: str = "contamination"):
    """Hit words: the size of the union of the ranges, whichever blocks they come from."""
    hits = F.array_sort(F.col(f"{found}.hits"))
    step = F.aggregate(
        hits, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda acc, h: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), h["end"] - F.greatest(acc["upto"], h["first"].cast("long")))).alias("n"),
            F.greatest(acc["upto"], h["end"].cast("long")).alias("upto")))
    return step["n"]


def contaminated(hit, words):
    return (hit > 0) & (20 * hit >= words)

