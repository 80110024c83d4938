"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The corpus's most frequent pre-tokens are compiled, with the ids that BPE gives
them, into a minimal acyclic automaton: equal suffixes share states, and the
words are numbered by counting the words below each branch, so a path yields a
word number and that number its ids. The automaton is one file of flat arrays
that Spark distributes (``addFile``) and each Python worker memory-maps. A
pre-token outside the lexicon is merged exactly, by the ranks of the tokenizer
file; a long one with a heap of its pairs, in time near its length. The new
pre-tokens of a slice of texts walk the automaton together, a byte at a time, and
those it lacks are merged together, a merge of each at a time. A text is cut
at white space, and a worker keeps a bounded table of the pieces it met lately
with their ids.

Defined cases: null text counts as empty; empty text has no ids and decodes to
the empty string; repeated rows give repeated rows; an empty table gives an
empty lexicon and no rows; columns of the input beyond the text and those asked
for are not read, and an input column named like an output is replaced.
"""

from __future__ import annotations

import heapq
import json
import mmap
import struct
import uuid
from array import array
from collections.abc import Callable

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampwise.llm.common import append_columns, slices, small_batches, stored, write_bytes
from ampwise.llm.pretokens import AT_ONCE, Recent, Splitter, byte_chars, encoded, piece_table, pieces

#: Pre-tokens compiled into the lexicon; symbols of a word from which on it is merged by a heap.
LEXICON_WORDS = 60_000
LONG = 64
#: Distinct pieces that a counting task holds before it passes them on.
COUNTED_AT_ONCE = 200_000


class Merger:
    """The merges of a BPE file with word-end suffix."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        # a merge of two symbols, by their numbers: its rank, and by rank the symbol it makes
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        number = self.vocab
        for i, m in enumerate(model["merges"]):
            x, y = m if not isinstance(m, str) else m.split(" ")
            self.rank.setdefault(number[x] << 20 | number[y], i)
            self.made.append(number[x + y])
        # the symbol of each byte, inside a word and as its last
        self.inner, self.last = ([self.vocab.get(c + end) for c in byte_chars()] for end in ("", self.suffix))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # the same as arrays, for many words at once: pairs in order with their ranks, and -1 for bytes that lack a symbol
        pairs = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], -1)
        self.ranks = np.append(np.fromiter(self.rank.values(), np.int64, len(order))[order], 0)
        self.symbols = np.array([-1 if i is None else i for i in self.inner + self.last], np.int64).reshape(2, 256)
        self.makes = np.array(self.made, np.int64)
        tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [tokens.get(i, "") for i in range(max(tokens) + 1)]

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        if not word:
            return []
        get, made, inner, raw = self.rank.get, self.made, self.inner, word.encode("utf-8")
        s = [inner[b] for b in raw]
        s[-1] = self.last[raw[-1]]
        if None in s:  # bytes that the vocabulary lacks
            s = [x for x in s if x is not None]
        if len(s) > LONG:
            return self._merged_by_heap(s)
        never = len(made)
        ranks = [get(a << 20 | b, never) for a, b in zip(s, s[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)  # the first of equal rank
            new = s[i] = made[best]
            del s[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(s[i - 1] << 20 | new, never)
            if i < len(ranks):
                ranks[i] = get(new << 20 | s[i + 1], never)
        return s

    def many(self, words: list[bytes]) -> list[bytes]:
        """The ids of words (UTF-8, not empty, none of them special) as bytes. Each round makes the
        next merge of every word: the lowest rank, then leftmost."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size)
        s = self.symbols[0, raw]
        s[ends - 1] = self.symbols[1, raw[ends - 1]]
        one = size > LONG
        one[np.repeat(np.arange(len(words)), size)[s < 0]] = True
        alone = {int(i): array("I", self.ids(words[i].decode("utf-8"))).tobytes() for i in np.flatnonzero(one)}
        of = np.repeat(np.arange(len(words)), size)  # the word of each symbol
        s, of = s[~one[of]], of[~one[of]]
        never, done = len(self.made), []

        def ranked(at: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at ``at``."""
            after = np.minimum(at + 1, len(s) - 1)
            pair = np.where((at < after) & (of[at] == of[after]), s[at] << 20 | s[after], -2)
            found = np.searchsorted(self.pairs[:-1], pair)
            return np.where(self.pairs[found] == pair, self.ranks[found], never)

        rank = ranked(np.arange(len(s)))
        while len(s):
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            count = np.diff(np.append(starts, len(s)))
            best = np.minimum.reduceat(rank, starts)
            going = best < never
            if not going.all():  # words without a merge left
                keep = np.repeat(going, count)
                done.append((of[~keep], s[~keep]))
                s, of, rank, best, count = s[keep], of[keep], rank[keep], best[going], count[going]
                if not len(s):
                    break
            at = np.flatnonzero(rank == np.repeat(best, count))
            at = at[np.concatenate(([True], of[at][1:] != of[at][:-1]))]
            s[at] = self.makes[best]
            keep = np.ones(len(s), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # one symbol fewer for each word before
            s, of, rank = s[keep], of[keep], rank[keep]
            rank[at] = ranked(at)
            before = at[at > 0] - 1
            rank[before] = ranked(before)
        of, s = (np.concatenate([d[k] for d in done] or [np.zeros(0, np.int64)]) for k in (0, 1))
        blob = s[np.argsort(of, kind="stable")].astype("<u4").tobytes()
        to = np.concatenate(([0], 4 * np.cumsum(np.bincount(of, minlength=len(words))))).tolist()
        out = [blob[a:b] for a, b in zip(to, to[1:])]
        for i, ids in alone.items():
            out[i] = ids
        return out

    def _merged_by_heap(self, s: list[int]) -> list[int]:
        """The same merges (lowest rank, then leftmost) of a long word: symbols linked to their
        neighbours, pairs in a heap; a pair that has changed since is passed over."""
        get, made, n = self.rank.get, self.made, len(s)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i) for i in range(n - 1) if (r := get(s[i] << 20 | s[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if s[i] >= 0 else -1
            if j < 0 or get(s[i] << 20 | s[j]) != rank:
                continue
            s[i], s[j] = made[rank], -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := get(s[i] << 20 | s[k])) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := get(s[h] << 20 | s[i])) is not None:
                heapq.heappush(heap, (r, h))
        return [x for x in s if x >= 0]


# ---- the automaton -------------------------------------------------------

MAGIC = b"ADFA1\0\0\0"


def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """A minimal acyclic automaton over the words' bytes, with ids as outputs.

    Words are added in byte order; a branch that can no longer grow is replaced
    by an equal state already kept (same finality, same labelled targets).
    """
    entries = sorted(dict(entries).items())
    register: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((label, target), ...)), targets before sources

    def keep(node) -> int:
        key = (node[0], tuple(node[1]))
        at = register.get(key)
        if at is None:
            at = register[key] = len(states)
            states.append(key)
        return at

    path: list[list] = [[False, []]]  # open states: [final, [(label, target)]]
    previous = b""
    for word, _ in entries:
        common = 0
        while common < min(len(word), len(previous)) and word[common] == previous[common]:
            common += 1
        while len(path) > common + 1:
            done = keep(path.pop())
            path[-1][1].append((previous[len(path) - 1], done))
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        previous = word
    while len(path) > 1:
        done = keep(path.pop())
        path[-1][1].append((previous[len(path) - 1], done))
    root = keep(path[0])

    below = np.zeros(len(states), np.int64)  # words that end in or below a state
    first, label, target, skip = [0], bytearray(), [], []
    for s, (final, edges) in enumerate(states):
        n = int(final)
        for c, t in edges:
            label.append(c)
            target.append(t)
            skip.append(n)
            n += int(below[t])
        below[s] = n
        first.append(len(target))
    final = bytes(int(f) for f, _ in states)
    ids = [i for _, got in entries for i in got]
    starts = np.cumsum([0] + [len(got) for _, got in entries])
    out = bytearray(MAGIC + struct.pack("<qqqqq", len(states), len(target), len(entries), len(ids), root))
    for a in (np.array(first, "<i4"), np.array(target, "<i4"), np.array(skip, "<i4"), np.array(starts, "<i4"), np.array(ids, "<u4")):
        out += a.tobytes()
    return bytes(out + final + bytes(label))


class Lexicon:
    """A compiled lexicon in a memory-mapped file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self.map[:8] != MAGIC:
            raise ValueError("not a lexicon file")
        n, edges, words, ids, self.root = struct.unpack("<qqqqq", self.map[8:48])
        at = 48

        view = memoryview(self.map)

        def ints(count: int, kind: str = "<i4"):
            nonlocal at
            a = view[at:at + 4 * count].cast("i" if kind == "<i4" else "I")
            at += 4 * count
            return a

        self.first, self.target, self.skip = ints(n + 1), ints(edges), ints(edges)
        self.starts, self.ids = ints(words + 1), ints(ids, "<u4")
        self.final, self.label, self.words = at, at + n, words
        # the edges' states and labels, which stand in this order in the file
        self.edge = np.repeat(np.arange(n, dtype=np.int64) << 8, np.diff(self.first)) | np.frombuffer(view[self.label:self.label + edges], np.uint8)
        self.ends = np.frombuffer(view[self.final:self.final + n], np.uint8)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """:meth:`number` of many words: all take a byte's step at a time."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw, begin = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
        state, number = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        target, skip = np.asarray(self.target), np.asarray(self.skip)
        left, step = np.arange(len(words)), 0  # words still under way
        while True:
            whole = size[left] == step
            over = left[whole]
            number[over[self.ends[state[over]] == 0]] = -1
            left = left[~whole]
            if not len(left):
                return number
            step_to = state[left] << 8 | raw[begin[left] + step]
            e = np.searchsorted(self.edge, step_to)
            met = e < len(self.edge)
            met[met] = self.edge[e[met]] == step_to[met]
            number[left[~met]] = -1
            left, e = left[met], e[met]
            number[left] += skip[e]
            state[left] = target[e]
            step += 1

    def number(self, word: bytes) -> int:
        """The word's number in byte order, or -1."""
        s, n, base, find = self.root, 0, self.label, self.map.find
        first, target, skip = self.first, self.target, self.skip
        for i in range(len(word)):
            e = find(word[i:i + 1], base + first[s], base + first[s + 1])
            if e < 0:
                return -1
            e -= base
            n += skip[e]
            s = target[e]
        return n if self.map[self.final + s] else -1

    def get(self, word: bytes) -> bytes | None:
        """The word's ids as little-endian unsigned 32-bit integers."""
        k = self.number(word)
        return None if k < 0 else self.ids[self.starts[k]:self.starts[k + 1]].tobytes()


# ---- the job -------------------------------------------------------------

def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _splitter(spec: str) -> Splitter:
    from tokenizers import Tokenizer
    return Splitter(Tokenizer.from_str(spec))


def pretoken_counts(docs: DataFrame, spec: str, text_col: str = "text") -> DataFrame:
    """Occurrences of every pre-token over all texts: (word, n)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        from collections import Counter

        import pyarrow as pa
        split, seen = _splitter(shared.value).lines, Counter()

        def flush():
            counts: Counter = Counter()
            of = iter(seen.values())
            n = next(of, 0)
            for w in split(list(seen)):
                if w == "\n":  # the next piece's pre-tokens
                    n = next(of)
                else:
                    counts[w] += n
            seen.clear()
            words = list(counts)
            for i in range(0, len(words), 50_000):
                part = words[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[w] for w in part], pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch, text_col, AT_ONCE):
                found = pieces(part.column(0))[0].value_counts()
                for piece, n in zip(found.field(0).to_numpy(zero_copy_only=False).tolist(), found.field(1).to_numpy().tolist()):
                    seen[piece] += n
                if len(seen) > COUNTED_AT_ONCE:
                    yield from flush()
        yield from flush()

    counted = docs.select(text_col).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, spec: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent pre-tokens and let Spark distribute the file; returns its name.

    The list on the driver has at most ``words`` entries whatever the corpus."""
    # words under 64 bytes: a longer one is rarely frequent, and the merger is exact for it anyway
    counts = stored(pretoken_counts(docs, spec, text_col).where(F.octet_length("word") < 64), "pretokens")
    # the least count with which at most `words` of them are taken; one row per distinct count
    least, taken = 1 << 62, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("of")).orderBy(F.desc("n")).limit(words).collect():
        taken += r["of"]
        if taken > words:
            break
        least = r["n"]
    top = [r["word"] for r in counts.where(F.col("n") >= least).select("word").collect()]
    merge = Merger(json.loads(spec))
    blob = compile_lexicon([(w.encode("utf-8"), merge.ids(w)) for w in top])
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    docs.sparkSession.sparkContext.addFile(write_bytes(docs.sparkSession, name, blob))
    return name


_WORKER: dict = {}


def worker_table(spec: str, lexicon: str) -> tuple[Recent, list[str]]:
    """What a worker keeps from task to task for the lexicon in use: the table of pieces, and the tokens."""
    if _WORKER.get("of") != lexicon:
        merge = Merger(json.loads(spec))
        _WORKER.update(of=lexicon, table=(piece_table(_splitter(spec), words_of(Lexicon(SparkFiles.get(lexicon)), merge)), merge.tokens))
    return _WORKER["table"]


def words_of(lexicon: Lexicon, merge: Merger) -> Callable[[list[str]], list[bytes]]:
    """The ids of pre-tokens as bytes: looked up in the lexicon, those not there merged. The line end
    that stands between texts has none."""
    def ids(words: list[str]) -> list[bytes]:
        raw = [w.encode("utf-8") for w in words]
        out = [b""] * len(words)
        starts, held = lexicon.starts, lexicon.ids
        lacking = []
        for i, k in enumerate(lexicon.numbers(raw).tolist()):
            if k >= 0:
                out[i] = held[starts[k]:starts[k + 1]].tobytes()
            elif words[i] in merge.special:
                out[i] = array("I", merge.ids(words[i])).tobytes()
            elif words[i] not in ("", "\n"):
                lacking.append(i)
        for i, got in zip(lacking, merge.many([raw[i] for i in lacking])):
            out[i] = got
        return out
    return ids


def encode_decode(docs: DataFrame, spec: str, lexicon: str, text_col: str = "text",
                  ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Append the ids of each text (binary, little-endian unsigned 32-bit) and the text
    decoded from those ids. The file has no decoder, so decoded tokens are joined by spaces."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def make():
        import pyarrow as pa
        import pyarrow.compute as pc
        table, names = worker_table(shared.value, lexicon)
        tokens = pa.array(names)

        def fn(texts: pa.Array) -> dict:
            ids, begin = encoded(texts, table)
            said = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), tokens.take(pa.array(ids)))
            raw = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((4 * begin).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
            return {ids_col: raw, decoded_col: pc.binary_join(said, " ")}
        return fn

    return append_columns(docs, text_col, [(ids_col, "binary"), (decoded_col, "string")], make, arrow_texts=True, limit=AT_ONCE)
