"""Toxicity of texts after noisy-channel deobfuscation.

A word written with look-alike symbols, drawn-out letters or letters set apart
becomes a lattice: each observed character may stand for one or more letters,
repeat the letter before it, or be filler, each at a channel cost. A Viterbi
search over the last two letters finds the reading that is likeliest under a
character trigram model counted over all texts of the corpus. The restored text
is then scored by a logistic model over its words and word beginnings, learned
from a bounded sample of labelled texts.

Words of letters only are their own reading, and skip the lattice unless a letter
is repeated. Where the letters of an observed word make a word as they stand (a
repeated letter, a look-alike at its edge), that one is kept beside the likelier
reading by the mean log-probability of a letter. A token is read as a whole, with
punctuation as filler, and piece by piece, split at punctuation.

Defined cases: a null text counts as empty; an empty text gets the score of a
text without any learned feature; repeated rows get equal scores; without a
labelled text of each class every score is 0; columns beyond those named are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampwise.llm.common import append_columns, labelled_sample, slices, small_batches

#: Bound of the sample of labelled texts that the logistic model is fitted on.
SAMPLE = 8000
#: A feature is learned if this many toxic texts have it and its log ratio is large enough.
LEAST_TEXTS, LEAST_RATIO, MOST_FEATURES = 4, 2.0, 4000
#: Quadratic penalty of the weights, and rounds of the descent.
PENALTY, ROUNDS = 0.03, 600
#: Lengths of word beginnings used as features.
BEGINNINGS = (4, 5, 6, 7)
#: Readings that a worker remembers.
REMEMBERED = 300_000

#: What a symbol may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
COST_STANDS, COST_SAME, COST_REPEAT, COST_FILLER, COST_BREAK = -0.7, 0.0, -0.1, -2.5, -1.0

EDGE = 0  # class of a word's edge in the character model
OTHER = 27 + 33


def _class_table() -> np.ndarray:
    t = np.zeros(0x250, np.int32)
    for c in range(0x250):
        ch = chr(c).lower()
        if len(ch) == 1 and "a" <= ch <= "z":
            t[c] = 1 + ord(ch) - ord("a")
        elif len(ch) == 1 and 0xDF <= ord(ch) <= 0xFF and ch.isalpha():
            t[c] = 27 + ord(ch) - 0xDF
        elif ch.isalpha():
            t[c] = OTHER
    return t


TABLE = _class_table()
SIZE = OTHER + 1


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 0x250, TABLE[np.minimum(codes, 0x24F)], OTHER).astype(np.int32)


def class_of(ch: str) -> int:
    return int(TABLE[ord(ch)]) if ord(ch) < 0x250 else OTHER


def character_counts(docs: DataFrame, text_col: str = "text") -> dict[int, int]:
    """Trigrams of character classes over every text: trigram code -> count. The result has
    at most SIZE ** 3 entries whatever the corpus."""

    small_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        total = np.zeros(SIZE ** 3, np.int64)
        for batch in batches:
            for part in slices(batch, text_col):
                c = classes(" ".join(t for t in part.column(0).to_pylist() if t))
                c = np.concatenate(([EDGE, EDGE], c, [EDGE]))
                c = c[np.concatenate(([True, True], (c[2:] != EDGE) | (c[1:-1] != EDGE)))]  # one edge between words
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["gram", "n"])

    got = docs.select(text_col).mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in got.collect()}


class CharacterModel:
    """Trigram model with the bigram and unigram as back-off (interpolated)."""

    def __init__(self, counts: dict[int, int]) -> None:
        t = np.zeros(SIZE ** 3, np.float64)
        if counts:
            t[np.fromiter(counts, np.int64)] = np.fromiter(counts.values(), np.float64)
        t = t.reshape(SIZE, SIZE, SIZE)
        two, one = t.sum(0), t.sum((0, 1))
        p1 = (one + 1) / (one.sum() + SIZE)
        p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
        self.logp = np.log((t + 5 * p2[None]) / (t.sum(2, keepdims=True) + 5)).astype(np.float32)


def restore(observed: str, model: CharacterModel, spaced: bool = False) -> str:
    """The likeliest reading of an observed word. ``spaced``: letters that stood apart, so
    a word may also end between two of them."""
    logp = model.logp
    # state: (class before last, class of last) -> (score, reading)
    # readings are linked (reading before, letters), so a long word costs its length
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
    before = ""
    for ch in observed:
        options = []
        if ch.isalpha():
            options.append((ch, COST_SAME))
        options += [(x, COST_STANDS) for x in LOOKALIKES.get(ch, "")]
        filler = None if ch.isalpha() else COST_FILLER
        repeat = COST_REPEAT if ch == before else None
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}

        def offer(key, score, text):
            if key not in new or score > new[key][0] or score == new[key][0] and _unlinked(text) < _unlinked(new[key][1]):
                new[key] = (score, text)

        for (a, b), (score, text) in states.items():
            if filler is not None:
                offer((a, b), score + filler, text)
            if repeat is not None and text:
                offer((a, b), score + repeat, text)
            for x, cost in options:
                c = class_of(x)
                offer((b, c), score + cost + float(logp[a, b, c]), (text, x))
                if spaced and b != EDGE:
                    s = score + cost + COST_BREAK + float(logp[a, b, EDGE]) + float(logp[b, EDGE, c])
                    offer((EDGE, c), s, (text, " " + x))
        states = new or states
        before = ch
    return min(((-(s + float(logp[a, b, EDGE])), _unlinked(t)) for (a, b), (s, t) in states.items()), default=(0, observed))[1]


def _unlinked(reading: tuple | None) -> str:
    out = []
    while reading is not None:
        reading, x = reading
        out.append(x)
    return "".join(reversed(out))


_DOUBLED = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1+", re.DOTALL)
_LONG_RUN = re.compile(r"(.)\1{2,}", re.DOTALL)
#: Symbols among the look-alikes, and a sign that may stand for a letter.
_SYMBOLS = "".join(c for c in LOOKALIKES if not c.isalnum())
_SIGN = f"(?:[^\\W_]|[{re.escape(_SYMBOLS)}])"
_INNER = re.compile(_SIGN)
#: At least three signs apart, none of them beside a further letter.
_APART = re.compile(rf"(?<![^\W_])(?<![^\W_]['’]){_SIGN}(?![^\W_])(?:[\s.*_-]++{_SIGN}(?![^\W_])){{2,}}+")
_PUNCTUATION = re.compile(rf"(?:[^\w{re.escape(_SYMBOLS)}]|_)+")
_BETWEEN = re.compile(r"(?:[^\w@$€£]|_)+")
_STRIP = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "@$!|+(<") + "«»“”„’‘…"


class Reader:
    """Restored words of texts; remembers readings of words."""

    def __init__(self, model: CharacterModel) -> None:
        self.model = model

    def word(self, token: str) -> str:
        """The likeliest reading of the whole token."""
        return self.readings(token.strip(_STRIP))[-1]

    def words(self, token: str, may=None) -> list[str]:
        """Readings of the whole token and of its pieces. ``may`` tells of a word of letters
        whether a reading with fewer repeats can matter."""
        core = token.strip(_STRIP)
        out = self.readings(core, may)
        if not core.isalpha():
            pieces = {x for split in (_PUNCTUATION, _BETWEEN) for x in split.split(core)} - {"", core}
            for piece in sorted(pieces):
                out += self.readings(piece, may)
        return out

    def readings(self, core: str, may=None) -> list[str]:
        """The letters as they stand, if they make a word, and the likelier of them and the
        restored reading (the last one)."""
        if core.isalpha():
            if not _DOUBLED.search(core) or may and not may(core):
                return [core]
            raw = core
        else:
            raw = core.strip(_SYMBOLS)
            if not any(map(str.isalpha, raw)):
                return [raw]
        seen = restore(_LONG_RUN.sub(r"\1\1", core), self.model)
        if not raw.isalpha():
            return [seen]
        return [raw] if self.per_letter(raw) >= self.per_letter(seen) else [raw, seen]

    def per_letter(self, word: str) -> float:
        """Mean log-probability of a word's letters and its end."""
        c = np.concatenate(([EDGE, EDGE], classes(word), [EDGE]))
        return float(self.model.logp[c[:-2], c[1:-1], c[2:]].mean())

    def apart(self, run: str) -> list[str]:
        """Words read from letters set apart."""
        return restore("".join(_INNER.findall(run)), self.model, spaced=True).split()


def features(word: str) -> list[str]:
    return [word, *(word[:k] + "~" for k in BEGINNINGS if len(word) > k)]


class Scorer:
    """Logistic model over the features of a text's restored words."""

    def __init__(self, reader: Reader, weights: dict[str, float], bias: float) -> None:
        self.reader, self.weights, self.bias = reader, weights, bias
        self.known: dict[str, tuple] = {}
        # beginnings of words that have a learned feature, without repeats
        self.starts = {_RUN.sub(r"\1", f.removesuffix("~")) for f in weights}
        self.lengths = sorted(set(map(len, self.starts)))

    def may(self, word: str) -> bool:
        """Whether any reading of a word of letters with fewer repeats can have a learned feature."""
        least = _RUN.sub(r"\1", word)
        return any(least[:k] in self.starts for k in self.lengths if k <= len(least))

    def hits(self, token: str) -> tuple:
        got = self.known.get(token)
        if got is None:
            got = tuple({f for w in self.reader.words(token, self.may) for f in features(w) if f in self.weights})
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[token] = got
        return got

    def found(self, text: str) -> set[str]:
        low, out = text.lower(), set()
        known = self.known
        for token in set(low.split()):
            out.update(known[token] if token in known else self.hits(token))
        for run in _APART.findall(low):
            for w in self.reader.apart(run):
                out.update(f for f in features(w) if f in self.weights)
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(sorted(self.weights[f] for f in self.found(text))) if text else self.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def text_features(text: str, reader: Reader) -> set[str]:
    low, out = text.lower(), set()
    for token in set(low.split()):
        for w in reader.words(token):
            out.update(features(w))
    for run in _APART.findall(low):
        for w in reader.apart(run):
            out.update(features(w))
    return out


def fit(sample: list[tuple[str, int]], model: CharacterModel) -> Scorer:
    """Choose features by their log ratio between classes, then fit weights by gradient
    descent on the log-likelihood with a quadratic penalty."""
    reader, pos, neg = Reader(model), Counter(), Counter()
    n_pos = sum(y for _, y in sample)
    n_neg = len(sample) - n_pos
    if not n_pos or not n_neg:
        return Scorer(reader, {}, -30.0)
    for text, y in sample:
        if y:
            pos.update(text_features(text, reader))
    pos = {f: n for f, n in pos.items() if n >= LEAST_TEXTS}
    names = sorted(pos)
    number = {f: i for i, f in enumerate(names)}
    sets, learned = [], Scorer(reader, dict.fromkeys(names, 0.0), 0.0)  # of each text, the numbers of its features among these
    for text, y in sample:
        found = np.array(sorted(number[f] for f in learned.found(text)), np.int32)
        sets.append(found)
        if not y:
            neg.update(names[i] for i in found)
    ratio = {f: math.log((n + 0.2) / (n_pos + 0.2)) - math.log((neg[f] + 1) / (n_neg + 1)) for f, n in pos.items()}
    chosen = sorted((f for f, r in ratio.items() if r >= LEAST_RATIO), key=lambda f: (-pos[f] * ratio[f], f))[:MOST_FEATURES]
    at = {f: i for i, f in enumerate(chosen)}
    place = np.full(len(names) + 1, -1, np.int64)
    for f, i in at.items():
        place[number[f]] = i
    cols = [place[f] for f in sets]
    rows = np.concatenate([np.full(int((c >= 0).sum()), i, np.int64) for i, c in enumerate(cols)])
    cols = np.concatenate([c[c >= 0] for c in cols])
    y = np.array([t for _, t in sample], np.float64)
    w, bias = np.zeros(len(chosen)), math.log(n_pos / n_neg)
    mw, vw, mb, vb = np.zeros(len(chosen)), np.zeros(len(chosen)), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        z = bias + np.bincount(rows, w[cols], len(sample)) if len(rows) else np.full(len(sample), bias)
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gw = (np.bincount(cols, g[rows], len(chosen)) if len(rows) else 0) + PENALTY * w
        gb = g.sum()
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * (1 - step / (ROUNDS + 1))
        w = np.maximum(0, w - rate * mw / (1 - 0.9 ** step) / (np.sqrt(vw / (1 - 0.99 ** step)) + 1e-9))
        bias -= rate * (mb / (1 - 0.9 ** step)) / (math.sqrt(vb / (1 - 0.99 ** step)) + 1e-9)
    return Scorer(reader, {f: float(w[i]) for f, i in at.items() if w[i] > 1e-3}, float(bias))


def train(docs: DataFrame, labelled: DataFrame, text_col: str = "text", target: str = "toxic", id_col: str = "doc_id") -> Scorer:
    """``labelled``: rows to learn from, with the id and 0/1 in ``target``."""
    model = CharacterModel(character_counts(docs, text_col))
    return fit(labelled_sample(docs, labelled, target, SAMPLE, id_col, text_col), model)


def score(docs: DataFrame, scorer: Scorer, text_col: str = "text", score_col: str = "score") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((scorer.reader.model, scorer.weights, scorer.bias))

    def make():
        model, weights, bias = shared.value
        own = Scorer(Reader(model), weights, bias)
        return lambda texts: {score_col: [own.score(t) for t in texts]}

    return append_columns(docs, text_col, [(score_col, "double")], make)
