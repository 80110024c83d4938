"""Document quality from a linear-chain conditional random field over lines.

Every line of a text gets a feature vector (shares of character classes, length,
repetition in the text) joined with those of the lines before and after it. A
two-state linear-chain CRF (bad, good) is fitted by gradient ascent on the
conditional log-likelihood; in the training sample every line carries its
document's label. For a document, forward-backward gives each line's marginal
probability of being good; their mean weighted by the lines' lengths, passed
through a fitted logistic calibration, is the document's score.

A text's lines are worked on a bounded number at a time; what is kept of a line is its
emission score, length and marginal, so a text of any length takes some 50 bytes a line
beside the line itself.

Defined cases: a null text counts as empty; an empty text is one empty line;
repeated rows get equal scores; without labelled texts of both classes every
score is 0.5; columns beyond those named are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from ampwise.llm.common import append_columns, labelled_sample

#: Bound of the sample of labelled texts that the field is fitted on.
SAMPLE = 4000
#: Lines whose features are held at once, and lines of a text from which on it is walked by itself.
LINES_AT_ONCE, LONG_LINES = 50_000, 5_000

CLASS_NAMES = ("lower", "upper", "digit", "space", "stop", "loud", "symbol", "bar", "markup", "high")


def byte_classes() -> np.ndarray:
    t = np.full(256, CLASS_NAMES.index("symbol"), np.int8)
    for b in range(256):
        ch = chr(b)
        if b >= 0x80:
            k = "high"
        elif ch.islower():
            k = "lower"
        elif ch.isupper():
            k = "upper"
        elif ch.isdigit():
            k = "digit"
        elif ch in " \t\r\x0b\x0c":
            k = "space"
        elif ch in ".,;:'\"()-":
            k = "stop"
        elif ch in "!?":
            k = "loud"
        elif ch in "|\\":
            k = "bar"
        elif ch in "<>{}[]=_/":
            k = "markup"
        else:
            k = "symbol"
        t[b] = CLASS_NAMES.index(k)
    return t


CLASSES = byte_classes()
OWN = len(CLASS_NAMES) + 7  # features of a line itself
N_FEATURES = 3 * OWN + 3


def _split(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(lines of all texts, lines of each text, whether a line was there before in its text, whether
    it is there more than once)."""
    raw = [(t or "").encode("utf-8", "replace").split(b"\n") for t in texts]
    count = np.array([len(r) for r in raw], np.int64)
    n = int(count.sum())
    first, copies = np.zeros(n, bool), np.zeros(n, bool)
    at = 0
    for r in raw:
        if len(r) > 1:
            seen: dict[bytes, int] = {}
            for i, x in enumerate(r):
                c = seen.get(x, 0)
                seen[x] = c + 1
                first[at + i] = c > 0
            if len(seen) < len(r):
                copies[at:at + len(r)] = [seen[x] > 1 for x in r]
        at += len(r)
    return [x for r in raw for x in r], count, first, copies


def _own(lines: list[bytes], first: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of the lines by themselves, their lengths in bytes)."""
    n, k = len(lines), len(CLASS_NAMES)
    length = np.fromiter(map(len, lines), np.int64, n)
    flat = CLASSES[np.frombuffer(b"".join(lines), np.uint8)]
    of = np.repeat(np.arange(n, dtype=np.int64), length)
    counts = np.bincount(of * k + flat, minlength=n * k).reshape(n, k).astype(np.float32)
    base = np.maximum(length, 1)[:, None]
    # words begin after a space; a run of symbols is one byte class repeated
    space = CLASS_NAMES.index("space")
    same = (flat[1:] == flat[:-1]) & (of[1:] == of[:-1]) & (flat[1:] >= CLASS_NAMES.index("loud")) & (flat[1:] != CLASS_NAMES.index("high"))
    runs = np.bincount(of[1:][same], minlength=n) if len(flat) else np.zeros(n)
    words = counts[:, space] + 1
    split = [x.split() for x in lines]
    again = np.fromiter((1 - len(set(w)) / len(w) if len(w) > 1 else 0.0 for w in split), np.float32, n)  # words said before in the line
    return np.concatenate([
        np.sqrt(counts / base),
        np.log1p(length)[:, None] / 10, (length / words)[:, None].clip(0, 40) / 20,
        first[:, None], copies[:, None], np.sqrt(runs / base[:, 0])[:, None], (length == 0)[:, None], again[:, None],
    ], 1).astype(np.float32), length


def feature_parts(texts: list[str | None], lines_at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, lengths) of the lines of all texts in order, a bounded number of lines at a time;
    a line's features are its own and those of its neighbours in the text."""
    lines, count, first, copies = _split(texts)
    n = len(lines)
    ends = np.cumsum(count)
    start, last = np.zeros(n, bool), np.zeros(n, bool)
    start[ends - count], last[ends - 1] = True, True
    for lo in range(0, n, lines_at_once):
        hi = min(n, lo + lines_at_once)
        a, b = max(0, lo - 1), min(n, hi + 1)
        own, length = _own(lines[a:b], first[a:b], copies[a:b])
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:] = own[:-1]
        after[:-1] = own[1:]
        cut = slice(lo - a, hi - a)
        own, before, after, s, e = own[cut], before[cut], after[cut], start[lo:hi], last[lo:hi]
        before[s] = 0
        after[e] = 0
        yield np.concatenate([own, before, after, s[:, None], e[:, None], np.ones((hi - lo, 1))], 1).astype(np.float32), length[cut]


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length in bytes, lines of each text); the lines of all texts follow each other."""
    x, length = (np.concatenate(p) for p in zip(*feature_parts(texts, 1 << 40)))
    return x, length, np.array([(t or "").count("\n") + 1 for t in texts], np.int64)


class Field:
    """Emission weights (the score of "good" over "bad"), transition scores, calibration."""

    def __init__(self) -> None:
        self.w = np.zeros(N_FEATURES)
        self.trans = np.zeros((2, 2))
        self.a, self.b = 0.0, 0.0

    def marginals(self, emit: np.ndarray, count: np.ndarray):
        """P(good) of every line, and the expected transitions summed over all texts.

        Texts run side by side, longest first, so step t handles every text that has a line t."""
        if not len(count):
            return np.zeros(0), np.zeros((2, 2))
        ends = np.cumsum(count)
        order = np.argsort(-count, kind="stable")
        starts, sizes = (ends - count)[order], count[order]
        steps = int(sizes[0]) if len(sizes) else 0
        live = np.searchsorted(-sizes, -np.arange(steps), side="left")  # texts with more than t lines
        tr = np.exp(self.trans)
        fwd = np.empty((len(emit), 2))
        e = np.exp(np.stack([-emit / 2, emit / 2], 1).clip(-30, 30))
        for t in range(steps):
            at = starts[:live[t]] + t
            f = e[at] if t == 0 else (fwd[at - 1] @ tr) * e[at]
            fwd[at] = f / f.sum(1, keepdims=True)
        good = np.empty(len(emit))
        pairs = np.zeros((2, 2))
        back = np.ones((len(sizes), 2))
        for t in range(steps - 1, -1, -1):
            k = live[t]
            at = starts[:k] + t
            m = fwd[at] * back[:k]
            good[at] = m[:, 1] / m.sum(1)
            if t:
                right = e[at] * back[:k]
                joint = fwd[at - 1][:, :, None] * tr[None] * right[:, None, :]
                pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                nxt = right @ tr.T
                back[:k] = nxt / nxt.sum(1, keepdims=True)
        return good, pairs

    def chain(self, emit: np.ndarray) -> np.ndarray:
        """P(good) of the lines of one long text: the same messages, one line after the other."""
        (t00, t01), (t10, t11) = np.exp(self.trans).tolist()
        odds = np.exp(emit.clip(-60, 60)).tolist()
        good = array("d", bytes(8 * len(odds)))
        f0 = f1 = 0.5
        for i, r in enumerate(odds):
            p0, p1 = (f0 * t00 + f1 * t10, (f0 * t01 + f1 * t11) * r) if i else (1.0, r)
            f1 = good[i] = p1 / (p0 + p1)
            f0 = 1 - f1
        b0 = b1 = 1.0
        for i in range(len(odds) - 1, -1, -1):
            f1, right = good[i], odds[i] * b1
            m = f1 * b1
            good[i] = m / ((1 - f1) * b0 + m)
            b0, b1 = t00 * b0 + t01 * right, t10 * b0 + t11 * right
            z = b0 + b1
            b0, b1 = b0 / z, b1 / z
        return np.frombuffer(good, np.float64)

    def quality(self, emit: np.ndarray, length: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Marginals of the lines, weighted by length, of each text."""
        of, weight = np.repeat(np.arange(len(count)), count), length + 1.0
        good, long = np.empty(len(emit)), count > LONG_LINES
        short = ~long[of]
        good[short], _ = self.marginals(emit[short], count[~long])
        ends = np.cumsum(count)
        for j in np.flatnonzero(long):
            at = slice(ends[j] - count[j], ends[j])
            good[at] = self.chain(emit[at])
        return np.bincount(of, good * weight, len(count)) / np.bincount(of, weight, len(count))

    def raw(self, x: np.ndarray, length: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.quality(x @ self.w, length, count)

    def score(self, texts: list[str | None]) -> np.ndarray:
        w = self.w.astype(np.float32)
        emit, length = (np.concatenate(p) for p in zip(*((x @ w, n) for x, n in feature_parts(texts, LINES_AT_ONCE))))
        count = np.array([(t or "").count("\n") + 1 for t in texts], np.int64)
        return 1 / (1 + np.exp(-(self.a * self.quality(emit.astype(np.float64), length, count) + self.b)))


def fit(sample: list[tuple[str, int]], rounds: int = 150) -> Field:
    f = Field()
    y = np.array([t for _, t in sample], np.float64)
    if not len(y) or y.min() == y.max():
        return f
    x, length, count = line_features([t for t, _ in sample])
    line_y = np.repeat(y, count)
    # every text has the same say, divided over its lines by length
    weight = (length + 1.0) / np.repeat(np.add.reduceat(length + 1.0, np.cumsum(count) - count), count)
    weight *= np.repeat(np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())), count)
    seen = np.zeros((2, 2))
    for k, t in zip(count, y.astype(int)):
        seen[t, t] += k - 1
    m, v = np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    xd = x.astype(np.float64)
    for step in range(1, rounds + 1):
        good, pairs = f.marginals(xd @ f.w, count)
        g = xd.T @ (weight * (line_y - good)) - 0.02 * f.w
        m, v = 0.9 * m + 0.1 * g, 0.98 * v + 0.02 * g * g
        f.w += 0.15 * (1 - step / (rounds + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.98 ** step)) + 1e-9)
        f.trans += 0.5 * (seen - pairs) / max(1.0, seen.sum()) - 0.01 * f.trans
    raw = f.raw(xd, length, count)
    a, b = 4.0, -2.0  # calibration by Newton steps on the log-likelihood
    for _ in range(30):
        p = 1 / (1 + np.exp(-(a * raw + b)))
        s = p * (1 - p) + 1e-6
        h = np.array([[(s * raw * raw).sum() + 1, (s * raw).sum()], [(s * raw).sum(), s.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [((y - p) * raw).sum() - a * 1e-2, (y - p).sum()])
        a, b = a + np.clip(da, -2, 2), b + np.clip(db, -2, 2)
    f.a, f.b = float(a), float(b)
    return f


def train(docs: DataFrame, labelled: DataFrame, text_col: str = "text", target: str = "quality", id_col: str = "doc_id") -> Field:
    return fit(labelled_sample(docs, labelled, target, SAMPLE, id_col, text_col))


def score(docs: DataFrame, field: Field, text_col: str = "text", score_col: str = "score") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        f = shared.value
        return lambda texts: {score_col: f.score(texts) if texts else []}

    return append_columns(docs, text_col, [(score_col, "double")], make)
