"""Language identification with a byte convolutional network.

Bytes of the UTF-8 text are folded to classes (ASCII letters without case, one
class each for digits, white space and other ASCII, every higher byte its own)
and cut into windows of fixed length. Convolution filters of several widths run
over each window, are max-pooled over it, pass a rectifier and a softmax layer.
The network is trained in numpy (Adam, back-propagation through the pooled
positions) on windows of a bounded sample of labelled texts. A document's
language is the one with the largest sum of log-probabilities over all its
windows, each weighted by its letters; the score is the softmax of the weighted
mean, so it lies in 0 to 1.

Filters read one-hot bytes, so a filter of width w is a sum of w table rows;
rows for two neighbouring classes are added once, into tables of pairs.

Defined cases: a null text, an empty one and one without a letter have the
language ``und`` and score 0; a short text is one window, padded with a class
of its own; repeated rows get equal results; without any labelled text every
document is ``und``; columns beyond those named are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampwise.llm.common import append_columns, one_text

UNKNOWN = "und"
#: Bytes of a window, filters per width and the widths (even ones: pairs are looked up).
WINDOW = 256
FILTERS = 12
WIDTHS = (2, 4, 6)
#: Bound of the training sample: rows for each language, and windows drawn from it.
SAMPLE_PER_LANGUAGE = 300
TRAIN_WINDOWS = 4000


def byte_classes() -> tuple[np.ndarray, int]:
    """Class of each byte, and the padding class (the last)."""
    c = np.zeros(256, np.int32)
    for b in range(256):
        if chr(b).isascii() and chr(b).isalpha():
            c[b] = ord(chr(b).lower()) - ord("a")
        elif 0x30 <= b <= 0x39:
            c[b] = 26
        elif b in b" \t\r\n\x0b\x0c":
            c[b] = 27
        elif b < 0x80:
            c[b] = 28
        else:
            c[b] = 29 + b - 0x80
    return c, 29 + 128


CLASSES, PAD = byte_classes()
N_CLASSES = PAD + 1


def windows_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class windows of all texts (padded at each text's end), the text of each window,
    and each window's letters (ASCII letters and bytes that begin a higher character)."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    n = np.array([max(1, -(-len(r) // WINDOW)) for r in raw], np.int64)
    flat = np.full(int(n.sum()) * WINDOW, PAD, np.int16)
    at = 0
    for r, k in zip(raw, n):
        flat[at:at + len(r)] = CLASSES[np.frombuffer(r, np.uint8)]
        at += int(k) * WINDOW
    x = flat.reshape(-1, WINDOW)
    letters = ((x < 26) | ((x >= 29 + 0x40) & (x < PAD))).sum(1)
    return x, np.repeat(np.arange(len(texts)), n), letters


class Network:
    """Filters ``w[k]`` of shape (width, classes, filters), biases, and the dense layer."""

    def __init__(self, languages: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.w = [rng.normal(0, 0.3, (k, N_CLASSES, FILTERS)).astype(np.float32) for k in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.dense = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def pair_tables(self) -> list[list[np.ndarray]]:
        """For each width, tables over pairs of classes: (classes * classes, filters)."""
        return [[(w[j][:, None, :] + w[j + 1][None, :, :]).reshape(-1, FILTERS) for j in range(0, len(w), 2)] for w in self.w]

    def pooled(self, x: np.ndarray, tables, where: bool = False):
        """Largest response of each filter in each window, and optionally its position."""
        n = len(x)
        y = np.full((n, WINDOW + max(WIDTHS)), PAD, np.int32)
        y[:, :WINDOW] = x
        pairs = y[:, :-1] * N_CLASSES + y[:, 1:]
        tops, ats = [], []
        for width, parts, b in zip(WIDTHS, tables, self.b):
            last = WINDOW - width + 1
            r = parts[0].take(pairs[:, :last].ravel(), axis=0)
            for j, t in enumerate(parts[1:], 1):
                r += t.take(pairs[:, 2 * j:2 * j + last].ravel(), axis=0)
            r = r.reshape(n, last, FILTERS)
            if where:
                at = r.argmax(1)
                ats.append(at)
                tops.append(np.take_along_axis(r, at[:, None, :], 1)[:, 0] + b)
            else:
                tops.append(r.max(1) + b)
        return np.concatenate(tops, 1), (y, ats)

    def log_probs(self, x: np.ndarray, tables) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float32)
        for lo in range(0, len(x), 32):  # few windows at once stay in the processor's cache
            top, _ = self.pooled(x[lo:lo + 32], tables)
            out[lo:lo + 32] = np.maximum(top, 0) @ self.dense + self.bias
        out -= out.max(1, keepdims=True)
        return out - np.log(np.exp(out).sum(1, keepdims=True))

    def train(self, x: np.ndarray, y: np.ndarray, rounds: int = 360, batch: int = 96, rate: float = 0.02, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        params = [*self.w, *self.b, self.dense, self.bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            pick = rng.integers(0, len(x), batch)
            top, (padded, ats) = self.pooled(x[pick], self.pair_tables(), where=True)
            act = np.maximum(top, 0)
            z = act @ self.dense + self.bias
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            p[np.arange(batch), y[pick]] -= 1
            p /= batch
            g_act = (p @ self.dense.T) * (top > 0)
            grads_w, grads_b = [], []
            for k, width in enumerate(WIDTHS):
                g = g_act[:, k * FILTERS:(k + 1) * FILTERS]
                gw = np.zeros_like(self.w[k])
                for j in range(width):
                    classes = np.take_along_axis(padded, ats[k] + j, 1)
                    np.add.at(gw[j], (classes, np.arange(FILTERS)[None, :]), g)
                grads_w.append(gw)
                grads_b.append(g.sum(0))
            grads = [*grads_w, *grads_b, act.T @ p + 1e-4 * self.dense, p.sum(0)]
            decay = rate * (1 - step / (rounds + 1))
            for q, g, a, b in zip(params, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                q -= decay * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-7)


def fit(docs: DataFrame, learn, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Network | None:
    """Train on at most ``SAMPLE_PER_LANGUAGE`` texts of each language among the rows where
    ``learn`` holds, picked by a hash of the id; one text of an id that occurs again. The languages
    learned are all of these rows' (the sample and the network's last layer grow with their number)."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    names = [r[0] for r in rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).select(lang_col).collect()]
    # ids first (each language's first by hash), then the texts of these few rows
    by_hash = Window.partitionBy(lang_col).orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col)
    picked = rows.where(F.col(id_col).isNotNull()).select(id_col, lang_col).withColumn("_rank", F.row_number().over(by_hash)).where(F.col("_rank") <= SAMPLE_PER_LANGUAGE)
    wanted = sorted({r[0] for r in picked.select(id_col).collect()})
    if not wanted:
        return None
    lang_of = {n: k for k, n in enumerate(names)}
    pick = docs.sparkSession.createDataFrame([(w,) for w in wanted], f"{id_col} {docs.schema[id_col].dataType.simpleString()}")
    got = one_text(rows.select(id_col, lang_col, text_col), pick, id_col, text_col, lang_col).orderBy(id_col).select("_t", lang_col).collect()
    texts = [r[0] for r in got]
    y = np.array([lang_of[r[1]] for r in got])
    x, of, letters = windows_of(texts)
    good = np.flatnonzero(letters >= 16)
    if not len(good):
        good = np.arange(len(x))
    rng = np.random.default_rng(1)
    chosen = []  # the same number of windows for each language
    for k in range(len(names)):
        own = good[y[of[good]] == k]
        if len(own):
            chosen.append(rng.choice(own, TRAIN_WINDOWS // len(names) + 1, replace=len(own) <= TRAIN_WINDOWS // len(names)))
    if not chosen:
        return None
    pick_w = np.concatenate(chosen)
    x, y = x[pick_w], y[of[pick_w]]
    short = rng.random(len(x)) < 0.3  # short texts: part of a window, the rest padded
    for i in np.flatnonzero(short):
        x[i, rng.integers(12, WINDOW):] = PAD
    net = Network(names)
    net.train(x, y)
    return net


def predict(docs: DataFrame, net: Network | None, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Append the predicted language and its score to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        net = shared.value
        tables = net.pair_tables() if net else None

        def fn(texts: list) -> dict:
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            live = [i for i, t in enumerate(texts) if t and has_letter(t)] if net else []
            if live:
                x, of, letters = windows_of([texts[i] for i in live])
                logs = net.log_probs(x, tables).astype(np.float64)
                weight = letters + 1e-3
                total = np.zeros((len(live), logs.shape[1]))
                np.add.at(total, of, logs * weight[:, None])
                total /= np.bincount(of, weight, len(live))[:, None]
                p = np.exp(total)
                p /= p.sum(1, keepdims=True)
                best = p.argmax(1)
                for j, i in enumerate(live):
                    lang[i], score[i] = net.languages[best[j]], float(p[j, best[j]])
            return {lang_col: lang, score_col: score}
        return fn

    return append_columns(docs, text_col, [(lang_col, "string"), (score_col, "double")], make)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))
