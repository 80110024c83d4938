"""Periodic runs of words, found with a suffix automaton under link-cut access.

A run is a stretch of words with smallest period q that is at least ``LEAST`` words
and ``TIMES`` periods long and that no neighbouring word extends. A text's words are
appended to a suffix automaton one at a time. Its suffix links form a tree; a
link-cut structure keeps each root path in pieces whose states share the word number
at which they occurred last. The access of an appended word walks the pieces of its
path: a piece whose deepest state has L words and which ended last d words ago says
that L + d words up to here have period d. Where L reaches (TIMES - 1) * d these are
that many repetitions, d is their smallest period (a smaller one would be a later
occurrence), and they start where the run starts (L is the longest such stretch). The
run is reported at its last word, that is where the next word breaks the period. The
access then makes the path one piece that occurred now.

Only stretches that can hold a run are appended: within a run every sequence of
``gram_words`` words occurs again in the same run, so a text is cut at sequences that
don't (a hash decides, so at worst too much is kept), and each part again, until
nothing changes. Prose takes part in this counting only.

Defined cases: null and empty texts have no words, no runs and an empty collapsed
text; a text of white space alone likewise; equal texts have equal runs; repeated
rows give repeated rows; an empty table gives no rows; further columns are passed on,
those named like an output are replaced. A text is worked on whole, in arrays of
about 40 bytes for each word that can lie in a run.
"""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import DataFrame

from ampwise.llm.common import append_columns

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 24, 3


def gram_words(least: int, times: int) -> int:
    """The largest power of two of words such that each such sequence inside a run of any
    period occurs twice in it."""
    most = min(max(least, times * q) - 2 * q + 1 for q in range(1, least + 1))
    return 1 << (max(1, most).bit_length() - 1)


def stretches(words: np.ndarray, first: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Ranges [begin, end) of ``words`` (hashes of the words of several texts, text j from
    ``first[j]`` on) outside of which no run can lie; a range is inside one text."""
    n, k = len(words), gram_words(least, times)
    if n < least:
        return []
    odd = np.uint64(0x9E3779B97F4A7C15)
    gram = words.astype(np.uint64)
    width = 1
    while width < k:
        ahead = np.zeros_like(gram)
        ahead[:n - width] = gram[width:]
        gram = (gram * odd) ^ (ahead + (gram >> np.uint64(29)))
        gram = (gram ^ (gram >> np.uint64(31))) * odd
        width *= 2
    unit = np.zeros(n, np.int64)
    unit[first[(first > 0) & (first < n)]] = 1  # texts without words share a mark with the next
    unit = np.cumsum(unit)
    at = np.arange(n - k + 1)
    at = at[unit[at] == unit[at + k - 1]]
    text, unit = unit, unit[at]
    while True:
        key = gram[at] ^ (unit.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(at), bool)
        again[order[1:]] = same
        again[order[:-1]] |= same
        before = len(at), (int(unit[-1]) if len(unit) else 0)
        at, old = at[again], unit[again]
        if not len(at):
            return []
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(old) != 0) | (np.diff(text[at]) != 0)) + 1
        begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)]))
        long = end - begin + k - 1 >= least
        begin, end = begin[long], end[long]
        if not len(begin):
            return []
        at = np.concatenate([at[b:e] for b, e in zip(begin.tolist(), end.tolist())])
        sizes = end - begin
        unit = np.repeat(np.arange(1, len(begin) + 1), sizes)
        if (len(at), len(begin)) == before:
            starts = at[np.concatenate(([0], np.cumsum(sizes)[:-1]))]
            return [(int(b), int(b + s + k - 1)) for b, s in zip(starts, sizes)]


def runs_of(t: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of small integers, by their last word."""
    n = len(t)
    size = 2 * n + 2
    length, link = array("i", bytes(4 * size)), array("i", bytes(4 * size))
    # a state's first transition, and the further ones of the few states that branch
    symbol, target, more = array("i", [-1]) * size, array("i", bytes(4 * size)), {}
    # the pieces as splay trees by depth; the root of a tree carries its piece's last occurrence
    left, right, up = array("i", bytes(4 * size)), array("i", bytes(4 * size)), array("i", bytes(4 * size))
    seen = array("i", [-1]) * size
    out = []

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        else:
            seen[x] = seen[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p] = x
        up[x] = g

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g:
                if left[g] == p:
                    rotate(p if left[p] == x else x)
                elif right[g] == p:
                    rotate(p if right[p] == x else x)
            rotate(x)

    made, last, none = 1, 1, {}
    for i, c in enumerate(t):
        # the automaton takes the word
        made += 1
        now = made
        length[now] = length[last] + 1
        p = last
        while p:
            if symbol[p] == -1:
                symbol[p], target[p] = c, now
            elif symbol[p] == c or c in more.get(p, none):
                break
            else:
                more.setdefault(p, {})[c] = now
            p = link[p]
        if not p:
            link[now] = 1
        else:
            q = target[p] if symbol[p] == c else more[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                made += 1
                twin = made
                length[twin], link[twin] = length[p] + 1, link[q]
                symbol[twin], target[twin] = symbol[q], target[q]
                if q in more:
                    more[twin] = dict(more[q])
                # the twin occurred where q did and lies just above it in the same piece
                splay(q)
                above = left[twin] = left[q]
                if above:
                    up[above] = twin
                left[q], up[twin] = twin, q
                while p:
                    if symbol[p] == c:
                        if target[p] != q:
                            break
                        target[p] = twin
                    elif p in more and more[p].get(c) == q:
                        more[p][c] = twin
                    else:
                        break
                    p = link[p]
                link[q] = link[now] = twin
        up[now] = link[now]
        last = now
        # access: walk the pieces of the path and join them
        x, below = now, 0
        while x:
            splay(x)
            j = seen[x]
            if j >= 0:
                d, long = i - j, length[x]
                if long >= (times - 1) * d and long + d >= least and (i + 1 == n or t[i + 1] != t[i + 1 - d]):
                    out.append((i - long - d + 1, long + d, d))
            r = right[x]
            if r:
                seen[r] = j
            right[x] = below
            if below:
                up[below] = x
            below = x
            x = up[x]
        seen[below] = i
    return out


def find_all(texts: list, least: int = LEAST, times: int = TIMES) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text, and its runs by start, then period."""
    split = [t.encode("utf-8").split() if t else [] for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    hashes = np.fromiter((hash(w) for words in split for w in words), np.int64, int(first[-1]))
    found: list[list] = [[] for _ in texts]
    for begin, end in stretches(hashes, first[:-1], least, times):
        j = int(np.searchsorted(first, begin, side="right")) - 1
        lo, numbers = begin - int(first[j]), {}
        t = [numbers.setdefault(w, len(numbers)) for w in split[j][lo:lo + end - begin]]
        found[j] += [(lo + s, m, q) for s, m, q in runs_of(t, least, times)]
    return [(w, sorted(r, key=lambda x: (x[0], x[2]))) for w, r in zip(split, found)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by a blank, but for those of each run after its first period."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words).decode("utf-8")


def find(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed",
         least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Append the runs of each text (array of start, length, period in words) and the text
    without the repetitions. ``times`` is at least 2."""
    if times < 2 or least < 1:
        raise ValueError("a run has at least two periods and one word")

    def make():
        def fn(texts: list) -> dict:
            got = find_all(texts, least, times)
            return {runs_col: [r for _, r in got], collapsed_col: [collapsed(w, r) for w, r in got]}
        return fn

    return append_columns(docs, text_col, [(runs_col, "array<struct<start:bigint,length:bigint,period:bigint>>"), (collapsed_col, "string")], make)
