"""Periodic runs, exact top-k search and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ampwise.llm import queries, runs, topk, variants

from .test_texts import ODD, SF, docs, empty, odd


# ---- periodic runs -------------------------------------------------------

def brute_runs(words, least=24, times=3):
    """Every run, by trying every period; (start, length, period) by start, then period."""
    number = {}
    a = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    out = []
    for q in range(1, len(a) // times + 1):
        same = np.concatenate(([0], (a[:-q] == a[q:]).astype(np.int8), [0]))
        edge = np.flatnonzero(np.diff(same))
        for s, e in zip(edge[::2], edge[1::2]):
            length, part = int(e - s) + q, a[s:e + q]
            if length >= max(least, times * q) and not any((part[:-p] == part[p:]).all() for p in range(1, q)):
                out.append((int(s), length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least,times", [(24, 3), (6, 2), (10, 4), (1, 2), (3, 3)])
def test_runs_equal_trying_every_period(least, times):
    rnd = random.Random(least)
    for _ in range(600):
        n, letters = rnd.randint(0, 70), rnd.choice([1, 2, 3, 5])
        w = [chr(97 + rnd.randrange(letters)) for _ in range(n)]
        if n and rnd.random() < 0.7:
            p, a = rnd.randint(1, 10), rnd.randrange(n)
            w[a:] = [w[a + i % p] if a + i % p < n else "x" for i in range(n - a)]
            if rnd.random() < 0.5:
                w[rnd.randrange(n)] = "z"
        (words, got), = runs.find_all([" ".join(w)], least, times)
        assert got == brute_runs(w, least, times), (w, least, times)


def test_texts_of_a_batch_do_not_touch():
    half = " ".join(["a b c"] * 7)  # 21 words: two neighbours together would be a run
    assert [r for _, r in runs.find_all([half, None, "", half, half + " a b c"])] == [[], [], [], [], [(0, 24, 3)]]


def test_long_periods_and_one_word():
    rnd = random.Random(3)
    once = [str(rnd.randrange(10**6)) for _ in range(20_000)]
    (words, got), = runs.find_all([" ".join(["head"] + once * 4 + once[:7] + ["tail"])])
    assert got == [(1, 80_007, 20_000)]
    assert runs.collapsed(words, got) == " ".join(["head"] + once + ["tail"])
    (words, got), = runs.find_all(["x " * 300_000])
    assert got == [(0, 300_000, 1)] and runs.collapsed(words, got) == "x"


def test_prose_is_cut_away():
    """Words that cannot lie in a run are not appended to the automaton."""
    words = np.arange(5000)
    assert runs.stretches(words, np.array([0]), 24, 3) == []
    words[1000:1300] = np.arange(300) % 50
    (b, e), = runs.stretches(words, np.array([0]), 24, 3)
    assert 1000 <= b + 8 and b <= 1000 and 1300 <= e <= 1308


def rewritten(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_op11_by_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_runs"](spark, SF).collect()}
    table = docs(spark).select("doc_id", "text").collect()
    assert len(got) == len(table)
    seen = 0
    for doc_id, text in table:
        w = rewritten(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        if len(w) > 8000:
            continue
        found, r = brute_runs(w), got[doc_id]
        seen += bool(found)
        top = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if found else (None,) * 3
        keep = [True] * len(w)
        for s, length, q in found:
            keep[s + q:s + length] = [False] * (length - q)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(x for x, k in zip(w, keep) if k).encode()).hexdigest()
    assert seen > 5


def test_runs_odd_rows(spark):
    got = runs.find(odd(spark, ("runs", "text2", "RUNS")), collapsed_col="short").collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r["text2"] == "x"
        if r["doc_id"] == 6:
            assert r["short"] == "wörd" and [tuple(x) for x in r[-2]] == [(0, 60_000, 1)]
        else:
            assert r[-2] == [] and r["short"] == " ".join((r["text"] or "").split())
    assert runs.find(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        runs.find(empty(spark), times=1)


# ---- top-k ---------------------------------------------------------------

def brute_top(rows, k, is_query):
    """(query, rank, id, score) by scoring everything with Python integers."""
    out = []
    for i, q in rows.items():
        if is_query(i):
            s = sorted((-sum(x * y for x, y in zip(q, v)), j) for j, v in rows.items() if j != i)[:k]
            out += [(i, r + 1, j, -m) for r, (m, j) in enumerate(s)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in rows.items()], "id long, components array<long>")


@pytest.mark.parametrize("seed,size,shard,block", [(1, 3, 40, 8), (2, 500, 1000, 16), (3, 60_000, 30, 4), (4, 1 << 27, 50, 8)])
def test_top_k_equals_scoring_everything(spark, monkeypatch, seed, size, shard, block):
    """Small shards and blocks, many ties and copies; number types up to 64 bits."""
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rnd = random.Random(seed)
    base = [[rnd.randint(-size, size) for _ in range(5)] for _ in range(40)]
    rows = {}
    for i in range(0, 700, 2):
        v = list(rnd.choice(base))
        if rnd.random() < 0.3:
            v[rnd.randrange(5)] += rnd.randint(-1, 1)
        rows[i] = v if rnd.random() < 0.95 else v[:rnd.randint(0, 4)]
    got = sorted(tuple(r) for r in topk.top_k(vectors(spark, rows), F.col("id") % 10 == 0, 6).collect())
    assert got == brute_top(rows, 6, lambda i: i % 10 == 0)


def test_one_vector_many_times(spark, monkeypatch):
    """Equal scores everywhere: the smallest ids win, and blocks of larger ids are not scored."""
    monkeypatch.setattr(topk, "SHARD", 64)
    monkeypatch.setattr(topk, "BLOCK", 8)
    rows = {i: [3, -2] for i in range(1000)}
    got = sorted(tuple(r) for r in topk.top_k(vectors(spark, rows), F.col("id") % 100 == 0, 4).collect())
    assert got == brute_top(rows, 4, lambda i: i % 100 == 0)
    ids, v = np.arange(512), np.full((512, 2), 3)
    scored = []

    class Counted(topk.Shard):
        def typed(self, kind):
            rows, high, low = super().typed(kind)

            class Rows(np.ndarray):
                def __getitem__(self, at):
                    if isinstance(at, slice):
                        scored.append(at)
                    return super().__getitem__(at)
            return rows.view(Rows), high, low

    best, best_ids = np.full((1, 4), topk._LEAST), np.full((1, 4), topk._MOST)
    topk.search(Counted(ids, v), np.array([0]), v[:1], 4, best, best_ids)
    assert best_ids.tolist() == [[1, 2, 3, 4]] and len(scored) <= 4


def test_fewer_candidates_than_k_and_too_large_scores(spark):
    rows = {0: [1], 20: [2]}
    got = sorted(tuple(r) for r in topk.top_k(vectors(spark, rows), F.col("id") % 20 == 0, 5).collect())
    assert got == [(0, 1, 20, 2), (20, 1, 0, 2)]
    assert topk.top_k(vectors(spark, {0: [1]}), F.col("id") == 0, 5).count() == 0
    with pytest.raises(ValueError):
        topk.exact_type(1 << 40, 1 << 30, 2)


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.01]), (0, [0.5, -0.01]), (0, [9.0, 9.0]), (20, None), (40, [nan, 1.0]), (60, [1.0, None]), (80, [-inf, 0.0]),
            (None, [1.0, 1.0]), (1, [0.25]), (2, []), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(7)).withColumn("id", F.lit("x"))
    v = topk.quantised(df, 64)
    assert {r["id"]: r["components"] for r in v.collect()} == {0: [32, -1], 1: [16], 2: [], 3: [64, 64]}
    got = sorted(tuple(r) for r in topk.top_k(v, F.col("id") % 20 == 0, 20).collect())
    assert got == [(0, 1, 3, 32 * 64 - 64), (0, 2, 1, 512), (0, 3, 2, 0)]
    assert topk.top_k(v.limit(0), F.col("id") % 20 == 0, 20).count() == 0


def test_long_ranges_are_cut_into_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 5)
    monkeypatch.setattr(topk, "n_buckets", lambda s: 1)
    rows = {i: [i % 7, i % 3] for i in range(90)}
    index, dims = topk.build(vectors(spark, rows), F.col("id") % 20 == 0, 3)
    assert dims == 2 and index.where("not queries").count() > 5
    assert sum(len(r["ids"]) // 8 for r in index.where("not queries").collect()) == 90


# ---- spelling variants ---------------------------------------------------

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, times=10):
    """{word: (n, n_near, form, form_n, root)} by shared patterns with one letter out."""
    left_out = {}
    for w in counts:
        for i in range(len(w)):
            left_out.setdefault((i, w[:i] + w[i + 1:]), []).append(w)
    found = {w: set() for w in counts}
    for (i, short), group in left_out.items():
        for a in group:
            found[a].update(b for b in group if b != a)
        if short in counts:
            for a in group:
                found[a].add(short)
                found[short].add(a)
    form = {}
    for w, others in found.items():
        if others:
            top = min(others, key=lambda x: (-counts[x], x))
            if counts[top] >= times * counts[w]:
                form[w] = top
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (counts[w], len(found[w]), form.get(w), counts[form[w]] if w in form else None, root)
    return out


def as_dict(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghÿ×"])
def test_range_search_equals_all_pairs(letters):
    rnd = random.Random(len(letters))
    for _ in range(12):
        words = {m: sorted({"".join(rnd.choice(letters) for _ in range(m)) for _ in range(rnd.randint(1, 150))}) for m in (7, 8)}
        for x in (7, 8):
            cell = variants.Cell(words[x], [2] * len(words[x]))
            for y in (7, 8):
                q, p = cell.near(variants.Words(words[y]))
                assert sorted((words[y][i], words[x][j]) for i, j in zip(q, p)) == sorted((a, b) for a in words[y] for b in words[x] if near(a, b))


def test_boxes_prune():
    """Words far apart in letters are not compared."""
    rnd = random.Random(5)
    words = variants.Words(sorted({"".join(rnd.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(6000)}))
    tree = variants.Tree(words.counts, variants.BOX)
    met = sum(len(who) * len(tree.leaves[leaf]) for leaf, who in tree.reach(words.counts, 2))
    assert met < 0.15 * words.codes.shape[0] ** 2
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(words.codes.shape[0]))


def test_op13_by_brute_force(spark):
    counts = Counter()
    for doc_id, text in docs(spark).select("doc_id", "text").collect():
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                counts[w] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    assert as_dict(queries.QUERIES["op13_variants"](spark, SF)) == brute_variants(counts)


def test_many_small_cells_and_words_of_one_point(spark, monkeypatch):
    """Cells far smaller than the words, one of them full of words with equal letters, chains of
    forms, lengths without a sampled word, very long words."""
    monkeypatch.setattr(variants, "CELL", 30)
    monkeypatch.setattr(variants, "SAMPLE", 200)
    monkeypatch.setattr(variants, "VISITING", 50)
    rnd, counts = random.Random(9), {}
    for _ in range(500):
        counts["".join(rnd.sample("abcdefgh", 8))] = rnd.choice([2, 3, 40, 500, 6000])
    for _ in range(300):
        w = "".join(rnd.choice("abcdé") for _ in range(rnd.randint(7, 10)))
        counts[w] = rnd.choice([2, 3, 40, 500, 6000])
    for i in range(6):  # a chain: each form is a letter longer and ten times as frequent
        counts["qqqqqqq" + "r" * i] = 2 * 10 ** i
    long = "xyz" * 4000
    counts |= {long: 500, long + "q": 5, long[:-1]: 50}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_dict(variants.group(df)) == brute_variants(counts)


def test_words_odd_rows(spark):
    rows = ODD + [(7, "ÉCOLES écoles×÷ ABCDEFG abcdefg"), (8, "abcdefg")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    got = {r["word"]: r["n"] for r in variants.word_counts(df, chars=7, occurrences=1).collect()}
    assert got == {"écoles×÷": 1, "abcdefg": 3}  # É stays: only A to Z are lower-cased
    assert variants.word_counts(df.limit(0)).count() == 0
    assert variants.group(spark.createDataFrame([], "word string, n long")).count() == 0
    assert variants.group(spark.createDataFrame([("abcdefg", 2)], "word string, n long")).first()["root"] == "abcdefg"
