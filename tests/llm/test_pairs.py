"""Similarity join, components and the pipeline against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ampwise.llm import bpe, components, ngram_join, queries, secrets, suffixes
from ampwise.llm.shingles import shingle_sets

from .test_texts import LONG, ODD, SF, brute_windows, empty, odd


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """{id: (set size, smallest id reachable)} by comparing all pairs that share a shingle."""
    sets, parent, lists = {i: shingles(t) for i, t in rows}, {}, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        counts = {}
        for s in sets[i]:
            for j in lists.get(s, ()):
                counts[j] = counts.get(j, 0) + 1
            lists.setdefault(s, []).append(i)
        for j, both in counts.items():
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def copies(seed=1, groups=12):
    """Texts with near copies of many degrees, shared passages, exact copies and short texts."""
    rnd, rows = random.Random(seed), []
    passage = " ".join(f"p{rnd.randint(0, 50)}" for _ in range(25))
    for g in range(groups):
        words = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([3, 7, 40, 120]))]
        for _ in range(rnd.randint(1, 14)):
            w = list(words)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 6])):
                k = rnd.randrange(len(w) or 1)
                w[k:k + rnd.randint(0, 2)] = [f"e{rnd.randint(0, 99)}"] * rnd.randint(0, 2)
            rows.append(" ".join(w).upper() if rnd.random() < 0.2 else "\n ".join(w))
        rows.append(passage + " " + " ".join(f"q{rnd.randint(0, 900)}" for _ in range(rnd.choice([2, 5, 9, 40]))))
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_shingle_hashes_follow_words():
    for text, other in (("A b C d e f", "a  B\tc\nd e F "), ("one two", "ONE\x0btwo")):
        a, b = shingle_sets([text, other])
        assert a.tolist() == b.tolist() and len(a) == len(shingles(text))
    texts = [t for _, t in copies(4)] + [None, "", " ", "x", LONG]
    for t, s in zip(texts, shingle_sets(texts)):
        assert len(s) == len(shingles(t))


@pytest.mark.parametrize("unit", [ngram_join.UNIT, 150])
@pytest.mark.parametrize("seed", [1, 2])
def test_join_by_brute_force(spark, unit, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "HEAVY", 20)  # salted lists as well
    rows = copies(seed) + [(1000, None), (1001, ""), (1002, "\t\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("id", F.lit(1))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(df, unit=unit).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("parts", [1, 8])
def test_salts_of_a_list_in_one_task_meet(spark, parts, monkeypatch):
    """A copied text of 8 words and variants of 9 share one short list, dealt by salt."""
    monkeypatch.setattr(ngram_join, "HEAVY", 20)
    texts = []
    for g in range(8):
        base = " ".join(f"g{g}w{i}" for i in range(8))
        texts += [base] * 70 + [f"{base} v{g}x{i}" for i in range(3)]
    rows = list(enumerate(texts))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_components(rows)


def test_search_skips_nothing_between_components():
    rows = copies(7, 20)
    names = [i for i, _ in rows]
    forest = components.Forest()
    ngram_join.Search().links(shingle_sets([t for _, t in rows]), forest, names)
    assert {i: forest.find(i) for i in names} == {i: c for i, (_, c) in brute_components(rows).items()}


def test_required_overlap():
    for n in range(1, 60):
        for m in range(1, 60):
            least = next((i for i in range(min(n, m) + 1) if 100 * i >= 80 * (n + m - i)), None)
            t = ngram_join.required(n, m)
            assert (least is None and t > min(n, m)) or least == t
            if least is not None:  # a partner must occur in a short list; bands are neighbours
                assert n - ngram_join.short_lists(n) < t
                assert abs(ngram_join._band(n) - ngram_join._band(m)) <= 1


def test_op6_by_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.QUERIES["op6_ngram_join"](spark, SF).collect()}
    assert got == brute_components(rows)


def test_join_odd_rows(spark):
    rows = ngram_join.join(odd(spark, ("component_id", "key"))).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"]) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 5), (5, 1, 5), (6, 1, 6), (7, 1, 7)]
    assert [(r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is None] == [(1, None)]
    assert ngram_join.join(empty(spark)).count() == 0


def test_components_of_random_graphs(spark):
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 300)] + [(rnd.randint(1000, 1400), rnd.randint(1000, 1400)) for _ in range(250)] + [(5000, 5000), (2000, 2001), (2000, 2001)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    rnd.shuffle(edges)
    got = components.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in list(parent)} and len(got) == len(parent)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- pipeline ------------------------------------------------------------

def stage(name):
    return next(f for n, f in corpus_pipeline.STAGES if n.startswith(name))


def test_pipeline_by_brute_force(spark):
    spec = queries.tokenizer_spec()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(spec)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    kept = {i: t for i, t in docs.items() if t and any(map(str.isalpha, t))}
    kept = {i: kept[i] for i, (_, c) in brute_components(kept.items()).items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute_windows(list(kept.values()), items)
    kept = {i: t for (i, t), (n, hit, _) in zip(kept.items(), found) if not (hit and 20 * hit >= n)}
    spans = {r["doc_id"]: r["secrets"] for r in secrets.scan(spark.createDataFrame(list(kept.items()), "doc_id long, text string")).collect()}
    assert set(got) == set(kept)
    for i, t in kept.items():
        out, upto = "", 0
        for s in spans[i]:
            if s["start"] >= upto:
                out += t[upto:s["start"]] + corpus_pipeline.REDACTED
            upto = max(upto, s["end"])
        ids = tok.encode(out + t[upto:], add_special_tokens=False).ids
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids and got[i]["n_tokens"] == len(ids)


def test_stages_on_odd_rows(spark):
    names = ("lang_pred", "lang_score", "contamination", "secrets", "component_id", "count", "score")
    df = spark.createDataFrame([(*r, "en" if r[1] else None, "src0", len(r[1] or "")) for r in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    for c in names:
        df = df.withColumn(c, F.lit("kept"))
    gone = df.limit(0)
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, df, SF)
        assert out.columns == df.columns, name
        rows = out.collect()
        assert all(r["score"] == r["secrets"] == "kept" for r in rows)
        assert f(spark, gone, SF).count() == 0
        if name == "language ID":
            assert sorted(r["doc_id"] or 0 for r in rows) == [0, 4, 5, 5, 6, 7]
        elif name == "n-gram Jaccard join":
            assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 3, 4, 5, 6, 7]
        else:
            assert len(rows) == len(ODD)
    assert stage("BPE")(spark, df, SF).count() == len(ODD) and stage("BPE")(spark, gone, SF).count() == 0


def test_without_languages_only_texts_without_a_letter_go(spark):
    rows = [(1, "The end of the day."), (2, None), (3, ""), (4, "12 34 !"), (5, "день")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r["doc_id"] for r in stage("language")(spark, df, SF).collect()) == [1, 5]
    assert [tuple(r) for r in corpus_pipeline.language_rejects(spark, df).collect()] == [("no letter", 3)]


def test_texts_of_one_id_are_told_apart(spark):
    """Id 7 has a near copy of 3 and a text of its own; id 8 has two, 9 copies the second."""
    words = lambda p: " ".join(f"{p}{i}" for i in range(40))
    rows = [(3, words("a")), (7, words("a") + " x"), (7, words("b")), (8, words("c")), (8, words("d")), (8, words("d")), (9, words("d") + " y"), (8, None), (8, ""), (None, words("a"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in stage("n-gram")(spark, df, SF).collect()]
    want = [(3, words("a")), (7, words("b")), (8, words("c")), (8, words("d")), (8, None), (8, ""), (None, words("a"))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_redaction_follows_n_chars(spark):
    df = spark.createDataFrame([(1, "é password=hunter22 end", "en", "s", 23)], "doc_id long, text string, lang string, source string, n_chars long")
    r = stage("secret")(spark, df, SF).first()
    assert r["text"] == "é [secret] end" and r["n_chars"] == len(r["text"])
    assert bpe and suffixes


def test_templates_below_the_similarity_are_not_compared():
    """Many texts of one template (16 of 20 shingles shared, no link) in one unit take moments."""
    import time
    rnd = np.random.default_rng(3)
    shared = np.unique(rnd.integers(0, 1 << 62, 16, np.uint64))
    sets = [np.unique(np.concatenate((shared, rnd.integers(0, 1 << 62, 4, np.uint64)))) for _ in range(4000)]
    started, forest = time.monotonic(), components.Forest()
    ngram_join.Search().links(sets, forest, list(range(len(sets))))
    assert time.monotonic() - started < 2 and not forest.stars()[0]


@pytest.mark.parametrize("seed", range(6))
def test_search_of_a_unit_equals_all_pairs(seed):
    """Random sets of many sizes and overlaps near the bound, with and without blocks."""
    rnd = random.Random(seed)
    sets, universe = [], [rnd.getrandbits(63) for _ in range(60 if seed % 2 else 400)]
    for _ in range(120):
        if sets and rnd.random() < 0.6:
            s = set(rnd.choice(sets).tolist())
            for _ in range(rnd.randint(0, 6)):
                s.discard(rnd.choice(sorted(s))) if rnd.random() < 0.5 and len(s) > 1 else s.add(rnd.choice(universe))
        else:
            s = set(rnd.sample(universe, rnd.randint(1, 40)))
        sets.append(np.array(sorted(s), np.uint64))
    names = rnd.sample(range(1000), len(sets))
    blocks = [rnd.randint(0, 2) for _ in sets] if seed >= 3 else None
    got, want = components.Forest(), components.Forest()
    ngram_join.Search().links(sets, got, names, blocks)
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 80 * (len(a) + len(sets[j]) - both) and not (blocks and blocks[i] == blocks[j]):
                want.union(names[i], names[j])
    assert {n: got.find(n) for n in names} == {n: want.find(n) for n in names}


def test_least_shared_of_short_lists():
    """Linked sets share as many shingles of their short lists as told, in whatever order; some no more."""
    rnd, least = random.Random(5), set()
    for _ in range(20_000):
        both, own, others = rnd.randint(1, 60), rnd.randint(0, 9), rnd.randint(0, 9)
        n, m = both + own, both + others
        if 100 * both < 80 * (n + m - both):
            continue
        order = rnd.sample("b" * both + "x" * own + "y" * others, both + own + others) if rnd.random() < 0.5 else "x" * own + "y" * others + "b" * both
        at_n = [i for i, c in enumerate(order) if c != "y"][:ngram_join.short_lists(n)]
        at_m = [i for i, c in enumerate(order) if c != "x"][:ngram_join.short_lists(m)]
        shared = len(set(at_n) & set(at_m))
        assert shared >= ngram_join.least_shared(n, m) >= 1
        least.add(shared - ngram_join.least_shared(n, m))
    assert 0 in least


@pytest.mark.parametrize("agree", [0, 1])
def test_neighbourhoods_in_long_and_short_lists(spark, agree, monkeypatch):
    """No link is lost where lists of more than two postings are long, or where all pairs are counted."""
    monkeypatch.setattr(ngram_join, "LONG", 2 if agree else 1000)
    monkeypatch.setattr(ngram_join, "PAIRS", 10)
    if not agree:
        monkeypatch.setattr(ngram_join, "_AGREE", bytes(1 << 16))
    rows = copies(9)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_a_shared_passage_makes_no_neighbourhood(spark):
    """Texts with a passage in common share a few shingles of their short lists but can't link."""
    rnd = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(20))
    own = [" ".join(f"w{rnd.randint(0, 10 ** 6)}" for _ in range(110)) for _ in range(25)]
    rows = [(i, f"{t} {passage}") for i, t in enumerate(own)] + [(100 + i, f"{t} {passage} new") for i, t in enumerate(own[:5])]
    table = spark.sparkContext.broadcast(np.zeros(1 << ngram_join.SKETCH_BITS, np.uint8))
    classes = ngram_join.prepare(spark.createDataFrame(rows, "doc_id long, text string"), table, "doc_id", "text", 5, 80)
    met = classes.select(F.explode("lists").alias("t")).groupBy("t").count().where("count > 10")
    assert met.count()  # else the passage is in no short list
    near = {r["node"]: r["component"] for r in components.components(ngram_join._neighbour_edges(classes, table, 8, 80)).collect()}
    assert near == {i: i % 100 for i in (*range(5), *range(100, 105))}


def test_large_neighbourhood_is_sent_a_few_times(spark, monkeypatch):
    """Sets of a neighbourhood beyond a unit are dealt into blocks, not sent for each shingle they share."""
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        w[rnd.randrange(200)] = f"e{i}"
        rows.append((i, " ".join(w)))
    rows.append((60, " ".join(base[:120])))  # shares much and links with none
    sent, search = [], ngram_join._searched
    monkeypatch.setattr(ngram_join, "_searched", lambda r, *a, **b: sent.append(r.count()) or search(r, *a, **b))
    monkeypatch.setattr(ngram_join, "LONG", 4, raising=False)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), unit=4000).collect()}
    assert got == brute_components(rows)
    assert len(sent) > 2 and sum(sent) < 8 * len(rows)


def test_near_duplicates_of_a_large_family(spark, monkeypatch):
    """The pipeline's second stage keeps one document of a family beyond a unit, sending each set a few times."""
    import functools
    rnd = random.Random(11)
    docs = []
    for i in range(40):
        w = [f"w{k}" for k in range(150)]
        w[rnd.randrange(150)] = f"e{i}"
        docs.append((i, " ".join(w), "en", "s", 1))
    sent, search = [], ngram_join._searched
    monkeypatch.setattr(ngram_join, "_searched", lambda r, *a, **b: sent.append(r.count()) or search(r, *a, **b))
    monkeypatch.setattr(ngram_join, "join", functools.partial(ngram_join.join, unit=2500))
    got = stage("n-gram")(spark, spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), SF)
    assert [r["doc_id"] for r in got.collect()] == [0] and sum(sent) < 8 * len(docs)
