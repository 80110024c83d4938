"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampwise.llm import bpe
from ampwise.llm.common import crc_mod, documents, labels
from ampwise.llm.oracle import OP6, OP7, OP12

QUERIES: dict = {}
#: Where SQL can express the query.
ORACLE: dict[str, str] = {"op6_ngram_join": OP6, "op7_suffixes": OP7, "op12_topk": OP12}

TOKENIZER = "word_bpe_49k.json"


def _query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer_spec(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return bpe.read_tokenizer(public_tokenizers.path(name))


@_query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, spec = documents(spark, sf_dir).select("doc_id", "text"), tokenizer_spec()
    got = bpe.encode_decode(docs, spec, bpe.build_lexicon(docs, spec))
    return got.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@_query
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import langid
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)))
    net = langid.fit(docs, ~F.col("held_out"))
    return langid.predict(docs.drop("lang"), net).select("doc_id", "held_out", "lang_pred", "score")


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import toxicity
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", held)
    scorer = toxicity.train(docs, labels(spark, sf_dir).where(~held))
    return toxicity.score(docs, scorer).select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@_query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import quality
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", held)
    field = quality.train(docs, labels(spark, sf_dir).where(~held))
    return quality.score(docs, field).select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import syncmers
    got = syncmers.fingerprints_in_order(documents(spark, sf_dir))
    return got.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                      "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@_query
def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import suffixes
    found = suffixes.find(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.col("contamination.n_words").alias("n_words"), suffixes.n_hit().alias("n_hit"),
                        F.size("contamination.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("contamination.items"), ",").cast("binary"), 256).alias("items_sha256"),
                        ).withColumn("contaminated", suffixes.contaminated(F.col("n_hit"), F.col("n_words")))


@_query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import secrets
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    return found.select("doc_id", *(secrets.of_kind(spans, k).alias(f"n_{n}") for k, n in enumerate(secrets.KINDS[:3])),
                        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"), secrets.listed(spans).alias("spans"))


@_query
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import licences
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = licences.scan(docs, licences.train(docs))
    all_, named = F.col("licences"), F.filter("licences", lambda r: r["family"] != "unknown")
    return found.select(
        "doc_id", F.size(all_).cast("long").alias("n_paragraphs"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(named, lambda r: r["family"]))), ",").alias("families"),
        F.size(F.filter(all_, lambda r: r["family"] == "unknown")).cast("long").alias("n_unknown"),
        F.size(F.filter(all_, lambda r: r["confirmed"])).cast("long").alias("n_confirmed"),
        F.coalesce(F.round(F.array_max(F.transform(all_, lambda r: r["probability"])), 6), F.lit(0.0)).alias("score"),
        F.array_join(F.transform(all_, lambda r: F.concat_ws(":", r["family"], r["paragraph"].cast("string"))), ",").alias("paragraphs"))


@_query
def op10_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import rans
    path = rans.new_path(spark)
    rans.write(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_spec(), path, end=2)
    return rans.read(spark, path).select("doc_id", "start", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@_query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import ngram_join
    return ngram_join.join(documents(spark, sf_dir).select("doc_id", "text"))


def with_periods(docs: DataFrame) -> DataFrame:
    """The contract's documents of op11: in one of ten texts (by a hash of the id) the words from
    one on repeat with a period. A null id leaves its text as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    marked = docs.withColumn("_h", h).withColumn("_g", F.expr("_h div 10")).withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    return marked.withColumn("text", F.expr("""
        CASE WHEN size(_w) > 0 THEN array_join(transform(_w, (w, i) -> CASE WHEN i < _g % size(_w) THEN w ELSE
            _w[CAST(_g % size(_w) + (i - _g % size(_w)) % (1 + (size(_w) - _g % size(_w)) div (3 + _g % 8)) AS INT)] END), ' ')
        ELSE text END""")).drop("_h", "_g", "_w")


@_query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import runs
    found = runs.find(with_periods(documents(spark, sf_dir).select("doc_id", "text")))
    top = F.expr("""array_sort(runs, (a, b) -> CASE WHEN a.length * b.period > b.length * a.period THEN -1
        WHEN a.length * b.period < b.length * a.period THEN 1 WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
        WHEN a.period <> b.period THEN IF(a.period < b.period, -1, 1) ELSE 0 END)""")
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return found.withColumn("_top", F.get(top, F.lit(0))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_top.start").alias("start"), F.col("_top.length").alias("length"),
        F.col("_top.period").alias("period"), F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
        F.sha2(F.concat(listed, F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@_query
def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import topk
    vectors = topk.quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 64)
    return topk.top_k(vectors, F.col("id") % 20 == 0, 20)


@_query
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ampwise.llm import variants
    counts = variants.word_counts(documents(spark, sf_dir), left_out=31)
    return variants.group(counts).select("word", "form", "root", "n", "n_near", "form_n")
