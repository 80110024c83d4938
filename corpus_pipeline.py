"""From raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes every stage's result as a Parquet
table in the shared folder and reads it again for the next.

Defined cases: nulls, empty and repeated rows are treated as each operator's
docstring says; a document without a letter is rejected by the first stage; an
empty table stays empty; further columns of ``docs`` are passed on by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampwise.llm import bpe, langid, ngram_join, secrets, suffixes
from ampwise.llm.common import crc_mod, documents, fresh, join_ids, stored
from ampwise.llm.queries import tokenizer_spec

#: A document is rejected if its language is unknown or less certain than this.
LEAST_CERTAIN = 0.35
#: What stands for a secret in the text.
REDACTED = "[secret]"


def _told(spark: SparkSession, docs: DataFrame, reason: str) -> DataFrame:
    """``docs`` and why the first stage rejects a row (null: it stays). Without a language to
    learn from, only texts without a letter go."""
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    net = langid.fit(docs, F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(False)))
    letters = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    if net is None:
        return docs.withColumn(reason, F.when(~letters, "no letter"))
    told = langid.predict(docs, net, lang_col=lang, score_col=score)
    return told.withColumn(reason, F.when(F.col(lang) == langid.UNKNOWN, F.when(letters, "unknown").otherwise("no letter"))
                           .when(F.col(score) >= LEAST_CERTAIN, F.lit(None)).otherwise("uncertain")).drop(lang, score)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told (no text, no letter, or too uncertain)."""
    reason = fresh(docs, "rejected")
    return _told(spark, docs, reason).where(F.col(reason).isNull()).select(docs.columns)


def language_rejects(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """How many documents the first stage rejects for each reason: rejected, documents."""
    return _told(spark, docs.select("doc_id", "text", "lang"), "rejected").where("rejected is not null").groupBy("rejected").agg(F.count("*").alias("documents"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest id, of each component of linked documents, and
    one row of rows with equal id and text. Documents with a null id stay. Where an id has several
    texts, each is a document of its own."""
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not repeated.limit(1).count():
        found = stored(ngram_join.join(docs.select("doc_id", "text")).where(F.col("doc_id").isNotNull()), "near-duplicates")
        return join_ids(docs, found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
    twice, own = fresh(docs, "twice"), fresh(docs, "own_id")
    # rows of an id that occurs again are told by a hash of id and text
    marked = join_ids(docs, repeated.withColumn(twice, F.lit(True)), "doc_id", "left").withColumn(
        own, F.when(F.col(twice), F.xxhash64("doc_id", "text", F.col("text").isNull())).otherwise(F.col("doc_id").cast("bigint")))
    found = stored(ngram_join.join(marked.select(own, "text"), id_col=own).where(F.col(own).isNotNull()), "near-duplicates")
    ids = marked.where(F.col(twice)).select(own, F.col("doc_id").alias("of")).distinct()
    keepers = join_ids(found, ids, own, "left").groupBy("component_id").agg(
        F.min(F.struct(F.coalesce("of", own).alias("of"), F.col(own).alias("own"))).alias("first")).select(F.col("first.own").alias(own))
    once = join_ids(marked.where(F.col(own).isNotNull() & F.col(twice).isNull()), keepers, own, "left_semi").select(docs.columns)
    more = join_ids(marked.where(F.col(twice)), keepers, own, "left_semi").select(docs.columns)
    return docs.where(F.col("doc_id").isNull()).unionByName(once).unionByName(more.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth of the words or more lie in benchmark windows."""
    name = fresh(docs, "contamination")
    found = suffixes.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=name)
    return found.where(~suffixes.contaminated(suffixes.n_hit(name), F.col(f"{name}.n_words"))).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the text; ``n_chars``, if there, follows the text."""
    name = fresh(docs, "secrets")
    found = secrets.scan(docs, out=name)
    found = found.withColumn("text", F.when(F.size(name) > 0, secrets.redacted(F.col("text"), F.col(name), REDACTED)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size(name) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (little-endian unsigned 32-bit), with digests of them and of the
    text decoded from them."""
    spec = tokenizer_spec()
    rows = docs.select("doc_id", "text")
    got = bpe.encode_decode(rows, spec, bpe.build_lexicon(rows, spec))
    return got.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("BPE encoding and decoding", tokenize),
]

#: Trained models and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
