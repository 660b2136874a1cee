"""A training-corpus pipeline: each stage takes documents (doc_id, text, lang, source, n_chars) and hands on what it keeps.

Stages are functions (spark, docs, sf_dir) -> DataFrame; each result is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents; the last adds topic, prob and n_tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.llm import decontaminate, mixing, neardup, pii, quality
from costloom.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Of the pseudonyms where the session has no spark.costloom.secret.
KEY = "costloom-pipeline-key"


def _row(*names: str) -> Column:
    """A hash of these columns that tells null from empty: the key of a row's own verdict, whatever other rows share its doc_id."""
    return F.xxhash64(*names, *(F.col(c).isNull() for c in names))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, among them null, empty and short texts. Rows of like id, text and language share a verdict; repeated rows all stay or all go."""
    key = _row("doc_id", "text", "lang")
    good = quality.judged(docs.withColumn("doc_id", key)).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.withColumn("_key", key).join(good, F.col("_key") == F.col("_id"), "left_semi").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of smallest id: five-word shingles, similarity 0.8.

    Different texts of one doc_id are documents of their own, the one of smaller hash first; a row repeated whole is one
    document and comes once. Rows without a doc_id stay, and so do null and wordless texts. Ids keep their type and order as it does.
    """
    docs = docs.select(COLUMNS)
    again = stored(docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).count().where("count > 1").select("_id"))
    if again.limit(1).count():  # only rows whose id repeats can be rows repeated whole
        many, of = docs.join(again, F.col("doc_id") == F.col("_id"), "left_semi").distinct(), F.col("doc_id") == F.col("_id")
        docs = stored(docs.join(again, of, "left_anti").unionByName(many))
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("_h")).where("doc_id IS NOT NULL")
    ids = stored(own.select("doc_id", "_h").distinct())
    if not ids.groupBy("doc_id").count().where("count > 1").limit(1).count():
        gone = neardup.near_duplicates(docs, width=5, num=80, den=100).where("NOT kept").select(F.col("doc_id").alias("_id")).distinct()
        return docs.join(gone, docs["doc_id"] == gone["_id"], "left_anti").select(COLUMNS)
    # numbers in the order of the ids, one for each text of an id
    ranks = stored(ids.orderBy("doc_id", "_h").select(F.col("doc_id").alias("_id"), F.col("_h").alias("_g"), F.monotonically_increasing_id().alias("_k")))
    ranked = stored(own.join(ranks, (F.col("doc_id") == F.col("_id")) & (F.col("_h") == F.col("_g"))).select(F.col("_k").alias("doc_id"), "text"))
    gone = neardup.near_duplicates(ranked, width=5, num=80, den=100).where("NOT kept").select(F.col("doc_id").alias("_k")).distinct()
    gone = ranks.join(gone, "_k", "left_semi")
    return docs.withColumn("_h", F.xxhash64("text")).join(gone, (F.col("doc_id") == F.col("_id")) & (F.col("_h") == F.col("_g")), "left_anti").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go. Rows of like id and text share a verdict, whatever others have their id; null texts stay."""
    key = _row("doc_id", "text")
    found = decontaminate.decontaminated(docs.withColumn("doc_id", key), table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("doc_id").alias("_id")).distinct()
    return docs.withColumn("_key", key).join(found, F.col("_key") == F.col("_id"), "left_anti").select(COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms of their format; n_chars follows where a text changes. Every row stays, null and empty texts as they are, repeated rows alike."""
    key = spark.conf.get("spark.costloom.secret", KEY)
    return pii.pseudonymised(docs, key).withColumn("n_chars", F.when(F.col("n_values") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(COLUMNS)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by their calibrated probabilities. Null source or language is a value of its own; rows of like id and cell are drawn alike."""
    return mixing.drawn(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination), ("private_data", private_data), ("mixing_to_weights", mixing_to_weights)]
#: Tokenisation, near-duplicate groups and keyed permutations have no SQL form here; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
