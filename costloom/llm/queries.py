"""The operators' registered queries: each over its whole tables, with production parameters."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, ctw, decontaminate, langid, mixing, neardup, pii, quality, tokens, urls
from .common import stored, table

#: Of the registered pseudonym query where the session has no spark.costloom.secret.
DEMO_KEY = "costloom-demo-key"


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.histogram(stored(tokens.encoded_lengths(table(spark, sf, "documents"), F.col("lang")).select("grp", "n_tokens")))


def op2_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    return chat.rendered(table(spark, sf, "conversations"))


def op3_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    out = ctw.scored(table(spark, sf, "documents"), ~ctw.held_out())
    return out.withColumn("held_out", ctw.held_out())


def op4_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents"), width=3, num=85, den=100)


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judged(table(spark, sf, "documents"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(table(spark, sf, "documents"))


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    field = langid.fitted(docs.where(~langid.held_out()))
    return langid.identified(docs, field).withColumn("held_out", langid.held_out())


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judged(table(spark, sf, "pages"))


def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    key = spark.conf.get("spark.costloom.secret", DEMO_KEY)
    return pii.pseudonymised(table(spark, sf, "documents"), key).select("doc_id", "text", "n_values")


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.decontaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("items", "near_items")


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_chat_format, op3_lm_score, op4_near_dedup, op5_quality_rules, op6_mixing, op7_language_id, op8_url_filter, op9_pii, op10_decontaminate)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE_SQL = {"op2_chat_format": chat.ORACLE, "op6_mixing": mixing.ORACLE, "op10_decontaminate": decontaminate.ORACLE}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
