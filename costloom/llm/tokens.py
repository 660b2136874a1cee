"""Token counts: the exact histogram of encoded lengths, and what suffix sums over it answer.

Every document is encoded whole by a public byte-level vocabulary. The histogram has a row for each length that occurs;
suffix sums give, for each length taken as a context limit, the documents and tokens at or above it and the tokens left
when all are cut to it. Quantiles and totals for any limit are read off these rows, without another look at the texts.

Defined results: null and empty texts have length 0; special tokens' strings in a text are ordinary text; a null group is
a group; repeated rows count each; ids keep their type; an empty table gives an empty histogram; further columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_type, steps, vocabulary_file

#: Where the public vocabulary lies on the driver unless told otherwise.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that belongs to the vocabulary; it splits text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths whose rows meet in one task of the suffix sums.
SPAN = 1024

_made: dict = {}


def _encoding(ranks: bytes):
    if "e" not in _made:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _made["e"] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _made["e"]


def encoded_lengths(docs: DataFrame, group: Column | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, grp, n_tokens for each document."""
    ranks = vocabulary_file(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks.value).encode_ordinary
        for part in steps(batches):
            n = np.fromiter((len(encode(t)) if t else 0 for t in part.column(2).to_pylist()), np.int64, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n)], ["doc_id", "grp", "n_tokens"])

    own = docs.select("doc_id", (group if group is not None else F.lit("all")).cast("string").alias("grp"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, f"doc_id {id_type(docs)}, grp string, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """grp, n_tokens, n_docs, tokens, docs_at_least, tokens_at_least, truncated_tokens, docs_share_up_to.

    truncated_tokens: all tokens of the group if texts are cut to n_tokens. lengths: (grp, n_tokens), a row for each document.
    """
    h = lengths.groupBy("grp", "n_tokens").agg(F.count("*").alias("n_docs")).withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("span", F.floor(F.col("n_tokens") / SPAN))
    inner = W.partitionBy("grp", "span").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, 0)
    outer = W.partitionBy("grp").orderBy(F.col("span").desc()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("grp")
    spans = h.groupBy("grp", "span").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    spans = spans.select("grp", "span", *(F.coalesce(F.sum(c).over(outer), F.lit(0)).alias(f"{c}_above") for c in "dt"), *(F.sum(c).over(whole).alias(f"{c}_all") for c in "dt"))
    own = h.withColumn("d_in", F.sum("n_docs").over(inner)).withColumn("t_in", F.sum("tokens").over(inner)).alias("h")
    both = own.join(spans.alias("s"), F.col("h.grp").eqNullSafe(F.col("s.grp")) & (F.col("h.span") == F.col("s.span")))
    at = F.col("d_in") + F.col("d_above")
    t_at = F.col("t_in") + F.col("t_above")
    return both.select(
        "h.grp",
        "n_tokens",
        "n_docs",
        "tokens",
        at.alias("docs_at_least"),
        t_at.alias("tokens_at_least"),
        (F.col("t_all") - t_at + F.col("n_tokens") * at).alias("truncated_tokens"),
        ((F.col("d_all") - at + F.col("n_docs")) / F.col("d_all")).alias("docs_share_up_to"),
    )


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """grp, share, n_tokens: the least length that at least this share of the documents doesn't exceed."""
    want = F.explode(F.array(*map(F.lit, shares))).alias("share")
    return hist.select("*", want).where("docs_share_up_to >= share").groupBy("grp", "share").agg(F.min("n_tokens").alias("n_tokens"))


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """grp, limit, truncated_tokens: the tokens left if texts are cut to any limit, also one that no text has."""
    want = F.explode(F.array(*(F.lit(x).cast("long") for x in limits))).alias("limit")
    return hist.select("*", want).groupBy("grp", "limit").agg(F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("truncated_tokens"))
