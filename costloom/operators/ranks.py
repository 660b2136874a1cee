"""Exact order statistics of columns that are too long for one array or one task.

Values are counted by buckets that keep their order; running counts of the buckets say in which one a rank lies, and only
that bucket's values are sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Rank = Callable[[Column], Column]


def bucket(c: str) -> Column:
    """A whole number that never falls as the value rises; about 256 for each factor of e."""
    return F.floor(F.signum(c) * F.log1p(F.abs(c)) * 256)


def counted(rows: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """by, _b, _v, _c: distinct values with their bucket and count; nulls are left out."""
    return rows.where(F.col(col).isNotNull()).groupBy(*by, F.col(col).cast("double").alias("_v")).agg(F.count("*").alias("_c")).withColumn("_b", bucket("_v"))


def targets(buckets: DataFrame, by: Sequence[str], ranks: Mapping[str, Rank]) -> DataFrame:
    """by, _b, _name, _rest, _n: for each rank the bucket it lies in and its rank there; buckets has by, _b, _h (counts)."""
    run = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
    out = buckets.withColumns({"_upto": F.sum("_h").over(run), "_n": F.sum("_h").over(W.partitionBy(*by))})
    asked = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), r(F.col("_n")).cast("long").alias("r")) for k, r in ranks.items())))
    out = out.withColumn("_a", asked).withColumn("_rest", F.col("_a.r") - F.col("_upto") + F.col("_h"))
    return out.where("_rest >= 1 AND _rest <= _h").select(*by, "_b", F.col("_a.k").alias("_name"), "_rest", "_n")


def picked(hits: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """by, n and the named values; hits has by, _name, _rest, _n and the values _v of the bucket with their counts _c."""
    run = W.partitionBy(*by, "_name").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    out = hits.withColumn("_upto", F.sum("_c").over(run)).where("_upto >= _rest AND _upto - _c < _rest")
    return out.groupBy(*by).agg(F.max("_n").alias("n"), *(F.max(F.when(F.col("_name") == k, F.col("_v"))).alias(k) for k in names)).where("n IS NOT NULL")


def order_statistics(rows: DataFrame, by: Sequence[str], col: str, ranks: Mapping[str, Rank]) -> DataFrame:
    """by (without nulls), n and, for each name, the value of the rank that ranks[name] makes of n; ranks count from 1. Groups without values have no row."""
    vals = counted(rows, by, col)
    goal = targets(vals.groupBy(*by, "_b").agg(F.sum("_c").alias("_h")), by, ranks)
    return picked(vals.join(goal, [*by, "_b"]), by, list(ranks))


def conformal_rank(coverage: float) -> Rank:
    """The ceil((n + 1) * coverage)-th smallest, the greatest if that is beyond n."""
    return lambda n: F.greatest(F.least(F.ceil((n + 1) * F.lit(coverage)), n), F.lit(1))


def quantiles(rows: DataFrame, by: Sequence[str], col: str, wanted: Mapping[str, float]) -> DataFrame:
    """by and the named quantiles, interpolated between the two nearest values."""
    at = lambda p: (lambda n: F.floor(F.lit(p) * (n - 1)) + 1)
    nxt = lambda p: (lambda n: F.least(F.floor(F.lit(p) * (n - 1)) + 2, n))
    got = order_statistics(rows, by, col, {f"_{k}0": at(p) for k, p in wanted.items()} | {f"_{k}1": nxt(p) for k, p in wanted.items()})
    part = lambda p: F.lit(p) * (F.col("n") - 1) - F.floor(F.lit(p) * (F.col("n") - 1))
    return got.select(*by, *((F.col(f"_{k}0") + part(p) * (F.col(f"_{k}1") - F.col(f"_{k}0"))).alias(k) for k, p in wanted.items()))
