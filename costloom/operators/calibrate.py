"""Conformal calibration of forecast intervals."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from . import ranks
from .checks import null_safe

MIN_GROUP_SCORES = 30
TAIL_DAYS = 90


def finite_sample_quantile(score: str, coverage: float) -> Column:
    """The ceil((n + 1) * coverage)-th smallest score, the greatest if that is beyond n, 0 without scores.

    For the scores of one series, which fit an array; pooled_quantile is for those of all.
    """
    got = F.sort_array(F.collect_list(score))
    k = F.least(F.ceil((F.count(score) + 1) * F.lit(coverage)), F.count(score)).cast("int")
    return F.when(F.count(score) > 0, F.try_element_at(got, F.greatest(k, F.lit(1)))).otherwise(F.lit(0.0))


def pooled_quantile(scores: DataFrame, by: Sequence[str], coverage: float, score: str = "score") -> DataFrame:
    """by, margin, n: the same value over any number of scores, by counts. Without any score there is no row."""
    return ranks.order_statistics(scores, by, score, {"margin": ranks.conformal_rank(coverage)})


def margins(ledger: DataFrame, keys: Sequence[str], coverage: float = 0.9, scaled: bool = True, min_scores: int = MIN_GROUP_SCORES) -> DataFrame:
    """keys, margin, n, guaranteed, pooled: one pooled row with null keys, and one for each group of enough scores."""
    s = ledger.withColumn("score", scalars.cqr_score(scaled=scaled)).where("score IS NOT NULL")
    agg = [finite_sample_quantile("score", coverage).alias("margin"), F.count("*").alias("n")]
    pooled = pooled_quantile(s, [], coverage).agg(F.coalesce(F.max("margin"), F.lit(0.0)).alias("margin"), F.coalesce(F.max("n"), F.lit(0)).alias("n"))
    pooled = pooled.select(*(F.lit(None).cast(ledger.schema[k].dataType).alias(k) for k in keys), "margin", "n", F.lit(True).alias("pooled"))
    by = s.dropna(subset=list(keys)).groupBy(*keys).agg(*agg).where(F.col("n") >= min_scores).withColumn("pooled", F.lit(False))
    return pooled.unionByName(by).withColumn("guaranteed", F.ceil((F.col("n") + 1) * F.lit(coverage)) <= F.col("n"))


def with_margin(preds: DataFrame, m: DataFrame, keys: Sequence[str], names: Sequence[str] = ("margin",)) -> DataFrame:
    """preds with each row's group margin, else the pooled one."""
    own = m.where("NOT pooled").select(*keys, *(F.col(n).alias(f"_g_{n}") for n in names))
    all_ = F.broadcast(m.where("pooled").select(*(F.col(n).alias(f"_p_{n}") for n in names)))  # one row
    out = preds.join(own, list(keys), "left").join(all_, how="left")
    return out.withColumns({n: F.coalesce(f"_g_{n}", f"_p_{n}", F.lit(0.0)) for n in names}).drop(*(f"_{s}_{n}" for n in names for s in "gp"))


def apply_margins(preds: DataFrame, m: DataFrame, keys: Sequence[str], scaled: bool = True) -> DataFrame:
    """preds with the interval moved by the margin (in its own widths if scaled)."""
    out = with_margin(preds, m, keys)
    lo, hi = scalars.widened("q05", "q50", "q95", F.col("margin"), scaled)
    return out.withColumns({"q05": lo, "q95": hi}).select(preds.columns)


def apply_additive(preds: DataFrame, m: DataFrame, keys: Sequence[str]) -> DataFrame:
    """preds with lower_margin taken from q05 and upper_margin added to q95, never below 0."""
    out = with_margin(preds, m, keys, ("lower_margin", "upper_margin"))
    return out.withColumns({"q05": F.greatest(F.col("q05") - F.col("lower_margin"), F.lit(0.0)), "q95": F.greatest(F.col("q95") + F.col("upper_margin"), F.lit(0.0))}).select(preds.columns)


def coverage(ledger: DataFrame) -> DataFrame:
    """model, coverage: the share of scored rows inside their interval."""
    return ledger.where("q50 IS NOT NULL AND y_true IS NOT NULL").groupBy("model").agg(F.avg(F.col("y_true").between(F.col("q05"), F.col("q95")).cast("double")).alias("coverage"))


def conformal(forecast: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame], tail_days: int = TAIL_DAYS, target: float = 0.9, scaled: bool = True):
    """A forecaster around another: it is first fitted without the last tail_days, which calibrate its interval when fitted to all.

    Origins share nothing: each has its own tail and margins. Too thin a tail gives margins of 0.
    """

    def run(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
        ends = train.groupBy("origin").agg(F.max("day").alias("end"))
        marked = train.join(ends, "origin").withColumn("late", F.col("day") > F.date_sub("end", tail_days))
        tail = forecast(marked.where("NOT late").drop("end", "late"), marked.where("late").drop("end", "late"), keys)
        s = tail.withColumn("score", scalars.cqr_score(scaled=scaled)).where("score IS NOT NULL")
        by = s.groupBy("origin", *keys).agg(finite_sample_quantile("score", target).alias("g"), F.count("*").alias("n")).where(F.col("n") >= MIN_GROUP_SCORES).drop("n")
        pooled = pooled_quantile(s, ["origin"], target).select("origin", F.col("margin").alias("p"))
        out = null_safe(forecast(train, test, keys), by, ["origin", *keys], "left").join(pooled, "origin", "left")
        lo, hi = scalars.widened("q05", "q50", "q95", F.coalesce("g", "p", F.lit(0.0)), scaled)
        return out.withColumns({"q05": lo, "q95": hi}).withColumn("model", F.concat(F.lit("conformal_"), "model")).drop("g", "p")

    return run


def trailing(day, days: int = TAIL_DAYS):
    """First and last day of the scores that calibrate `day`."""
    return day - timedelta(days=days), day - timedelta(days=1)
