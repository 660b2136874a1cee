"""Forecast quality of a ledger, by model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pinball(y: Column, q: Column, tau: float) -> Column:
    d = y - q
    return F.greatest(F.lit(tau) * d, F.lit(tau - 1.0) * d)


def evaluate(ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """model, n, n_scored, mae, monthly_pct_err, estate_pct_err, bias, wape, pinball_05/50/95, coverage, ordered by mae.

    Monthly sums use pred_mean where the model has one, else the median. Ratios skip sums of 0.
    """
    if "pred_mean" not in ledger.columns:
        ledger = ledger.withColumn("pred_mean", F.lit(None).cast("double"))
    means = ledger.groupBy("model").agg((F.count("pred_mean") > 0).alias("_m"))
    rows = ledger.join(F.broadcast(means), "model").withColumn("point", F.when(F.col("_m"), F.col("pred_mean")).otherwise(F.col("q50")))
    scored = F.col("q50").isNotNull() & F.col("y_true").isNotNull()
    y = F.col("y_true")
    inside = ((y >= F.col("q05")) & (y <= F.col("q95"))).cast("double")
    flat = rows.groupBy("model").agg(
        F.count("*").alias("n"),
        F.count_if(scored).alias("n_scored"),
        F.avg(F.when(scored, F.abs(y - F.col("q50")))).alias("mae"),
        *(F.avg(F.when(scored, pinball(y, F.col(f"q{t}"), int(t) / 100))).alias(f"pinball_{t}") for t in ("05", "50", "95")),
        F.avg(F.when(scored, inside)).alias("coverage"),
    )
    month = rows.where(scored).groupBy("model", "origin", *keys).agg(F.sum("y_true").alias("a"), F.sum("point").alias("p"))
    big = F.abs("a") > 1e-9
    by_month = month.groupBy("model").agg(F.avg(F.when(big, F.abs(F.col("p") - F.col("a")) / F.abs("a"))).alias("monthly_pct_err"), F.try_divide(F.sum(F.abs(F.col("p") - F.col("a"))), F.when(F.sum(F.abs("a")) > 1e-9, F.sum(F.abs("a")))).alias("wape"))
    estate = month.groupBy("model", "origin").agg(F.sum("a").alias("a"), F.sum("p").alias("p")).groupBy("model").agg(F.avg(F.when(big, F.abs(F.col("p") - F.col("a")) / F.abs("a"))).alias("estate_pct_err"), F.avg(F.when(big, (F.col("p") - F.col("a")) / F.col("a"))).alias("bias"))
    return flat.join(by_month, "model", "left").join(estate, "model", "left").orderBy(F.col("mae").asc_nulls_last(), "model")
