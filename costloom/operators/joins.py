"""Joins of the billing domain: attributes, enrichment, reconciliation, provenance reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import JOB_ATTRIBUTES, JOB_KEYS, POOL_KEYS, UNKNOWN
from ..functions import scalars
from .checks import assert_unique, null_safe, present
from .gate import batch_slice


def one_per_key(df: DataFrame, keys: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """One row for each key: the least by the other columns, nulls first. A single pass with partial aggregation."""
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_x")).select(*keys, *(F.col(f"_x.{c}").alias(c) for c in rest))


def join_attributes(usage: DataFrame, job_cost: DataFrame, check: bool = True) -> DataFrame:
    """usage with the jobs' attributes; without a job cost row, or with a null attribute, Unknown. Adds `usage_only`."""
    if check:
        assert_unique(usage, JOB_KEYS, "job usage before its join")
    have = present(job_cost, JOB_ATTRIBUTES)
    right = one_per_key(job_cost, JOB_KEYS, have).withColumn("_hit", F.lit(True))
    out = null_safe(usage.drop(*have), right, JOB_KEYS, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in have}).withColumn("usage_only", F.col("_hit").isNull()).drop("_hit")


def provenance(left: DataFrame, right: DataFrame, keys: Sequence[str], left_name: str = "left", right_name: str = "right") -> DataFrame:
    """source, n: rows of the left and distinct keys of the right, by where the key occurs."""
    l = left.select(*keys).withColumn("_l", F.lit(True))
    r = right.select(*keys).distinct().withColumn("_r", F.lit(True))
    both = null_safe(l, r, keys, "full")
    where = F.when(F.col("_r").isNull(), f"{left_name}_only").when(F.col("_l").isNull(), f"{right_name}_only").otherwise("both")
    return both.groupBy(where.alias("source")).agg(F.count("*").alias("n"))


def enrich_environment(frame: DataFrame, config: DataFrame) -> DataFrame:
    """Tier and region by subscription; a subscription counts once."""
    cols = present(config, ["subscription_name", "environment_tier", "environment_sub_tier"])
    right = one_per_key(config, ["subscription_id"], cols)
    out = frame.join(right, "subscription_id", "left")
    return out.withColumn("region", scalars.region("subscription_name")) if "subscription_name" in cols else out


def reconcile(raw: DataFrame, job_cost: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Pool-days with raw_cost, job_cost, coverage (both, raw_only, job_only), diff, rel_diff and within_tol.

    Job cost without a full pool key is left out; a raw null batch account is its sentinel.
    """
    r = batch_slice(raw).groupBy(*POOL_KEYS).agg(F.sum("pre_tax_cost").cast("double").alias("raw_cost"))
    j = job_cost.dropna(subset=POOL_KEYS).groupBy(*POOL_KEYS).agg(F.sum("cost").cast("double").alias("job_cost"))
    out = r.join(j, POOL_KEYS, "full")
    cover = F.when(F.col("job_cost").isNull(), "raw_only").when(F.col("raw_cost").isNull(), "job_only").otherwise("both")
    out = out.withColumn("coverage", cover).withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("raw_cost", "job_cost")})
    out = out.withColumn("diff", F.col("job_cost") - F.col("raw_cost"))
    rel = F.try_divide(F.col("diff"), F.when(F.col("raw_cost") != 0, F.col("raw_cost")))
    return out.withColumn("rel_diff", rel).withColumn("within_tol", F.coalesce((F.col("coverage") == "both") & (F.abs(rel) <= tolerance), F.lit(False)))


def reconciliation_summary(recon: DataFrame) -> DataFrame:
    """One row of counts, totals, ratio, shares and the verdict."""
    both = F.col("coverage") == "both"
    exact = lambda c: F.sum(c.cast("decimal(38,6)")).cast("double")  # noqa: E731  sums that don't depend on the order
    total = F.coalesce(exact(F.col("raw_cost")), F.lit(0.0))
    s = recon.agg(
        F.count("*").alias("pool_days"),
        F.count_if(both).alias("both"),
        F.count_if(F.col("coverage") == "raw_only").alias("raw_only"),
        F.count_if(F.col("coverage") == "job_only").alias("job_only"),
        total.alias("raw_total"),
        F.coalesce(exact(F.col("job_cost")), F.lit(0.0)).alias("job_total"),
        F.try_divide(exact(F.col("job_cost")), F.when(total != 0, total)).alias("ratio"),
        F.try_divide(F.coalesce(exact(F.when(F.col("coverage") == "raw_only", F.col("raw_cost"))), F.lit(0.0)), F.when(total != 0, total)).alias("unattributed_share"),
        F.percentile(F.when(both, F.abs("rel_diff")), F.lit(0.5)).alias("median_abs_rel"),
        F.avg(F.when(both, F.col("within_tol").cast("double"))).alias("share_ok"),
    )
    agree = (F.col("median_abs_rel") <= 0.02) & (F.col("share_ok") >= 0.9)
    verdict = (
        F.when(F.col("both") == 0, "NO OVERLAP")
        .when(agree & (F.col("unattributed_share") >= 0.05), "EXACT SUBSET")
        .when(agree, "AGREE")
        .otherwise("DISAGREE")
    )
    return s.withColumn("verdict", verdict)


def carry_status(new: DataFrame, previous: DataFrame) -> DataFrame:
    """New alerts with the triage status that an alert of the same id had."""
    old = previous.groupBy("alert_id").agg(F.max("status").alias("_s"))
    return new.join(old, "alert_id", "left").withColumn("status", F.coalesce("_s", F.lit("new"))).drop("_s").select(new.columns)


def with_total(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """The group's total beside each row, without a join."""
    return df.withColumn(name, F.sum(col).over(W.partitionBy(*keys)))
