"""Completeness gate and universe filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import EXCLUDED_TIERS, GATE_KEYS, RUN_TYPES, Eras
from ..functions import scalars


def latest_runs(run_status: DataFrame) -> DataFrame:
    """The last load of each day, subscription and type, by update_time, else run_time; of equal times the greatest status."""
    stamp = "update_time" if "update_time" in run_status.columns else "run_time"
    w = W.partitionBy(*GATE_KEYS, "run_type").orderBy(F.col(stamp).desc_nulls_last(), F.col("status").desc_nulls_last())
    return run_status.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def build_gate(run_status: DataFrame) -> DataFrame:
    """run_date, subscription_id, gate_complete: all three types' last loads are Complete; a missing type is not."""
    ok = F.col("status") == "Complete"
    per = [F.coalesce(F.max(F.when(F.col("run_type") == t, ok)), F.lit(False)) for t in RUN_TYPES]
    whole = per[0] & per[1] & per[2]
    return latest_runs(run_status).groupBy(*GATE_KEYS).agg(F.coalesce(whole, F.lit(False)).alias("gate_complete"))


def gate_states(frame: DataFrame, gate: DataFrame, era: date) -> DataFrame:
    """frame with gate_complete and gate_state. Ungated is only a day before the era without a gate row."""
    base = frame.drop("gate_complete", "gate_state")
    out = base.join(gate.select(*GATE_KEYS, "gate_complete"), GATE_KEYS, "left")
    state = F.when(F.col("gate_complete"), "gated_complete").when(F.col("gate_complete").isNull() & (F.col("run_date") < F.lit(era)), "ungated").otherwise("gated_failed")
    return out.withColumn("gate_state", state)


def apply_gate(frame: DataFrame, gate: DataFrame, era: date) -> DataFrame:
    """Rows whose gate did not fail."""
    return gate_states(frame, gate, era).where("gate_state <> 'gated_failed'")


def excluded_subscriptions(config: DataFrame, tiers: tuple[str, ...] = EXCLUDED_TIERS) -> DataFrame:
    return config.where(F.upper(F.trim("environment_tier")).isin(*tiers)).select("subscription_id").distinct()


def filter_tiers(tables: dict[str, DataFrame], tiers: tuple[str, ...] = EXCLUDED_TIERS) -> dict[str, DataFrame]:
    """Every table that has a subscription_id, without excluded tiers; unknown and null tiers stay. No config, no change."""
    config = tables.get("environment_config")
    if config is None or "environment_tier" not in config.columns:
        return tables
    out = excluded_subscriptions(config, tiers)
    return {n: t.join(out, "subscription_id", "left_anti") if "subscription_id" in t.columns else t for n, t in tables.items()}


def stamp_regime(frame: DataFrame, eras: Eras) -> DataFrame:
    return frame.withColumn("data_regime", scalars.regime("run_date", eras))


def drop_pre_coverage(frame: DataFrame) -> DataFrame:
    return frame.where("data_regime <> 'pre_coverage'")


def batch_slice(raw: DataFrame) -> DataFrame:
    """Pool rows; a null batch account becomes its sentinel so that it groups and joins."""
    return raw.where("pool_name IS NOT NULL").withColumn("batch_account_name", scalars.batch_key())


def non_pool(raw: DataFrame) -> DataFrame:
    return raw.where("pool_name IS NULL")


def priceable(usage: str = "usage_quantity", cost: str = "pre_tax_cost"):
    return (F.col(usage) > 0) & (F.col(cost) > 0)


def training_slice_1b(frame: DataFrame) -> DataFrame:
    return frame.where("post_glide AND data_regime = 'featured_gated'")


def filter_unknown(frame: DataFrame, limit: float = 0.2) -> DataFrame:
    return frame.where(F.col("unknown_pct") <= limit)
