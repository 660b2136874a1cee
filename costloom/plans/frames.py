"""The gated daily frames: pools (1a), non-pool segments (1b), teams (2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import JOB_KEYS, POOL_KEYS, RAW_GRAIN, UNKNOWN, Eras, Frame, FrameSpec
from ..errors import DataQualityError
from ..functions import scalars
from ..operators import checks, factory, features, gate, joins

_POOL = POOL_KEYS[1:]


def _levels(job_cost: DataFrame) -> list[str]:
    """Job categories that occur: a label set, small by meaning."""
    return sorted(r[0] for r in job_cost.select("job_category").distinct().collect() if r[0] is not None)


def daily_pool_cost(raw: DataFrame) -> DataFrame:
    """POOL_KEYS, cost: the pool branch with its sentinel for a null batch account."""
    return gate.batch_slice(raw).groupBy(*POOL_KEYS).agg(F.sum("pre_tax_cost").cast("double").alias("cost"))  # decimal lines add up exactly


def pool_frame(tables: dict[str, DataFrame], eras: Eras = Eras(), levels: Sequence[str] | None = None, check: bool = True) -> DataFrame:
    """Pool-days with cost, activity, concurrency and mix, regime and gate; failed days are gone."""
    raw, jobs = tables["raw_cost"], tables["job_usage"]
    if check:
        checks.assert_unique(gate.batch_slice(raw), checks.present(raw, [*RAW_GRAIN, "update_time"]), "pool billing rows")
    levels = list(levels) if levels is not None else [*_levels(tables["job_cost"]), UNKNOWN]
    attributed = joins.join_attributes(jobs, tables["job_cost"], check).withColumn("batch_account_name", scalars.batch_key())
    out = daily_pool_cost(raw)
    for part in (features.activity(attributed).drop("job_rows"), features.concurrency(attributed), features.job_mix(attributed, levels)):
        out = out.join(part, POOL_KEYS, "left")
    out = gate.drop_pre_coverage(gate.stamp_regime(out, eras))
    out = gate.apply_gate(out, gate.build_gate(tables["run_status"]), eras.gated)
    if check:
        checks.assert_gated(out, "pool frame")
    return out


def _enriched(frame: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    return joins.enrich_environment(frame, tables["environment_config"]) if "environment_config" in tables else frame


def _categories(frame: DataFrame, own: Sequence[str]) -> list[str]:
    """The label features: the frame's own and those of its environment."""
    return [c for c in (*own, "environment_tier", "environment_sub_tier", "region") if c in frame.columns]


def frame_1a(tables: dict[str, DataFrame], eras: Eras = Eras(), levels: Sequence[str] | None = None, check: bool = True) -> Frame:
    """Pools: padded on complete days, price drift, lags and windows that end the day before, calendar, environment."""
    base = pool_frame(tables, eras, levels, check)
    shares = [c for c in base.columns if c.startswith("share_")]
    g = gate.build_gate(tables["run_status"])
    activity = ["job_seconds", "task_count", "peak_concurrency", "mean_concurrency", "n_jobs", "largest_job_share", *shares]
    out = factory.pad_daily(base, _POOL, ["cost", *activity], gate=g)
    out = gate.stamp_regime(out, eras)
    if check and out.where("padded AND data_regime <> 'featured_gated'").limit(1).count():
        raise DataQualityError("frame 1a: padded days before the gate's era")
    out = out.withColumn("gate_state", F.when(F.col("padded"), "gated_complete").otherwise(F.col("gate_state")))
    drift = factory.price_drift(gate.batch_slice(tables["raw_cost"]), _POOL)
    out = out.join(drift, POOL_KEYS, "left")
    made = factory.lagged(["cost"], [1, 7], _POOL) | factory.lagged([*activity, "price_drift"], [1], _POOL)
    made |= factory.rolled(["cost"], [28], _POOL) | factory.rolled(["job_seconds"], [7], _POOL)
    out = out.withColumns(made)
    out = _enriched(scalars.add_calendar(out), tables)
    labels = _categories(out, ["pool_name"])
    feats = [*made, *scalars.calendar(), *labels]
    checks.assert_no_unlagged(feats, "cost", "frame 1a")
    if check:
        checks.assert_gated(out, "frame 1a")
    return Frame(out, FrameSpec(_POOL), feats, labels, {"orphans": joins.provenance(tables["job_usage"], tables["job_cost"], JOB_KEYS, "usage", "cost")})


def frame_1b(tables: dict[str, DataFrame], eras: Eras = Eras(), check: bool = True) -> Frame:
    """Non-pool segments by subscription on a shared spine; padded before gating, so days are real days."""
    raw = tables["raw_cost"]
    rest = gate.non_pool(raw).withColumn("segment", scalars.segment())
    if check:
        checks.assert_unique(gate.non_pool(raw), [c for c in raw.columns if c != "update_time"], "non-pool billing rows")
        checks.assert_partition(raw, [raw.where("pool_name IS NOT NULL"), gate.non_pool(raw)], "pre_tax_cost", "pool and non-pool")
    keys = ["subscription_id", "segment"]
    daily = rest.dropna(subset=["run_date", *keys]).groupBy("run_date", *keys).agg(F.sum("pre_tax_cost").cast("double").alias("cost"), F.count("*").alias("line_count"))
    g = gate.build_gate(tables["run_status"])
    out = factory.pad_daily(daily, keys, ["cost", "line_count"], gate=g, shared=True)
    out = gate.apply_gate(gate.drop_pre_coverage(gate.stamp_regime(out, eras)), g, eras.gated)
    out = out.join(factory.price_drift(rest, keys), ["run_date", *keys], "left")
    made = factory.lagged(["cost"], [1, 7], keys) | factory.lagged(["line_count", "price_drift"], [1], keys) | factory.rolled(["cost"], [28], keys)
    out = _enriched(scalars.add_calendar(out.withColumns(made)).withColumn("post_glide", F.col("run_date") >= F.lit(eras.post_glide)), tables)
    if check:
        checks.assert_gated(out, "frame 1b")
    labels = _categories(out, keys)
    grain = checks.duplicate_rate(gate.non_pool(raw), checks.present(raw, ["run_date", "subscription_id", "resource_group_name", "resource_type", "meter"]))
    return Frame(out, FrameSpec(keys), [*made, *scalars.calendar(), *labels], labels, {"grain": grain}, eras.post_glide)


def team_rows(tables: dict[str, DataFrame], eras: Eras = Eras()) -> DataFrame:
    """Job cost of covered days whose gate did not fail, null teams as their sentinel."""
    cost = tables["job_cost"].withColumn("job_team", scalars.team_key())
    return gate.apply_gate(gate.drop_pre_coverage(gate.stamp_regime(cost, eras)), gate.build_gate(tables["run_status"]), eras.gated)


def team_days(tables: dict[str, DataFrame], eras: Eras = Eras()) -> DataFrame:
    """Gated job cost by day and team, with the day's share of unknown and null teams and whether all its subscriptions are gated."""
    rows = team_rows(tables, eras)
    per = rows.groupBy("run_date", "job_team").agg(F.sum("cost").alias("cost"), F.bool_and(F.col("gate_state") == "gated_complete").alias("_g"))
    day = W.partitionBy("run_date")
    unknown = F.coalesce(F.sum(F.when(F.col("job_team").isin(*scalars.UNKNOWN_TEAMS), F.col("cost"))).over(day).cast("double"), F.lit(0.0))
    total = F.sum("cost").over(day).cast("double")
    return per.withColumns({"unknown_pct": F.coalesce(F.try_divide(unknown, F.when(total != 0, total)), F.lit(0.0)), "fully_gated": F.bool_and("_g").over(day)}).drop("_g")


def team_grid(per: DataFrame) -> DataFrame:
    """The days and teams of team_days as a whole grid: cost (0 where a team had nothing), padded, and the day's columns."""
    days = per.groupBy("run_date").agg(F.max("unknown_pct").alias("unknown_pct"), F.bool_and("fully_gated").alias("fully_gated"))
    teams = per.select("job_team").distinct()
    grid = days.crossJoin(F.broadcast(teams)) if teams.limit(10_001).count() <= 10_000 else days.crossJoin(teams)  # the result itself is days x teams
    out = grid.join(per.select("run_date", "job_team", "cost"), ["run_date", "job_team"], "left")
    return out.withColumn("padded", F.col("cost").isNull()).withColumn("cost", F.coalesce(F.col("cost").cast("double"), F.lit(0.0)))


def frame_2(tables: dict[str, DataFrame], eras: Eras = Eras(), levels: Sequence[str] | None = None, check: bool = True) -> Frame:
    """Teams on the whole grid of observed days and teams, zero where a team had nothing."""
    per = team_days(tables, eras)
    out = team_grid(per)
    if check:
        checks.assert_additive(out, per, "run_date", "cost", "team grid")
    attributed = joins.join_attributes(tables["job_usage"], team_rows(tables, eras), check)
    levels = list(levels) if levels is not None else [*_levels(tables["job_cost"]), UNKNOWN]
    keys = ["run_date", "job_team"]
    mix = features.job_mix(attributed, levels, keys).drop("largest_job_share")
    mix = mix.withColumnsRenamed({c: c.lower() for c in mix.columns if c.startswith("share_")})
    act = features.activity(attributed, keys).drop("job_rows")
    num = [c for c in [*act.columns, *mix.columns] if c not in keys]
    out = out.join(act, keys, "left").join(mix, keys, "left").fillna(0, num)
    made = factory.lagged(["cost"], [1, 7], ["job_team"]) | factory.lagged(num, [1], ["job_team"]) | factory.rolled(["cost"], [28], ["job_team"])
    out = scalars.add_calendar(out.withColumns(made))
    state = F.when(F.col("fully_gated"), "gated_complete").otherwise("ungated")
    out = gate.stamp_regime(out.withColumn("gate_state", state), eras)
    if check:
        checks.assert_gated(out, "frame 2")
    return Frame(out, FrameSpec(["job_team"]), [*made, *scalars.calendar(), "job_team"], ["job_team"], {"orphans": joins.provenance(tables["job_usage"], tables["job_cost"], JOB_KEYS, "usage", "cost")})


BUILDERS = {"1a": frame_1a, "1b": frame_1b, "2": frame_2}
#: The rows each frame is judged on, within the regimes asked for.
SLICES = {"1a": lambda f: f, "1b": gate.training_slice_1b, "2": gate.filter_unknown}
