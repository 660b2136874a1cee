"""Activity features of pool-days: work done, concurrency, job mix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import POOL_KEYS

_POOL = POOL_KEYS[1:]


def activity(jobs: DataFrame, keys: Sequence[str] = POOL_KEYS) -> DataFrame:
    """Job seconds, tasks and jobs of each group; rows with a null key are left out."""
    return jobs.dropna(subset=list(keys)).groupBy(*keys).agg(F.coalesce(F.sum("job_seconds"), F.lit(0.0)).alias("job_seconds"), F.coalesce(F.sum("task_count"), F.lit(0)).alias("task_count"), F.count("*").alias("job_rows"))


def running(jobs: DataFrame, keys: Sequence[str] = _POOL, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """keys, t, delta, running: the count of running jobs after each start or end; at equal times ends come first.

    The sum runs over each pool's whole history in two levels, days and the events of a day, so that no task holds more
    than a pool's day.
    """
    known = jobs.dropna(subset=[*keys, start, end])
    events = known.select(*keys, F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("delta")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("delta")))).alias("e"))
    events = events.select(*keys, "e.t", "e.delta", F.to_date("e.t").alias("day"))
    days = events.groupBy(*keys, "day").agg(F.sum("delta").alias("net"))
    before = days.select(*keys, "day", F.coalesce(F.sum("net").over(W.partitionBy(*keys).orderBy("day").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = W.partitionBy(*keys, "day").orderBy("t", "delta").rowsBetween(W.unboundedPreceding, 0)
    return events.withColumn("_in", F.sum("delta").over(inner)).join(before, [*keys, "day"]).select(*keys, "day", "t", "delta", (F.col("_in") + F.col("_before")).alias("running"))


def concurrency(jobs: DataFrame, keys: Sequence[str] = _POOL) -> DataFrame:
    """run_date, keys, peak_concurrency, mean_concurrency: over the day's events, not over time; a day without events has no row."""
    return running(jobs, keys).groupBy(F.col("day").alias("run_date"), *keys).agg(F.max("running").alias("peak_concurrency"), F.avg("running").alias("mean_concurrency"))


def share_name(category: str) -> str:
    return f"share_{category}"


def job_mix(jobs: DataFrame, levels: Sequence[str] | None = None, keys: Sequence[str] = POOL_KEYS, category: str = "job_category", seconds: str = "job_seconds") -> DataFrame:
    """n_jobs, largest_job_share and share_<category> of the job seconds of each group.

    Categories are the given levels, else those that occur (one job more). Shares are 0 where the group's seconds are.
    """
    rows = jobs.dropna(subset=list(keys))
    if levels is None:
        levels = sorted(r[0] for r in rows.select(category).distinct().collect() if r[0] is not None)
    total = F.sum(seconds)
    shares = [F.coalesce(F.try_divide(F.sum(F.when(F.col(category) == v, F.col(seconds))), F.when(total != 0, total)), F.lit(0.0)).alias(share_name(v)) for v in levels]
    largest = F.coalesce(F.try_divide(F.max(seconds), F.when(total != 0, total)), F.lit(0.0)).alias("largest_job_share")
    return rows.groupBy(*keys).agg(F.count("*").alias("n_jobs"), largest, *shares)


def reindexed_shares(df: DataFrame, expected: Sequence[str], prefix: str = "share_") -> tuple[DataFrame, list[str]]:
    """df with absent expected shares as 0, and the names of shares that were not expected."""
    missing = [c for c in expected if c.startswith(prefix) and c not in df.columns]
    novel = [c for c in df.columns if c.startswith(prefix) and c not in expected]
    return (df.withColumns({c: F.lit(0.0) for c in missing}) if missing else df), novel


def frozen_levels(df: DataFrame, levels: dict[str, Sequence[str]], max_unseen: float = 0.1) -> tuple[DataFrame, dict[str, int]]:
    """Labels that training did not see become null; more than max_unseen of a column's rows raises."""
    from ..errors import DataQualityError

    flags = {c: F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in levels.items()}
    row = df.agg(F.count("*").alias("_n"), *(F.count_if(x).alias(c) for c, x in flags.items())).first()
    for c in levels:
        if row["_n"] and row[c] > max_unseen * row["_n"]:
            raise DataQualityError(f"{c}: {row[c]} of {row['_n']} rows have labels unknown to the model")
    return df.withColumns({c: F.when(~flags[c], F.col(c)) for c in levels}), {c: row[c] for c in levels}
