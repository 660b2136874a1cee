"""Streaming forms of what the batch plans keep: new loads scored once, the append-only rule, daily totals."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import RAW_GRAIN, DetectorConfig
from ..functions import scalars
from ..operators.checks import present
from ..operators.detector import WIDTH_FLOOR, Cusum

#: Microseconds.
DAY = 86_400_000_000


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def daily_cost(raw: DataFrame, late: str = "10 days") -> DataFrame:
    """day window, subscription, pool totals of billing lines; a day is final when lines are `late` beyond it."""
    return raw.withWatermark("update_time", late).groupBy(F.window("update_time", "1 day"), "subscription_id", scalars.batch_key().alias("batch_account_name"), "pool_name").agg(F.sum("pre_tax_cost").alias("cost"), F.count("*").alias("lines"))


def rewrites(raw: DataFrame, late: str = "10 days") -> DataFrame:
    """Each row grain's write once for each of its times within the watermark."""
    keys = present(raw, RAW_GRAIN)
    return raw.withWatermark("update_time", late).dropDuplicatesWithinWatermark([*keys, "update_time"])


def violations(raw: DataFrame, late: str = "40 days") -> DataFrame:
    """The day's row grains that were written at more than one time: keys, first and last time; for output mode update.

    The append-only rule holds while there is none. A grain is watched until its day is `late` behind the newest.
    """
    keys = present(raw, RAW_GRAIN)
    dated = raw.withColumn("day", F.col("run_date").cast("timestamp")).withWatermark("day", late)
    seen = dated.groupBy("day", *keys).agg(F.min("update_time").alias("first_write"), F.max("update_time").alias("last_write"))
    return seen.where("first_write <> last_write")


def completed_loads(status: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Call `each` with the days and subscriptions whose load has completed since the last run, however late: the trigger of their re-scoring.

    Re-scoring appends under a new scoring time, and the current view takes the latest, so a repeated batch changes nothing.
    """
    done = status.where("status = 'Complete'").select("run_date", "subscription_id").where("run_date IS NOT NULL")

    def batch(df: DataFrame, number: int) -> None:
        days = df.distinct()
        if days.limit(1).count():
            each(days, number)

    return done.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()


def run_available(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process all that is there, batch by batch, and stop; a restart goes on where the checkpoint ends."""
    return df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def append_ledger(preds: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Predictions appended once to Parquet by frame and scoring time."""
    return preds.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("frame", "scored_at").outputMode("append").trigger(availableNow=True).start()


def _types(df: DataFrame, cols: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in cols)


def _keyed(keys: list[str], key: tuple, **cols) -> pd.DataFrame:
    n = len(next(iter(cols.values())))
    return pd.DataFrame({**{k: [v] * n for k, v in zip(keys, key)}, **cols})


def cusum_stream(ledger: DataFrame, keys: list[str], config: DetectorConfig = DetectorConfig()) -> DataFrame:
    """keys, run_date, z, s_pos, s_neg, alarm for a stream of (keys, run_date, y_true, q50), each group's days in order across batches.

    State of a group: its trailing residuals and the two sums. The arithmetic is the batch detector's.
    """

    def step(key, batches, state: GroupState):
        past, p, n = state.get if state.exists else ([], 0.0, 0.0)
        rows = pd.concat(list(batches)).dropna(subset=["y_true", "q50"])
        rows = rows.assign(r=rows["y_true"] - rows["q50"]).sort_values(["run_date", "r"])
        walk = Cusum(config, past, p, n)
        _, z, pos, neg, alarm = walk(rows["r"].to_numpy(float))
        state.update(([float(x) for x in walk.past], walk.s_pos, walk.s_neg))
        yield _keyed(keys, key, run_date=rows["run_date"].to_numpy(), z=z, s_pos=pos, s_neg=neg, alarm=alarm)

    out = f"{_types(ledger, keys)}, run_date date, z double, s_pos double, s_neg double, alarm string"
    return ledger.groupBy(*keys).applyInPandasWithState(step, out, "past array<double>, s_pos double, s_neg double", "append", GroupStateTimeout.NoTimeout)


def margin_stream(ledger: DataFrame, keys: list[str], config: DetectorConfig = DetectorConfig()) -> DataFrame:
    """keys, run_date, margin, n: for each row the group's conformal margin over the days before, null with too few scores.

    State of a group: the days and scores of the trailing window.
    """

    def step(key, batches, state: GroupState):
        days, scores = state.get if state.exists else ([], [])
        rows = pd.concat(list(batches)).dropna(subset=["y_true", "q05", "q95"]).sort_values("run_date")
        y, lo, hi = (rows[c].to_numpy(float) for c in ("y_true", "q05", "q95"))
        day = np.array([d.toordinal() for d in rows["run_date"]], np.int64)
        all_days = np.concatenate((np.array(days, np.int64), day))
        all_scores = np.concatenate((np.array(scores, float), np.maximum(lo - y, y - hi) / np.maximum(hi - lo, WIDTH_FLOOR)))
        margin, count = [], []
        for d in day:
            own = np.sort(all_scores[(all_days >= d - config.margin_window_days) & (all_days < d)])
            k = min(ceil((len(own) + 1) * config.target_coverage), len(own))
            margin.append(float(own[k - 1]) if len(own) >= config.min_margin_scores else None)
            count.append(len(own))
        keep = all_days > all_days.max(initial=0) - config.margin_window_days
        state.update(([int(x) for x in all_days[keep]], [float(x) for x in all_scores[keep]]))
        yield _keyed(keys, key, run_date=rows["run_date"].to_numpy(), margin=margin, n=count)

    out = f"{_types(ledger, keys)}, run_date date, margin double, n long"
    return ledger.groupBy(*keys).applyInPandasWithState(step, out, "days array<long>, scores array<double>", "append", GroupStateTimeout.NoTimeout)


def concurrency_stream(jobs: DataFrame, keys: list[str], late_days: int = 2) -> DataFrame:
    """keys, run_date, peak_concurrency, mean_concurrency of each day that is late_days behind a group's newest start or end.

    State of a group: the count of jobs that run, and the starts and ends of days that are still open; at equal times ends
    come first. A job that arrives after its days are closed only counts in what is open.
    """

    def step(key, batches, state: GroupState):
        running, times, deltas = state.get if state.exists else (0, [], [])
        rows = pd.concat(list(batches)).dropna(subset=["start_time", "end_time"])
        t = np.concatenate((np.array(times, np.int64), *(rows[c].to_numpy("datetime64[us]").astype(np.int64) for c in ("start_time", "end_time"))))
        d = np.concatenate((np.array(deltas, np.int64), np.ones(len(rows), np.int64), -np.ones(len(rows), np.int64)))
        order = np.lexsort((d, t))
        t, d = t[order], d[order]
        day = t // DAY
        closed = day <= day.max(initial=0) - late_days
        now = running + np.cumsum(d[closed])
        state.update((int(now[-1]) if len(now) else running, [int(x) for x in t[~closed]], [int(x) for x in d[~closed]]))
        by = pd.DataFrame({"day": day[closed], "n": now}).groupby("day")["n"].agg(["max", "mean"])
        yield _keyed(keys, key, run_date=[date(1970, 1, 1) + timedelta(days=int(x)) for x in by.index], peak_concurrency=by["max"].to_numpy(), mean_concurrency=by["mean"].to_numpy())

    known = jobs.dropna(subset=keys).select(*keys, "start_time", "end_time")
    out = f"{_types(jobs, keys)}, run_date date, peak_concurrency long, mean_concurrency double"
    return known.groupBy(*keys).applyInPandasWithState(step, out, "running long, times array<long>, deltas array<long>", "append", GroupStateTimeout.NoTimeout)
