"""The layered anomaly detector and its alert table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DetectorConfig
from ..functions import scalars
from ..functions.scalars import ALERT_COLUMNS
from . import calibrate, ranks
from .joins import carry_status

# The keys of a job's profile.
JOB_PROFILE_KEYS = ["subscription_id", "batch_account_name", "pool_name", "job_name"]
# From the median absolute deviation to a standard deviation, and the least spread.
MAD_SCALE, WIDTH_FLOOR = 1.4826, 1e-9


def _alerts(rows: DataFrame, layer: str, metric: str, config: DetectorConfig) -> DataFrame:
    """rows (run_date, scope, direction, score, message, and some of the other columns) as alerts."""
    null = {c: F.lit(None).cast("double") for c in ("observed", "expected", "lo", "hi", "impact") if c not in rows.columns}
    out = rows.withColumns(null | {"layer": F.lit(layer), "metric": F.lit(metric), "status": F.lit("new")})
    if "severity" not in out.columns:
        out = out.withColumn("severity", scalars.severity(F.col("score"), F.col("impact"), config))
    out = out.withColumn("alert_id", scalars.alert_id(F.col("layer"), F.col("scope"), F.col("run_date"), F.col("direction")))
    return out.select(*ALERT_COLUMNS)


# Layer 1: intervals.


def pooled_margins(scores: DataFrame, days: DataFrame, config: DetectorConfig = DetectorConfig()) -> DataFrame:
    """run_date, margin, n: for each day of `days` (d) the margin of all scores of the margin_window_days days before it.

    Scores (run_date, score) are counted by day and bucket; only these counts meet every day they serve, and of the
    scores themselves only the one bucket that holds a day's rank.
    """
    vals = ranks.counted(scores, ["run_date"], "score")
    pairs = days.select("d", F.explode(F.sequence(F.date_sub("d", config.margin_window_days), F.date_sub("d", 1))).alias("run_date"))
    held = vals.groupBy("run_date", "_b").agg(F.sum("_c").alias("_h"))
    by_day = pairs.join(held, "run_date").groupBy("d", "_b").agg(F.sum("_h").alias("_h"))
    goal = ranks.targets(by_day, ["d"], {"margin": ranks.conformal_rank(config.target_coverage)})
    hits = goal.join(pairs, "d").join(vals, ["run_date", "_b"]).groupBy("d", "_name", "_rest", "_n", "_v").agg(F.sum("_c").alias("_c"))
    return ranks.picked(hits, ["d"], ["margin"]).withColumnRenamed("d", "run_date")


def calibrated(ledger: DataFrame, keys: Sequence[str], config: DetectorConfig = DetectorConfig(), score_from: date | None = None) -> DataFrame:
    """The ledger's rows from score_from on with margin, lo and hi, calibrated on the days before each: by its group's scores if there are enough, else by all.

    A group's scores of the days before are one array, no longer than these days.
    """
    known = ledger.dropna(subset=["y_true", "q05", "q50", "q95"]).withColumn("_s", scalars.cqr_score())
    past = W.partitionBy(*keys).orderBy(F.unix_date("run_date")).rangeBetween(-config.margin_window_days, -1)
    rows = known.withColumn("_past", F.sort_array(F.collect_list("_s").over(past)))
    rows = rows.where(F.col("run_date") >= F.lit(score_from)) if score_from else rows
    n = F.size("_past")
    k = ranks.conformal_rank(config.target_coverage)(n).cast("int")
    whole = F.lit(True)
    for c in keys:
        whole = whole & F.col(c).isNotNull()
    rows = rows.withColumn("_own", F.when(whole & (n >= config.min_margin_scores), F.try_element_at("_past", k))).drop("_past")
    days = known.select(F.col("run_date").alias("d")).distinct()
    days = days.where(F.col("d") >= F.lit(score_from)) if score_from else days
    pooled = pooled_margins(known.select("run_date", F.col("_s").alias("score")), days, config)
    rows = rows.join(pooled.select("run_date", F.col("margin").alias("_p")), "run_date")  # a day without earlier scores is left out
    rows = rows.withColumn("margin", F.coalesce("_own", "_p"))
    lo, hi = scalars.widened("q05", "q50", "q95", F.col("margin"))
    return rows.withColumns({"lo": lo, "hi": hi}).drop("_s", "_own", "_p")


def interval_alerts(ledger: DataFrame, keys: Sequence[str], config: DetectorConfig = DetectorConfig(), score_from: date | None = None) -> DataFrame:
    """Layer 1: values outside their interval after calibration on the days before; days without such scores are skipped."""
    rows = calibrated(ledger, keys, config, score_from)
    above, below = F.col("y_true") - F.col("hi"), F.col("lo") - F.col("y_true")
    rows = rows.withColumn("impact", F.greatest(above, below)).where("impact > 0")
    rows = rows.withColumns({"direction": F.when(above > 0, "above").otherwise("below"), "score": F.col("impact") / F.greatest(F.col("hi") - F.col("lo"), F.lit(WIDTH_FLOOR)), "observed": F.col("y_true"), "expected": F.col("q50"), "scope": scalars.scope(keys)})
    text = F.format_string("%s: %.2f is %s the calibrated interval [%.2f, %.2f] by %.2f", "scope", "observed", "direction", "lo", "hi", "impact")
    return _alerts(rows.withColumn("message", text), "L1_interval", "daily_cost", config)


# Sequences: the rows of a group in order, one after the other through a task, which keeps only what later rows need.


def _runs(first: np.ndarray) -> Iterator[tuple[int, int, bool]]:
    """(begin, end, whether the group begins here) of each group's rows in a batch; first marks a group's first row."""
    cut = np.flatnonzero(first)
    begin = [0, *cut.tolist()] if len(first) and not first[0] else cut.tolist()
    for a, b in zip(begin, [*begin[1:], len(first)]):
        yield a, b, bool(first[a])


def _in_order(rows: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, make: Callable[[], Callable], made: str) -> DataFrame:
    """rows with the columns that a group's walk yields: walk(values, run_dates) -> arrays, called on the group's rows in order, piece by piece.

    The row number is taken over the same partitions and order, so a group's rows stay together.
    """
    numbered = rows.withColumn("i", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    at, day, pos = (numbered.columns.index(c) for c in (col, "run_date", "i"))
    names = [x.split()[0] for x in made.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(at).to_numpy(zero_copy_only=False).astype(np.float64)
            days = batch.column(day).cast(pa.int32()).to_numpy(zero_copy_only=False)
            got = []
            for a, b, new in _runs(batch.column(pos).to_numpy(zero_copy_only=False) == 1):
                walk = make() if new else walk
                got.append(walk(x[a:b], days[a:b]))
            cols = [pa.array(np.concatenate(c), from_pandas=True) if c[0].dtype != object else pa.array([v for part in c for v in part], pa.string()) for c in zip(*got)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
    return numbered.mapInArrow(run, f"{kinds}, {made}")


def _spread(past: np.ndarray) -> np.ndarray:
    """1.4826 times the median absolute deviation of each row, at least the floor."""
    mid = np.median(past, axis=1, keepdims=True)
    return np.maximum(MAD_SCALE * np.median(np.abs(past - mid), axis=1), WIDTH_FLOOR)


# Layer 1.5: drifts.


class Cusum:
    """Two sums of a series' standardised residuals that restart after an alarm: (residuals, days) -> sigma, z, s_pos, s_neg, alarm. Kept between calls: the trailing window and the sums."""

    def __init__(self, config: DetectorConfig = DetectorConfig(), past: Sequence[float] = (), s_pos: float = 0.0, s_neg: float = 0.0):
        self.config, self.past, self.s_pos, self.s_neg = config, np.asarray(past, np.float64), s_pos, s_neg

    def __call__(self, residuals: np.ndarray, days: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        c, n = self.config, len(residuals)
        all_ = np.concatenate((self.past, residuals))
        sigma, old = np.full(n, np.nan), len(self.past)
        # rows with a full window at once, those before one by one
        full = max(c.cusum_sigma_window - old, 0)
        for j in range(max(c.cusum_min_history - old, 0), min(full, n)):
            sigma[j] = _spread(all_[None, : old + j])[0]
        if full < n:
            begin = old + full - c.cusum_sigma_window
            windows = np.lib.stride_tricks.sliding_window_view(all_[begin:-1], c.cusum_sigma_window)
            for k in range(0, len(windows), 4096):
                sigma[full + k : full + k + 4096] = _spread(windows[k : k + 4096])
        z = residuals / sigma
        pos, neg, alarm = np.full(n, np.nan), np.full(n, np.nan), np.full(n, None, object)
        for j in np.flatnonzero(~np.isnan(sigma)):
            self.s_pos, self.s_neg = max(0.0, self.s_pos + z[j] - c.cusum_k), max(0.0, self.s_neg - z[j] - c.cusum_k)
            pos[j], neg[j] = self.s_pos, self.s_neg
            if max(self.s_pos, self.s_neg) > c.cusum_h:
                alarm[j] = "above" if self.s_pos >= self.s_neg else "below"
                self.s_pos = self.s_neg = 0.0
        self.past = all_[-c.cusum_sigma_window :]
        return sigma, z, pos, neg, alarm


def cusum(ledger: DataFrame, keys: Sequence[str], config: DetectorConfig = DetectorConfig()) -> DataFrame:
    """keys, run_date, y_true, q50, residual, i, sigma, z, s_pos, s_neg, alarm (above, below or null): residuals against the median forecast in the robust scale of those before; null with too few before."""
    rows = ledger.dropna(subset=[*keys, "y_true", "q50"]).select(*keys, "run_date", F.col("y_true").cast("double").alias("y_true"), F.col("q50").cast("double").alias("q50"))
    rows = rows.withColumn("residual", F.col("y_true") - F.col("q50"))
    return _in_order(rows, keys, ["run_date", "residual"], "residual", lambda: Cusum(config), "sigma double, z double, s_pos double, s_neg double, alarm string")


def cusum_alerts(ledger: DataFrame, keys: Sequence[str], config: DetectorConfig = DetectorConfig()) -> DataFrame:
    """Layer 1.5: drifts that no single day shows."""
    rows = cusum(ledger, keys, config).where("alarm IS NOT NULL")
    stat = F.greatest("s_pos", "s_neg")
    rows = rows.withColumns({"stat": stat, "direction": F.col("alarm"), "observed": F.col("residual"), "expected": F.lit(0.0), "impact": F.abs("residual"), "scope": scalars.scope(keys)})
    text = F.format_string("%s: the sum of deviations %s the forecast reached %.2f (limit %.2f), sigma %.2f", "scope", "direction", "stat", F.lit(config.cusum_h), "sigma")
    rows = rows.withColumn("score", (F.col("stat") - config.cusum_h) / config.cusum_h).withColumn("message", text)
    return _alerts(rows, "L1.5_cusum", "residual_drift", config)


# Layer 2: jobs.


class Profile:
    """The median and robust spread of all a job's days before each one: (costs, days) -> median, sigma; null for days that are not scored or have too few before. Kept between calls: the job's costs."""

    def __init__(self, config: DetectorConfig = DetectorConfig(), since: int | None = None):
        self.config, self.since, self.past = config, since, np.empty(0)

    def __call__(self, costs: np.ndarray, days: np.ndarray) -> tuple[np.ndarray, ...]:
        all_, old = np.concatenate((self.past, costs)), len(self.past)
        mid, sigma = np.full(len(costs), np.nan), np.full(len(costs), np.nan)
        wanted = np.arange(len(costs)) + old >= self.config.min_job_history
        if self.since is not None:
            wanted &= days >= self.since
        for j in np.flatnonzero(wanted):
            past = all_[: old + j]
            mid[j] = np.median(past)
            sigma[j] = max(MAD_SCALE * np.median(np.abs(past - mid[j])), WIDTH_FLOOR)
        self.past = all_
        return mid, sigma


def job_profiles(job_cost: DataFrame, config: DetectorConfig = DetectorConfig(), score_from: date | None = None) -> DataFrame:
    """JOB_PROFILE_KEYS, run_date, cost, i, median, sigma: each job's day against all its days before, from score_from on."""
    daily = job_cost.dropna(subset=["run_date", *JOB_PROFILE_KEYS]).groupBy("run_date", *JOB_PROFILE_KEYS).agg(F.coalesce(F.sum("cost").cast("double"), F.lit(0.0)).alias("cost"))
    since = (score_from - date(1970, 1, 1)).days if score_from else None
    out = _in_order(daily, JOB_PROFILE_KEYS, ["run_date"], "cost", lambda: Profile(config, since), "median double, sigma double")
    return out.where(F.col("run_date") >= F.lit(score_from)) if score_from else out


def job_alerts(job_cost: DataFrame, config: DetectorConfig = DetectorConfig(), score_from: date | None = None) -> DataFrame:
    """Layer 2: jobs far from their own history, and first appearances."""
    dev = F.col("cost") - F.col("median")
    z = dev / F.col("sigma")
    far = F.col("median").isNotNull() & (F.abs(dev) >= config.job_abs_floor) & (F.abs(z) > config.z_threshold)
    first = F.col("i") == 1
    rows = job_profiles(job_cost, config, score_from).where(first | far)
    pick = lambda new, old: F.when(first, new).otherwise(old)
    rows = rows.withColumns({"scope": scalars.scope(JOB_PROFILE_KEYS), "score": pick(F.lit(0.0), F.abs(z) / config.z_threshold - 1), "impact": pick(F.col("cost"), F.abs(dev)), "direction": pick(F.lit("new"), F.when(dev > 0, "above").otherwise("below")), "observed": F.col("cost"), "expected": pick(F.lit(None).cast("double"), F.col("median"))})
    rows = rows.withColumns({
        "severity": pick(F.lit("low"), scalars.severity(F.col("score"), F.col("impact"), config)),
        "message": pick(F.format_string("%s: first seen, cost %.2f", "scope", "cost"), F.format_string("%s: cost %.2f against a usual %.2f, %.1f spreads off", "scope", "cost", "median", z)),
    })
    out = _alerts(rows, "L2_job", "job_daily_cost", config)
    return out.withColumn("metric", F.when(F.col("direction") == "new", "new_job").otherwise(F.col("metric")))


# Attribution.


def attribution_alerts(team_frame: DataFrame, config: DetectorConfig = DetectorConfig()) -> DataFrame:
    """Days whose share of unknown teams is over the limit."""
    days = team_frame.groupBy("run_date").agg(F.max("unknown_pct").alias("unknown_pct")).where(F.col("unknown_pct") > config.unknown_pct_threshold)
    rows = days.withColumns({"score": F.col("unknown_pct") / config.unknown_pct_threshold - 1, "direction": F.lit("above"), "scope": F.lit("estate"), "observed": F.col("unknown_pct"), "expected": F.lit(config.unknown_pct_threshold), "message": F.format_string("%.1f%% of the day's cost has no known team", F.col("unknown_pct") * 100)})
    return _alerts(rows, "attribution", "unknown_pct", config)


# All layers.


def triaged(alerts: DataFrame) -> DataFrame:
    """Most severe first, then by impact (unknown last), then the newest."""
    rank = F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)
    return alerts.orderBy(rank, F.coalesce("impact", F.lit(-1.0)).desc(), F.col("run_date").desc(), "alert_id")


def relabelled(alerts: DataFrame, label: str) -> DataFrame:
    """Alerts of a named frame: the scope says which, the id follows."""
    out = alerts.withColumn("scope", F.concat(F.lit(f"{label}:"), "scope"))
    return out.withColumn("alert_id", scalars.alert_id(F.col("layer"), F.col("scope"), F.col("run_date"), F.col("direction"))).select(*ALERT_COLUMNS)


def run_detector(ledgers: dict[str, tuple[DataFrame, Sequence[str]]], job_cost: DataFrame | None = None, frame_2: DataFrame | None = None, config: DetectorConfig = DetectorConfig(), previous_alerts: DataFrame | None = None, score_from: date | None = None) -> DataFrame:
    """All layers' alerts from score_from on; sequential layers see the full history before."""
    parts = []
    for label, (ledger, keys) in ledgers.items():
        parts.append(relabelled(interval_alerts(ledger, keys, config, score_from), label))
        parts.append(relabelled(cusum_alerts(ledger, keys, config), label))
    if job_cost is not None:
        parts.append(job_alerts(job_cost, config, score_from))
    if frame_2 is not None:
        parts.append(attribution_alerts(frame_2, config))
    if not parts:
        raise ValueError("the detector needs a ledger, job costs or a team frame")
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    out = out.where(F.col("run_date") >= F.lit(score_from)) if score_from else out
    return triaged(carry_status(out, previous_alerts) if previous_alerts is not None else out)


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("layer", "severity").agg(F.count("*").alias("n"))
