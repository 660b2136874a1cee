"""Baseline forecasters and the walk-forward back-test, all origins in one set-based plan.

A forecaster reads (origin, group keys, day, y) history strictly before each origin and predicts its month's rows. Point
forecasts get bands from quantiles of its residuals, the group's if it has enough, else those of all groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import FrameSpec
from ..errors import BacktestError
from . import ranks

MIN_RESIDUALS = 20
TREND_DAYS, MEDIAN_ROWS, MEDIAN_MIN = 90, 28, 7
MODELS = ("seasonal_naive", "three_month_trend", "rolling_median")


#: The regimes a back-test reads unless told otherwise.
DEFAULT_REGIMES = ("featured_gated",)


def prepare(frame: DataFrame, regimes: Sequence[str] = DEFAULT_REGIMES, mask: Column | None = None) -> DataFrame:
    """The honest evaluation slice; an empty one raises."""
    out = frame.where(F.col("data_regime").isin(*regimes)) if regimes and "data_regime" in frame.columns else frame
    out = out.where(mask) if mask is not None else out
    if not out.limit(1).count():
        raise BacktestError("no rows are left to evaluate")
    return out


def monthly_origins(frame: DataFrame, min_train_days: int = 180, day: str = "run_date") -> list[date]:
    """First days of months at least min_train_days after the first day, whose month is complete."""
    lo, hi = frame.agg(F.min(day), F.max(day)).first()
    return origins_between(lo, hi, min_train_days) if lo else []


def origins_between(lo: date, hi: date, min_train_days: int) -> list[date]:
    first = lo + timedelta(days=min_train_days)
    cur = first if first.day == 1 else _next_month(first)
    out = []
    while _next_month(cur) <= hi + timedelta(days=1):
        out.append(cur)
        cur = _next_month(cur)
    return out


def _next_month(d: date) -> date:
    return date(d.year + d.month // 12, d.month % 12 + 1, 1)


def _months(origins: Sequence[date]):
    return F.explode(F.array(*(F.struct(F.lit(o).alias("origin"), F.lit(_next_month(o)).alias("until")) for o in origins)))


def folds(frame: DataFrame, spec: FrameSpec, origins: Sequence[date]) -> tuple[DataFrame, DataFrame]:
    """(train, test): each row under every origin it serves, as origin, group keys, day, y. Origins are few and literal.

    Training rows carry what the row shows against the rows before it, naive_r and median_r: it is the same under every
    origin, so it is made once, before rows are copied.
    """
    if not origins:
        raise BacktestError("there is no honest origin")
    base = frame.select(*spec.group_keys, F.col(spec.date_col).alias("day"), F.col(spec.target).cast("double").alias("y"))
    order = W.partitionBy(*spec.group_keys).orderBy("day")
    before = order.rowsBetween(-MEDIAN_ROWS, -1)
    past = F.when(F.count("y").over(before) >= MEDIAN_MIN, F.percentile("y", F.lit(0.5)).over(before))
    own = base.where(F.col("day") < F.lit(max(origins))).withColumns({"naive_r": F.col("y") - F.lag("y", 7).over(order), "median_r": F.col("y") - past})
    cols = [F.col("o.origin").alias("origin"), *spec.group_keys, "day", "y"]
    train = own.withColumn("o", _months(origins)).where("day < o.origin").select(*cols, "naive_r", "median_r")
    return train, base.withColumn("o", _months(origins)).where("day >= o.origin AND day < o.until").select(*cols)


def _bands(residuals: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Quantiles of `r` by origin and group, where there are enough, and by origin."""
    q = [F.percentile("r", F.lit(p)).alias(n) for p, n in ((0.05, "lo"), (0.95, "hi"))]
    own = residuals.where("r IS NOT NULL")
    by = own.dropna(subset=list(keys)).groupBy("origin", *keys).agg(*q, F.count("*").alias("n")).where(F.col("n") >= MIN_RESIDUALS).drop("n")
    return by, ranks.quantiles(own, ["origin"], "r", {"p_lo": 0.05, "p_hi": 0.95})


def _with_bands(points: DataFrame, residuals: DataFrame, keys: Sequence[str], model: str) -> DataFrame:
    by, pooled = _bands(residuals, keys)
    out = points.join(by, ["origin", *keys], "left").join(pooled, "origin", "left")
    zero = F.lit(0.0)
    lo, hi = F.coalesce("lo", "p_lo", zero), F.coalesce("hi", "p_hi", zero)
    known = F.col("point").isNotNull()
    q = {n: F.when(known, F.greatest(x, zero)) for n, x in (("q05", F.col("point") + lo), ("q50", F.col("point")), ("q95", F.col("point") + hi))}
    return out.select(F.col("day").alias("run_date"), *keys, F.lit(model).alias("model"), "origin", F.col("y").alias("y_true"), *(x.alias(n) for n, x in q.items()))


def seasonal_naive(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The group's last known value of the same weekday; residuals against the row seven before."""
    t = train.withColumn("dow", F.weekday("day"))
    last = t.where("y IS NOT NULL").groupBy("origin", *keys, "dow").agg(F.max_by("y", "day").alias("point"))
    res = train.select("origin", *keys, F.col("naive_r").alias("r"))
    points = test.withColumn("dow", F.weekday("day")).join(last, ["origin", *keys, "dow"], "left")
    return _with_bands(points, res, keys, "seasonal_naive")


def three_month_trend(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A line through each group's rows of the last 90 days of all training data; one row is a level."""
    ends = train.groupBy("origin").agg(F.max("day").alias("end"))
    near = train.where("y IS NOT NULL").join(ends, "origin").where(F.col("day") > F.date_sub("end", TREND_DAYS)).withColumn("x", F.datediff("day", "origin").cast("double"))
    many = F.countDistinct("x") > 1
    fit = near.groupBy("origin", *keys).agg(F.when(many, F.regr_slope("y", "x")).otherwise(F.lit(0.0)).alias("slope"), F.when(many, F.regr_intercept("y", "x")).otherwise(F.avg("y")).alias("level"))
    res = near.join(fit, ["origin", *keys]).select("origin", *keys, (F.col("y") - (F.col("level") + F.col("slope") * F.col("x"))).alias("r"))
    at = F.col("level") + F.col("slope") * F.datediff("day", "origin")
    points = test.join(fit, ["origin", *keys], "left").withColumn("point", F.when(at.isNotNull(), F.greatest(at, F.lit(0.0))))
    return _with_bands(points, res, keys, "three_month_trend")


def rolling_median(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The median of the group's last 28 rows; residuals against the trailing median of at least 7."""
    recent = W.partitionBy("origin", *keys).orderBy(F.col("day").desc())
    mid = train.withColumn("k", F.row_number().over(recent)).where(F.col("k") <= MEDIAN_ROWS).groupBy("origin", *keys).agg(F.percentile("y", F.lit(0.5)).alias("point"))
    res = train.select("origin", *keys, F.col("median_r").alias("r"))
    return _with_bands(test.join(mid, ["origin", *keys], "left"), res, keys, "rolling_median")


FORECASTERS = {"seasonal_naive": seasonal_naive, "three_month_trend": three_month_trend, "rolling_median": rolling_median}


def walk_forward(frame: DataFrame, spec: FrameSpec, origins: Sequence[date], models: Sequence[str] = MODELS) -> DataFrame:
    """The ledger run_date, group keys, model, origin, y_true, q05, q50, q95 of every model on the same folds."""
    train, test = folds(frame, spec, origins)
    out = None
    for m in models:
        one = FORECASTERS[m](train, test, spec.group_keys)
        out = one if out is None else out.unionByName(one)
    return out
