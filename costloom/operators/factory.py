"""Series features: date spines, lags, windows that end the day before, price drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import GATE_KEYS

STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum, "median": lambda c: F.percentile(c, F.lit(0.5))}


def spine(frame: DataFrame, keys: Sequence[str], day: str = "run_date", shared: bool = False) -> DataFrame:
    """keys and every day from each group's first to its last, or, if shared, from the frame's."""
    if shared:
        ends = frame.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
        groups = frame.select(*keys).distinct().join(F.broadcast(ends))  # one row
    else:
        groups = frame.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    return groups.where("_lo IS NOT NULL").select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(day))


def pad_daily(frame: DataFrame, keys: Sequence[str], zero_cols: Sequence[str], gate: DataFrame | None = None, day: str = "run_date", shared: bool = False) -> DataFrame:
    """frame with a row for every day of the spine and `padded`.

    Padded rows have 0 in zero_cols and null elsewhere; with a gate they stay only on days it calls complete. Observed
    rows always stay.
    """
    from .checks import null_safe

    on = [*keys, day]
    out = null_safe(spine(frame, keys, day, shared), frame.withColumn("_seen", F.lit(True)), on, "left").withColumn("padded", F.col("_seen").isNull()).drop("_seen")
    out = out.withColumns({c: F.when(F.col("padded"), F.lit(0).cast(frame.schema[c].dataType)).otherwise(F.col(c)) for c in zero_cols})
    if gate is not None:
        g = gate.select(*GATE_KEYS, F.col("gate_complete").alias("_gate"))
        out = out.join(g, GATE_KEYS, "left").where("NOT padded OR coalesce(_gate, false)").drop("_gate")
    return out.select(*frame.columns, "padded")


def series(keys: Sequence[str], day: str = "run_date"):
    return W.partitionBy(*keys).orderBy(day)


def lagged(cols: Sequence[str], lags: Sequence[int], keys: Sequence[str], day: str = "run_date"):
    return {f"{c}_lag{k}": F.lag(c, k).over(series(keys, day)) for c in cols for k in lags}


def rolled(cols: Sequence[str], windows: Sequence[int], keys: Sequence[str], day: str = "run_date", stats: Sequence[str] = ("mean",), min_periods: int | None = None):
    """<c>_roll<w> (mean) and <c>_roll<w>_<stat>: over the w rows before, null with fewer than min_periods (w) values."""
    out = {}
    for c in cols:
        for n in windows:
            w = series(keys, day).rowsBetween(-n, -1)
            for s in stats:
                out[f"{c}_roll{n}" + ("" if s == "mean" else f"_{s}")] = F.when(F.count(c).over(w) >= (min_periods or n), STATS[s](c).over(w))
    return out


def add_lags(frame: DataFrame, keys: Sequence[str], cols: Sequence[str], lags: Sequence[int], day: str = "run_date") -> DataFrame:
    return frame.withColumns(lagged(cols, lags, keys, day))


def add_rolling(frame: DataFrame, keys: Sequence[str], cols: Sequence[str], windows: Sequence[int], day: str = "run_date", stats: Sequence[str] = ("mean",), min_periods: int | None = None) -> DataFrame:
    return frame.withColumns(rolled(cols, windows, keys, day, stats, min_periods))


def unit_prices(lines: DataFrame, by: Sequence[str], usage: str = "usage_quantity", cost: str = "pre_tax_cost") -> DataFrame:
    """by, unit_price: cost over usage of lines that have both; a group without such lines has no row."""
    ok = lines.where((F.col(usage) > 0) & (F.col(cost) > 0))
    return ok.groupBy(*by).agg(F.try_divide(F.sum(cost).cast("double"), F.sum(usage).cast("double")).alias("unit_price"))


def price_drift(lines: DataFrame, keys: Sequence[str], meter: str = "meter", recent: int = 14, prior: int = 28, day: str = "run_date", usage: str = "usage_quantity", cost: str = "pre_tax_cost") -> DataFrame:
    """keys, day, price_drift: ln of the recent over the prior mean unit price, of meters weighted by trailing cost.

    Windows are calendar days: recent ends today, prior ends before it, the weight is the cost of the last `prior` days.
    Half of either window's days must be priced. A meter counts on every day between its first and last priced one.
    """
    full = [*keys, meter]
    ok = lines.dropna(subset=[*full, day]).where((F.col(usage) > 0) & (F.col(cost) > 0))
    daily = ok.groupBy(*full, day).agg(F.sum(cost).cast("double").alias("c"), F.sum(usage).cast("double").alias("u")).withColumn("p", F.col("c") / F.col("u"))
    every = spine(daily, full, day).join(daily, [*full, day], "left").withColumn("n", F.unix_date(day))
    s = W.partitionBy(*full).orderBy("n")
    now, then, weight = s.rangeBetween(-(recent - 1), 0), s.rangeBetween(-(recent + prior - 1), -recent), s.rangeBetween(-(prior - 1), 0)
    enough = (F.count("p").over(now) >= max(2, recent // 2)) & (F.count("p").over(then) >= max(2, prior // 2))
    drift = F.when(enough, F.ln(F.avg("p").over(now) / F.avg("p").over(then)))
    per = every.select(*keys, day, drift.alias("d"), F.coalesce(F.sum("c").over(weight), F.lit(0.0)).alias("w")).where("d IS NOT NULL")
    return per.groupBy(*keys, day).agg(F.when(F.sum("w") > 0, F.sum(F.col("d") * F.col("w")) / F.sum("w")).alias("price_drift"))
