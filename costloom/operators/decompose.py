"""Exact decomposition of a cost change into price, usage, scope and unpriced effects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import DataQualityError

EFFECTS = ["price", "usage", "scope", "unpriced"]


def where_equal(group: Mapping[str, object]) -> Column:
    return reduce(Column.__and__, (F.col(k) == F.lit(v) if v is not None else F.col(k).isNull() for k, v in group.items()), F.lit(True))


def effects(items: DataFrame) -> DataFrame:
    """items (cost_a, usage_a, cost_b, usage_b) with delta, kind and the effects that add up to it.

    Price moves at mean usage and usage at mean price, so there is no remainder. Items of one period are scope; items
    without usage in one of them are unpriced.
    """
    here = {s: (F.col(f"cost_{s}") != 0) | (F.col(f"usage_{s}") != 0) for s in "ab"}
    priced = here["a"] & here["b"] & (F.col("usage_a") > 0) & (F.col("usage_b") > 0)
    delta = F.col("cost_b") - F.col("cost_a")
    pa, pb = F.try_divide("cost_a", "usage_a"), F.try_divide("cost_b", "usage_b")
    kind = F.when(here["b"] & ~here["a"], "entering").when(here["a"] & ~here["b"], "exiting").when(priced, "priced").when(here["a"] & here["b"], "unpriced").otherwise("absent")
    out = items.withColumn("delta", delta).withColumn("kind", kind)
    zero = F.lit(0.0)
    return out.withColumns(
        {
            "price": F.when(F.col("kind") == "priced", (pb - pa) * (F.col("usage_a") + F.col("usage_b")) / 2).otherwise(zero),
            "usage": F.when(F.col("kind") == "priced", (F.col("usage_b") - F.col("usage_a")) * (pa + pb) / 2).otherwise(zero),
            "scope": F.when(F.col("kind").isin("entering", "exiting"), F.col("delta")).otherwise(zero),
            "unpriced": F.when(F.col("kind") == "unpriced", F.col("delta")).otherwise(zero),
        }
    )


def decompose(rows: DataFrame, in_a: Column, in_b: Column, items: Sequence[str] = ("meter",), cost: str = "pre_tax_cost", usage: str = "usage_quantity", scale_a: float = 1.0) -> DataFrame:
    """The items of the two periods that the conditions pick from rows, in one pass; period a is divided by scale_a. Null items are one item."""

    def total(c: str, which: Column, scale: float) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col(c))).cast("double") / scale, F.lit(0.0))

    per = rows.where(in_a | in_b).groupBy(*items).agg(total(cost, in_a, scale_a).alias("cost_a"), total(usage, in_a, scale_a).alias("usage_a"), total(cost, in_b, 1.0).alias("cost_b"), total(usage, in_b, 1.0).alias("usage_b"))
    return effects(per).where("kind <> 'absent'")


def summary(items: DataFrame) -> DataFrame:
    """One row: total_a, total_b, delta and the effects, to the cent."""
    cols = {"total_a": "cost_a", "total_b": "cost_b", "delta": "delta"} | {e: e for e in EFFECTS}
    return items.agg(*(F.coalesce(F.round(F.sum(c).cast("decimal(38,6)"), 2).cast("double"), F.lit(0.0)).alias(n) for n, c in cols.items()))


def assert_identity(items: DataFrame, tolerance: float = 0.01) -> None:
    gap = F.abs(F.col("delta") - sum((F.col(e) for e in EFFECTS), F.lit(0.0)))
    row = items.agg(F.max(gap).alias("worst"), F.abs(F.sum(F.col("delta") - sum((F.col(e) for e in EFFECTS), F.lit(0.0)))).alias("all")).first()
    if (row["worst"] or 0) > tolerance or (row["all"] or 0) > tolerance:
        raise DataQualityError(f"effects miss the change by {row['worst']}")


def _baseline(rows: DataFrame, day: date, days: int) -> tuple[Column, Column, int]:
    in_a = F.col("run_date").between(F.lit(day - timedelta(days=days)), F.lit(day - timedelta(days=1)))
    n = rows.where(in_a).select("run_date").distinct().count()
    if not n:
        raise DataQualityError(f"no baseline day in the {days} days before {day}")
    return in_a, F.col("run_date") == F.lit(day), n


def day_vs_baseline(rows: DataFrame, day: date, group: Mapping[str, object], days: int = 28, items: Sequence[str] = ("meter",)) -> DataFrame:
    """The decomposition of a day against the mean of its observed baseline days."""
    own = rows.where(where_equal(group))
    in_a, in_b, n = _baseline(own, day, days)
    return decompose(own, in_a, in_b, items, scale_a=float(n))


def team_contribution(job_cost: DataFrame, day: date, group: Mapping[str, object], days: int = 28, team: str = "job_team", cost: str = "cost") -> DataFrame:
    """team, day_cost, baseline_cost, delta, share, ratio of each team, null team included.

    share of the whole change is null if that is under a cent; ratio is infinite on a baseline under a cent.
    """
    own = job_cost.where(where_equal(group))
    in_a, in_b, n = _baseline(own, day, days)
    per = own.where(in_a | in_b).groupBy(team).agg(F.coalesce(F.sum(F.when(in_b, F.col(cost))).cast("double"), F.lit(0.0)).alias("day_cost"), (F.coalesce(F.sum(F.when(in_a, F.col(cost))).cast("double"), F.lit(0.0)) / n).alias("baseline_cost"))
    per = per.withColumn("delta", F.col("day_cost") - F.col("baseline_cost"))
    whole = F.sum("delta").over(W.partitionBy())  # a row for each team
    return per.withColumns({"share": F.when(F.abs(whole) > 0.01, F.col("delta") / whole), "ratio": F.when(F.col("baseline_cost") > 0.01, F.col("day_cost") / F.col("baseline_cost")).otherwise(F.lit(float("inf")))})


def top_items(items: DataFrame, n: int, by: str = "delta", tie: str = "meter") -> DataFrame:
    return items.orderBy(F.abs(by).desc(), F.col(tie).asc_nulls_first()).limit(n)


def top_per_group(df: DataFrame, keys: Sequence[str], by: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(F.col(by).desc_nulls_last(), *tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
