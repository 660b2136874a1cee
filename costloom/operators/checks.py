"""Integrity checks. Each is one aggregate; all raise DataQualityError with what was found."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RAW_GRAIN
from ..errors import DataQualityError


def present(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys that the table has."""
    return [k for k in keys if k in df.columns]


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A join on keys in which nulls equal nulls; the keys come once, from whichever side has the row."""
    l, r = left.alias("l"), right.alias("r")
    on = reduce(Column.__and__, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys))
    key = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) if how in ("full", "right") else F.col(f"l.{k}").alias(k) for k in keys]
    rest = [F.col(f"l.{c}") for c in left.columns if c not in keys]
    if how not in ("left_semi", "left_anti"):
        rest += [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return l.join(r, on, how).select(*key, *rest)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and n: groups of more than one row; nulls are equal."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_rate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, duplicate_rows (all rows of repeated keys), rate."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    out = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"))
    return out.withColumn("rate", F.coalesce(F.try_divide(F.col("duplicate_rows").cast("double"), F.col("rows").cast("double")), F.lit(0.0)))


def assert_unique(df: DataFrame, keys: Sequence[str], context: str) -> None:
    found = duplicate_groups(df, keys).limit(3).collect()
    if found:
        raise DataQualityError(f"{context}: rows repeat on {list(keys)}, for example {[r.asDict() for r in found]}")


def assert_same_rows(before: int, after: int, context: str) -> None:
    if before != after:
        raise DataQualityError(f"{context}: the join turned {before} rows into {after}")


def assert_gated(df: DataFrame, context: str) -> None:
    """No row of a failed gate is left; a frame without gate_state was never gated."""
    if "gate_state" not in df.columns:
        raise DataQualityError(f"{context}: gate_state is missing, so the gate was not applied")
    if df.where("gate_state = 'gated_failed'").limit(1).count():
        raise DataQualityError(f"{context}: rows of a failed gate are left")


def assert_no_unlagged(features: Sequence[str], target: str, context: str) -> None:
    if target in features:
        raise DataQualityError(f"{context}: {target} itself is among the features")
    bare = [f for f in features if any(f == g.split("_lag")[0].split("_roll")[0] for g in features if "_lag" in g or "_roll" in g)]
    if bare:
        raise DataQualityError(f"{context}: features stand beside their own lags: {bare}")


def partition_gap(whole: DataFrame, parts: Sequence[DataFrame], col: str) -> tuple[float, float]:
    """The whole's total, and how far the parts' totals are from it."""
    total = lambda d: float(d.agg(F.sum(col)).first()[0] or 0)
    t = total(whole)
    return t, abs(t - sum(map(total, parts)))


def assert_partition(whole: DataFrame, parts: Sequence[DataFrame], col: str, context: str) -> None:
    t, gap = partition_gap(whole, parts, col)
    if gap > max(0.05, 1e-6 * abs(t)):
        raise DataQualityError(f"{context}: the parts of {col} miss the total {t:.2f} by {gap:.2f}")


def write_violations(raw: DataFrame, keys: Sequence[str] | None = None, stamp: str = "update_time") -> DataFrame:
    """keys and writes: row grains that were written at more than one time."""
    keys = present(raw, keys or RAW_GRAIN)
    return raw.groupBy(*keys).agg(F.countDistinct(stamp).alias("writes")).where("writes > 1")


def assert_one_write(raw: DataFrame, context: str, keys: Sequence[str] | None = None, stamp: str = "update_time") -> None:
    if stamp not in raw.columns:
        raise DataQualityError(f"{context}: {stamp} is missing")
    n = write_violations(raw, keys, stamp).count()
    if n:
        raise DataQualityError(f"{context}: {n} row grains were written more than once")


def assert_additive(parts: DataFrame, whole: DataFrame, key: str, col: str, context: str, tolerance: float = 0.01) -> None:
    """By key, the parts add up to the whole."""
    a = parts.groupBy(key).agg(F.sum(col).cast("double").alias("a"))
    b = whole.groupBy(key).agg(F.sum(col).cast("double").alias("b"))
    if null_safe(a, b, [key], "full").where(f"abs(coalesce(a, 0) - coalesce(b, 0)) > {tolerance}").limit(1).count():
        raise DataQualityError(f"{context}: {col} does not add up by {key}")


def assert_schema(df: DataFrame, expected: dict[str, str], context: str) -> None:
    have = dict(df.dtypes)
    wrong = {c: (t, have.get(c)) for c, t in expected.items() if have.get(c) != t}
    if wrong:
        raise DataQualityError(f"{context}: columns differ (expected, found): {wrong}")


def assert_no_new_nulls(df: DataFrame, cols: Sequence[str], context: str) -> None:
    """Whole-number and boolean features have no nulls."""
    if not cols:
        return
    row = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols)).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise DataQualityError(f"{context}: unexpected nulls {bad}")


def stage_counts(stages: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """stage, rows, keys: rows and distinct keys of each stage, to see where a join fans out."""
    out = None
    for name, (df, keys) in stages.items():
        one = df.groupBy(*present(df, keys)).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("keys"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).select(F.lit(name).alias("stage"), "rows", "keys", "most")
        out = one if out is None else out.unionByName(one)
    return out
