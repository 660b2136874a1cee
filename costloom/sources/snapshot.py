"""Reading and writing: database extracts, Parquet snapshots, manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import coerced, month_starts, window_start
from ..operators.gate import filter_tiers

_S, _D, _L, _TS, _DT = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType(), T.DateType()


def _schema(**cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols.items()])


_KEYS = {"run_date": _DT, "subscription_id": _S, "batch_account_name": _S, "pool_name": _S}
SCHEMAS = {
    "raw_cost": _schema(**_KEYS, resource_group_name=_S, resource_type=_S, service_name=_S, meter_category=_S, meter=_S, meter_sub_category=_S, low_priority_type=_S, pre_tax_cost=_D, usage_quantity=_D, update_time=_TS),
    "job_usage": _schema(**_KEYS, job_id=_S, start_time=_TS, end_time=_TS, job_seconds=_D, task_count=_L),
    "job_cost": _schema(**_KEYS, job_id=_S, job_name=_S, job_category=_S, job_ownership=_S, job_team=_S, cost=_D),
    "run_status": _schema(run_date=_DT, subscription_id=_S, run_type=_S, status=_S, update_time=_TS),
    "environment_config": _schema(subscription_id=_S, subscription_name=_S, environment_tier=_S, environment_sub_tier=_S),
}
#: Landed whole and read by no builder.
WHOLE = ["run_status", "environment_config", "job_classification", "spot_prices", "dedicated_prices_retail", "spot_eviction_rates", "spot_placement_scores"]
PAGED = ["raw_cost", "job_usage", "job_cost"]
REQUIRED = ["raw_cost", "job_usage", "job_cost", "run_status"]


# Database scans.


def date_range(spark: SparkSession, url: str, table: str, props: Mapping[str, str]) -> tuple[date | None, date | None]:
    q = f"(SELECT min(run_date) AS lo, max(run_date) AS hi FROM {table}) x"
    return tuple(spark.read.jdbc(url, q, properties=dict(props)).first())


def month_predicates(lo: date, hi: date, floor: date | None = None) -> list[str]:
    """One predicate for each month from lo's to hi's, cut at floor: each is a partition that the database filters."""
    starts = month_starts(max(lo, floor) if floor else lo, hi)
    out = []
    for k in starts:
        end = month_starts(k, date(k.year + 1, k.month, 1))[1]
        begin = max(k, floor) if floor else k
        out.append(f"run_date >= DATE '{begin}' AND run_date < DATE '{end}'")
    return out


def read_whole(spark: SparkSession, url: str, table: str, props: Mapping[str, str]) -> DataFrame:
    return coerced(spark.read.jdbc(url, table, properties=dict(props)))


def read_paged(spark: SparkSession, url: str, table: str, props: Mapping[str, str], floor: date | None = None) -> DataFrame:
    """The table read by months in parallel; by the days from floor on, if there is one."""
    lo, hi = date_range(spark, url, table, props)
    if lo is None:
        return read_whole(spark, url, table, props)
    return coerced(spark.read.jdbc(url, table, predicates=month_predicates(lo, hi, floor) or ["1 = 0"], properties=dict(props)))


def extract(spark: SparkSession, url: str, out: str, props: Mapping[str, str], days_back: int | None = None, today: date | None = None, paged: Sequence[str] = PAGED, whole: Sequence[str] = WHOLE) -> dict:
    """Write every table to out/<name>.parquet and a manifest; with days_back, only so many days of the paged ones."""
    floor = window_start(days_back, today or datetime.now(timezone.utc).date()) if days_back else None
    tables = {t: read_paged(spark, url, t, props, floor) for t in paged} | {t: read_whole(spark, url, t, props) for t in whole}
    return write_snapshot(tables, out, {"days_back": days_back})


# Snapshots.


def write_snapshot(tables: Mapping[str, DataFrame], out: str, more: Mapping | None = None) -> dict:
    """One Parquet directory for each table, by month where it has days, so that later scans prune; and _manifest.json."""
    spark = next(iter(tables.values())).sparkSession
    manifest = {"extracted_at": datetime.now(timezone.utc).isoformat(), "tables": {}, **(more or {})}
    for name, df in tables.items():
        path = f"{out}/{name}.parquet"
        if "run_date" in df.columns:
            df.withColumn("run_month", F.date_format("run_date", "yyyy-MM")).write.partitionBy("run_month").parquet(path)
        else:
            df.write.parquet(path)
        back = spark.read.parquet(path)
        manifest["tables"][name] = {"rows": back.count()} | ({"density": {r.month: r.n for r in monthly_density(back).collect()}} if "run_date" in df.columns else {})
    write_json(spark, f"{out}/_manifest.json", manifest)
    return manifest


def load_snapshot(spark: SparkSession, path: str, tables: Sequence[str] = tuple(SCHEMAS), tiers: bool = True) -> dict[str, DataFrame]:
    """The snapshot's tables, lazily, read by name in the types of SCHEMAS where those say one; excluded tiers are filtered here once.

    run_month stays where the files have it: a filter on it (between_days) skips whole months.
    """
    out = {}
    for t in tables:
        if exists(spark, f"{path}/{t}.parquet"):
            df = spark.read.parquet(f"{path}/{t}.parquet")
            want = {f.name: f.dataType for f in SCHEMAS[t]} if t in SCHEMAS else {}
            wrong = {f.name: F.col(f.name).cast(want[f.name]) for f in df.schema if f.name in want and f.dataType != want[f.name]}
            out[t] = df.withColumns(wrong) if wrong else df
    return filter_tiers(out) if tiers else out


def between_days(df: DataFrame, lo: date, hi: date) -> DataFrame:
    """Rows of the days from lo to hi; of a monthly table only these months are read."""
    out = df.where(F.col("run_date").between(F.lit(lo), F.lit(hi)))
    return out.where(F.col("run_month").between(f"{lo:%Y-%m}", f"{hi:%Y-%m}")) if "run_month" in df.columns else out


def monthly_density(df: DataFrame, day: str = "run_date") -> DataFrame:
    """month (yyyy-MM), n."""
    return df.where(F.col(day).isNotNull()).groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def missing_tables(tables: Mapping[str, DataFrame], required: Sequence[str] = REQUIRED) -> list[str]:
    return sorted(set(required) - set(tables))


# Small files, by Hadoop's file system, so that any store works.


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, overwrite)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: object, overwrite: bool = True) -> None:
    write_text(spark, path, json.dumps(value, indent=1, default=str), overwrite)


def read_json(spark: SparkSession, path: str) -> object:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)  # Spark's readers skip names that begin with an underscore
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_frames(frames: Mapping[str, DataFrame], out: str, mode: str = "overwrite") -> None:
    for name, df in frames.items():
        df.write.mode(mode).parquet(f"{out}/{name}.parquet")
