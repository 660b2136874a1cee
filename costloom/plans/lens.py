"""The driver's star schema seen as billing tables: one SQL text for each, for Spark and for DuckDB.

Money is decimal(18, 4): sums of it are exact in any order, so two engines agree to the cent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import LENS_ERAS

SOURCES = ["lineitem", "supplier", "nation", "part", "region"]


def _day_number(d: str, dialect: str) -> str:
    return f"unix_date({d})" if dialect == "spark" else f"date_diff('day', DATE '1970-01-01', {d})"


def _kind(a: str, b: str, c: str) -> str:
    return f"CASE WHEN p_type LIKE 'ECONOMY%' THEN '{a}' WHEN p_type LIKE 'STANDARD%' THEN '{b}' ELSE '{c}' END"


def lens_sql(name: str, dialect: str, t=lambda n: n) -> str:
    """The text of one billing table; t names its source tables."""
    keys = """cast(l_shipdate AS date) AS run_date, concat('sub-', n_regionkey) AS subscription_id,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('ba-', n_regionkey) END AS batch_account_name"""
    job_id = "concat(l_orderkey, '-', l_partkey, '-', l_suppkey, '-', l_linenumber, '-', cast(l_quantity AS int)) AS job_id"
    joined = f"FROM {t('lineitem')} JOIN {t('supplier')} ON l_suppkey = s_suppkey JOIN {t('nation')} ON s_nationkey = n_nationkey JOIN {t('part')} ON l_partkey = p_partkey"
    money = "cast(l_extendedprice * (1 - l_discount) AS decimal(18, 4))"
    if name == "raw_cost":
        return f"""SELECT {keys}, CASE WHEN l_returnflag = 'R' THEN NULL ELSE concat('pool-', l_returnflag) END AS pool_name,
      n_name AS resource_group_name, {_kind('microsoft.compute/virtualmachines', 'microsoft.compute/virtualmachinescalesets', 'microsoft.storage/storageaccounts')} AS resource_type,
      {_kind('Virtual Machines', 'Virtual Machines', 'Storage')} AS service_name, {_kind('Virtual Machines', 'Compute', 'Storage')} AS meter_category,
      p_type AS meter, l_linestatus AS meter_sub_category, CASE WHEN l_orderkey % 2 = 0 THEN 'Spot' ELSE 'Dedicated' END AS low_priority_type,
      {money} AS pre_tax_cost, {money} AS cost, l_quantity AS usage_quantity, l_shipdate + l_linenumber * INTERVAL '1' HOUR AS update_time {joined}"""
    if name == "job_usage":
        start = "l_shipdate + (l_partkey % 20) * INTERVAL '1' HOUR"
        return f"""SELECT {keys}, concat('pool-', l_returnflag) AS pool_name, {job_id}, {start} AS start_time,
      CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE {start} + cast(l_quantity * 600 AS int) * INTERVAL '1' SECOND END AS end_time,
      l_quantity * 600 AS job_seconds, cast(l_linenumber AS bigint) AS task_count {joined} WHERE l_returnflag <> 'R'"""
    if name == "job_cost":
        one = f"""SELECT {keys}, concat('pool-', l_returnflag) AS pool_name, {job_id}, p_brand AS job_name, split_part(p_type, ' ', 1) AS job_category,
      'shared' AS job_ownership, CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 7 = 0 THEN 'Unknown' ELSE concat('team-', l_suppkey % 4) END AS job_team,
      {money} AS cost, l_orderkey AS k {joined} WHERE l_returnflag <> 'R' AND l_orderkey % 10 <> 0"""
        cols = "run_date, subscription_id, batch_account_name, pool_name, job_id, job_name, job_category, job_ownership, job_team, cost"
        return f"SELECT {cols} FROM ({one}) a UNION ALL SELECT {cols} FROM ({one}) b WHERE k % 97 = 1"
    if name == "run_status":
        e = _day_number("d", dialect)
        days = f"SELECT DISTINCT cast(l_shipdate AS date) AS d, n_regionkey AS r FROM {t('lineitem')} JOIN {t('supplier')} ON l_suppkey = s_suppkey JOIN {t('nation')} ON s_nationkey = n_nationkey WHERE l_shipdate >= DATE '{LENS_ERAS.gated}'"  # loads are logged from the gate's era on
        row = lambda kind, status, hour, where: f"SELECT d AS run_date, concat('sub-', r) AS subscription_id, '{kind}' AS run_type, {status} AS status, cast(d AS timestamp) + INTERVAL '{hour}' HOUR AS update_time FROM days WHERE {where}"
        return f"""WITH days AS ({days})
      {row('Cost', "'Complete'", 10, 'true')} UNION ALL {row('Cost', "'Error'", 8, f'({e} + r) % 5 = 0')}
      UNION ALL {row('Usage', "'Complete'", 9, f'({e} + r) % 17 <> 0')}
      UNION ALL {row('Attribution', f"CASE WHEN ({e} * 7 + r) % 13 = 0 THEN 'Error' ELSE 'Complete' END", 11, 'true')}"""
    if name == "environment_config":
        return f"""SELECT concat('sub-', r_regionkey) AS subscription_id, concat(CASE WHEN r_regionkey % 2 = 0 THEN 'est-neu-' ELSE 'est-weu-' END, r_regionkey) AS subscription_name,
      CASE r_name WHEN 'AFRICA' THEN 'DEV' WHEN 'ASIA' THEN 'TEST' WHEN 'EUROPE' THEN NULL WHEN 'AMERICA' THEN 'PROD' ELSE ' preprod ' END AS environment_tier,
      'core' AS environment_sub_tier FROM {t('region')}"""
    raise KeyError(name)


TABLES = ["raw_cost", "job_usage", "job_cost", "run_status", "environment_config"]


def lens(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    src = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in SOURCES}
    return {n: spark.sql(lens_sql(n, "spark", lambda x: "{" + x + "}"), **{k: v for k, v in src.items() if "{" + k + "}" in lens_sql(n, "spark", lambda x: "{" + x + "}")}) for n in names}


def oracle(names: list[str], rest: str) -> str:
    """DuckDB SQL: the named billing tables as CTEs, then rest (`WITH` CTEs of its own start with a comma)."""
    ctes = ", ".join(f"{n} AS ({lens_sql(n, 'duckdb')})" for n in names)
    return f"WITH {ctes} {rest}"
