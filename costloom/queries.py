"""The registered queries on the driver's tables seen through the lens, and the same in DuckDB SQL.

Reals leave both engines through DECIMAL(38, 6), which hides differences of a last binary digit; see plans.lens.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import LENS_ERAS, POOL_KEYS, DetectorConfig, FrameSpec
from .functions import scalars
from .operators import baselines, calibrate, checks, decompose, detector, factory, features, gate, joins, metrics
from .plans import frames, pipeline, sqlpack
from .plans.lens import lens, oracle
from .sources import ledger as ledgers
from .sources import snapshot

ERAS = LENS_ERAS
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
SPEC = FrameSpec(["subscription_id"])
#: Fixed origins keep the folds of both engines literal.
ORIGINS = [date(1998, 3, 1), date(1998, 9, 1), date(1999, 3, 1)]
LEVELS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(38,6)").cast("double")


def d6(x: str) -> str:
    return f"cast(cast({x} AS decimal(38, 6)) AS double)"


def rounded(df: DataFrame) -> DataFrame:
    """All reals through r6, all whole numbers as bigint."""
    kinds = dict(df.dtypes)
    return df.select(*(r6(c).alias(c) if kinds[c] in ("double", "float") or kinds[c].startswith("decimal") else F.col(c).cast("bigint").alias(c) if kinds[c] in ("int", "smallint", "tinyint") else F.col(c) for c in df.columns))


def query(name: str, tables: list[str] | None = None, sql: str | None = None):
    """Register f(tables) under name; sql follows the billing tables' CTEs."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lens(spark, sf_dir, tables)) if tables is not None else f(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = oracle(tables, sql) if tables is not None else sql
        return f

    return put


POOL = ", ".join(POOL_KEYS)
BATCH = "coalesce(batch_account_name, '__NULL_BATCH__')"
SLICE = f"(SELECT * REPLACE ({BATCH} AS batch_account_name) FROM raw_cost WHERE pool_name IS NOT NULL)"
GATE = """, runs AS (SELECT * FROM run_status QUALIFY row_number() OVER (PARTITION BY run_date, subscription_id, run_type ORDER BY update_time DESC, status DESC) = 1),
gate AS (SELECT run_date, subscription_id, count(*) FILTER (WHERE status = 'Complete') = 3 AS gate_complete FROM runs GROUP BY 1, 2)"""
STATE = f"CASE WHEN gate_complete THEN 'gated_complete' WHEN gate_complete IS NULL AND run_date < DATE '{ERAS.gated}' THEN 'ungated' ELSE 'gated_failed' END"
REGIME = f"CASE WHEN run_date < DATE '{ERAS.cost}' THEN 'pre_coverage' WHEN run_date < DATE '{ERAS.featured}' THEN 'cost_only' WHEN run_date < DATE '{ERAS.gated}' THEN 'featured_ungated' ELSE 'featured_gated' END"
POOL_COST = f"SELECT {POOL}, sum(pre_tax_cost) AS cost FROM {SLICE} GROUP BY {POOL}"
DAILY = ", daily AS (SELECT run_date, subscription_id, sum(pre_tax_cost) AS cost FROM raw_cost GROUP BY 1, 2)"


def daily(t: dict[str, DataFrame]) -> DataFrame:
    return t["raw_cost"].groupBy("run_date", "subscription_id").agg(F.sum("pre_tax_cost").alias("cost"))


# Projections and filters.


@query("agg1_daily_pool_cost", ["raw_cost"], f"SELECT {POOL}, {d6('cost')} AS cost FROM ({POOL_COST})")
def _(t):
    return rounded(frames.daily_pool_cost(t["raw_cost"]))


@query("prj1_regime", ["raw_cost"], f"SELECT {REGIME} AS data_regime, count(*) AS n, min(run_date) AS lo, max(run_date) AS hi FROM raw_cost GROUP BY 1")
def _(t):
    return gate.stamp_regime(t["raw_cost"], ERAS).groupBy("data_regime").agg(F.count("*").alias("n"), F.min("run_date").alias("lo"), F.max("run_date").alias("hi"))


@query("flt3_drop_pre_coverage", ["raw_cost"], f"SELECT subscription_id, count(*) AS n FROM raw_cost WHERE {REGIME} <> 'pre_coverage' GROUP BY 1")
def _(t):
    return gate.drop_pre_coverage(gate.stamp_regime(t["raw_cost"], ERAS)).groupBy("subscription_id").agg(F.count("*").alias("n"))


@query("prj4_region", ["environment_config"], "SELECT subscription_id, CASE WHEN subscription_name LIKE '%weu%' THEN 'westeurope' WHEN subscription_name LIKE '%neu%' THEN 'northeurope' ELSE 'unknown' END AS region FROM environment_config")
def _(t):
    return t["environment_config"].select("subscription_id", scalars.region("subscription_name").alias("region"))


SEGMENT = "CASE WHEN lower(resource_type) LIKE 'microsoft.compute/virtualmachines%' OR meter_category IN ('Virtual Machines', 'Virtual Machines Licences') OR service_name = 'Virtual Machines' THEN 'vm_compute' ELSE 'platform' END"


@query("prj5_segment_cost", ["raw_cost"], f"SELECT run_date, subscription_id, {SEGMENT} AS segment, {d6('sum(pre_tax_cost)')} AS cost, count(*) AS line_count FROM raw_cost WHERE pool_name IS NULL GROUP BY 1, 2, 3")
def _(t):
    return rounded(gate.non_pool(t["raw_cost"]).withColumn("segment", scalars.segment()).groupBy("run_date", "subscription_id", "segment").agg(F.sum("pre_tax_cost").alias("cost"), F.count("*").alias("line_count")))


@query("prj6_calendar", ["raw_cost"], """SELECT run_date, isodow(run_date) - 1 AS dow, day(run_date) AS day_of_month, month(run_date) AS month, date_diff('day', run_date, last_day(run_date)) AS d_to_month_end,
  date_diff('day', run_date, last_day(cast(date_trunc('quarter', run_date) + INTERVAL 2 MONTH AS date))) AS d_to_quarter_end, isodow(run_date) >= 6 AS is_weekend FROM (SELECT DISTINCT run_date FROM raw_cost)""")
def _(t):
    return rounded(scalars.add_calendar(t["raw_cost"].select("run_date").distinct()))


@query("flt1_tier_filter", ["raw_cost", "environment_config"], f"SELECT subscription_id, count(*) AS n, {d6('sum(pre_tax_cost)')} AS cost FROM raw_cost WHERE NOT EXISTS (SELECT 1 FROM environment_config e WHERE e.subscription_id = raw_cost.subscription_id AND upper(trim(environment_tier)) IN ('DEV', 'TEST')) GROUP BY 1")
def _(t):
    return rounded(gate.filter_tiers(t)["raw_cost"].groupBy("subscription_id").agg(F.count("*").alias("n"), F.sum("pre_tax_cost").alias("cost")))


@query("flt2_priceable", ["raw_cost"], "SELECT count(*) FILTER (WHERE usage_quantity > 0 AND pre_tax_cost > 0) AS priceable, count(*) AS n FROM raw_cost")
def _(t):
    return t["raw_cost"].agg(F.count_if(gate.priceable()).alias("priceable"), F.count("*").alias("n"))


@query("win1_latest_runs", ["run_status"], GATE + " SELECT run_date, subscription_id, run_type, status FROM runs")
def _(t):
    return gate.latest_runs(t["run_status"]).select("run_date", "subscription_id", "run_type", "status")


@query("agg8_gate", ["run_status"], GATE + " SELECT run_date, subscription_id, gate_complete FROM gate")
def _(t):
    return gate.build_gate(t["run_status"])


@query("flt4_apply_gate", ["raw_cost", "run_status"], GATE + f" SELECT * FROM (SELECT {POOL}, {d6('cost')} AS cost, gate_complete, {STATE} AS gate_state FROM ({POOL_COST}) LEFT JOIN gate USING (run_date, subscription_id)) WHERE gate_state <> 'gated_failed'")
def _(t):
    return rounded(gate.apply_gate(frames.daily_pool_cost(t["raw_cost"]), gate.build_gate(t["run_status"]), ERAS.gated))


@query("snk6_density", ["raw_cost"], "SELECT strftime(run_date, '%Y-%m') AS month, count(*) AS n FROM raw_cost GROUP BY 1")
def _(t):
    return snapshot.monthly_density(t["raw_cost"])


# Joins.

ATTRS = "job_name, job_category, job_ownership, job_team"
JOINED = f""", attrs AS (SELECT DISTINCT {POOL}, job_id, {ATTRS} FROM job_cost),
attributed AS (SELECT u.*, coalesce(job_name, 'Unknown') AS job_name, coalesce(job_category, 'Unknown') AS job_category, coalesce(job_ownership, 'Unknown') AS job_ownership, coalesce(job_team, 'Unknown') AS job_team, a.job_id IS NULL AS usage_only
  FROM job_usage u LEFT JOIN attrs a ON u.run_date = a.run_date AND u.subscription_id = a.subscription_id AND u.batch_account_name IS NOT DISTINCT FROM a.batch_account_name AND u.pool_name = a.pool_name AND u.job_id = a.job_id)"""


@query("jn1_five_key_join", ["job_usage", "job_cost"], JOINED + f" SELECT {POOL}, job_id, {ATTRS}, usage_only FROM attributed")
def _(t):
    return joins.join_attributes(t["job_usage"], t["job_cost"], check=False).select(*POOL_KEYS, "job_id", *ATTRS.split(", "), "usage_only")


@query("jn5_provenance", ["job_usage", "job_cost"], f"""SELECT source, count(*) AS n FROM (SELECT CASE WHEN r.k IS NULL THEN 'usage_only' WHEN u.k IS NULL THEN 'cost_only' ELSE 'both' END AS source
  FROM (SELECT {POOL}, job_id, 1 AS k FROM job_usage) u FULL JOIN (SELECT DISTINCT {POOL}, job_id, 1 AS k FROM job_cost) r
  ON u.run_date = r.run_date AND u.subscription_id = r.subscription_id AND u.batch_account_name IS NOT DISTINCT FROM r.batch_account_name AND u.pool_name = r.pool_name AND u.job_id = r.job_id) GROUP BY 1""")
def _(t):
    return joins.provenance(t["job_usage"], t["job_cost"], [*POOL_KEYS, "job_id"], "usage", "cost")


@query("jn6_enrich_environment", ["raw_cost", "environment_config"], DAILY + f" SELECT run_date, subscription_id, {d6('cost')} AS cost, subscription_name, environment_tier, environment_sub_tier, CASE WHEN subscription_name LIKE '%weu%' THEN 'westeurope' ELSE 'northeurope' END AS region FROM daily LEFT JOIN environment_config USING (subscription_id)")
def _(t):
    return rounded(joins.enrich_environment(daily(t), t["environment_config"]))


RECON = f""", r AS ({POOL_COST}), j AS (SELECT {POOL}, sum(cost) AS job_cost FROM job_cost WHERE run_date IS NOT NULL AND subscription_id IS NOT NULL AND batch_account_name IS NOT NULL AND pool_name IS NOT NULL GROUP BY {POOL}),
x AS (SELECT {POOL}, coalesce(cast(r.cost AS double), 0) AS raw_cost, coalesce(cast(job_cost AS double), 0) AS job_cost, CASE WHEN job_cost IS NULL THEN 'raw_only' WHEN r.cost IS NULL THEN 'job_only' ELSE 'both' END AS coverage FROM r FULL JOIN j USING ({POOL})),
recon AS (SELECT *, job_cost - raw_cost AS diff, (job_cost - raw_cost) / nullif(raw_cost, 0) AS rel_diff, coverage = 'both' AND coalesce(abs((job_cost - raw_cost) / nullif(raw_cost, 0)) <= 0.02, false) AS within_tol FROM x)"""


@query("jn4_reconcile", ["raw_cost", "job_cost"], RECON + f" SELECT {POOL}, {d6('raw_cost')} AS raw_cost, {d6('job_cost')} AS job_cost, coverage, {d6('diff')} AS diff, {d6('rel_diff')} AS rel_diff, within_tol FROM recon")
def _(t):
    return rounded(joins.reconcile(t["raw_cost"], t["job_cost"]))


@query("agg15_reconciliation_summary", ["raw_cost", "job_cost"], RECON + f""", s AS (SELECT count(*) AS pool_days, count(*) FILTER (WHERE coverage = 'both') AS "both", count(*) FILTER (WHERE coverage = 'raw_only') AS raw_only, count(*) FILTER (WHERE coverage = 'job_only') AS job_only,
  cast(sum(cast(raw_cost AS decimal(38, 6))) AS double) AS raw_total, cast(sum(cast(job_cost AS decimal(38, 6))) AS double) AS job_total, job_total / nullif(raw_total, 0) AS ratio, coalesce(cast(sum(cast(raw_cost AS decimal(38, 6))) FILTER (WHERE coverage = 'raw_only') AS double), 0) / nullif(raw_total, 0) AS unattributed_share,
  quantile_cont(abs(rel_diff), 0.5) FILTER (WHERE coverage = 'both') AS median_abs_rel, avg(CASE WHEN within_tol THEN 1.0 ELSE 0.0 END) FILTER (WHERE coverage = 'both') AS share_ok FROM recon)
  SELECT pool_days, "both", raw_only, job_only, {', '.join(f'{d6(c)} AS {c}' for c in ('raw_total', 'job_total', 'ratio', 'unattributed_share', 'median_abs_rel', 'share_ok'))},
  CASE WHEN "both" = 0 THEN 'NO OVERLAP' WHEN median_abs_rel <= 0.02 AND share_ok >= 0.9 THEN CASE WHEN unattributed_share >= 0.05 THEN 'EXACT SUBSET' ELSE 'AGREE' END ELSE 'DISAGREE' END AS verdict FROM s""")
def _(t):
    return rounded(joins.reconciliation_summary(joins.reconcile(t["raw_cost"], t["job_cost"])))


# Features.

EVENTS = """, known AS (SELECT * FROM job_usage WHERE subscription_id IS NOT NULL AND batch_account_name IS NOT NULL AND pool_name IS NOT NULL AND start_time IS NOT NULL AND end_time IS NOT NULL),
ev AS (SELECT subscription_id, batch_account_name, pool_name, start_time AS t, 1 AS delta FROM known UNION ALL SELECT subscription_id, batch_account_name, pool_name, end_time, -1 FROM known),
sweep AS (SELECT *, sum(delta) OVER (PARTITION BY subscription_id, batch_account_name, pool_name ORDER BY t, delta ROWS UNBOUNDED PRECEDING) AS running FROM ev),
conc AS (SELECT cast(t AS date) AS run_date, subscription_id, batch_account_name, pool_name, max(running) AS peak_concurrency, avg(running) AS mean_concurrency FROM sweep GROUP BY 1, 2, 3, 4)"""


@query("agg10_concurrency", ["job_usage"], EVENTS + f" SELECT {POOL}, cast(peak_concurrency AS bigint) AS peak_concurrency, {d6('mean_concurrency')} AS mean_concurrency FROM conc")
def _(t):
    return rounded(features.concurrency(t["job_usage"]))


def _share_sql(v: str) -> str:
    return f"coalesce(sum(job_seconds) FILTER (WHERE job_category = '{v}'), 0) / nullif(sum(job_seconds), 0)"


MIX = ", ".join(f"{d6(f'coalesce({_share_sql(v)}, 0)')} AS share_{v}" for v in LEVELS)


@query("agg9_job_mix", ["job_usage", "job_cost"], JOINED + f" SELECT {POOL}, count(*) AS n_jobs, {d6('max(job_seconds) / nullif(sum(job_seconds), 0)')} AS largest_job_share, {MIX} FROM attributed WHERE batch_account_name IS NOT NULL GROUP BY {POOL}")
def _(t):
    return rounded(features.job_mix(joins.join_attributes(t["job_usage"], t["job_cost"], check=False), LEVELS))


@query("agg2_activity", ["job_usage"], f"SELECT {POOL}, {d6('sum(job_seconds)')} AS job_seconds, cast(sum(task_count) AS bigint) AS task_count, count(*) AS job_rows FROM job_usage WHERE batch_account_name IS NOT NULL GROUP BY {POOL}")
def _(t):
    return rounded(features.activity(t["job_usage"]))


@query("win3_lags", ["raw_cost"], DAILY + f" SELECT run_date, subscription_id, {d6('cost')} AS cost, {d6('lag(cost) OVER w')} AS cost_lag1, {d6('lag(cost, 7) OVER w')} AS cost_lag7 FROM daily WINDOW w AS (PARTITION BY subscription_id ORDER BY run_date)")
def _(t):
    return rounded(factory.add_lags(daily(t), ["subscription_id"], ["cost"], [1, 7]))


def _roll(f: str, n: int) -> str:
    w = f"(PARTITION BY subscription_id ORDER BY run_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return d6(f"CASE WHEN count(c) OVER {w} >= {n} THEN {f} OVER {w} END")


@query("win4_rolling", ["raw_cost"], DAILY + f" SELECT run_date, subscription_id, {_roll('avg(c)', 28)} AS cost_roll28, {_roll('stddev_samp(c)', 28)} AS cost_roll28_std, {_roll('min(c)', 28)} AS cost_roll28_min, {_roll('max(c)', 28)} AS cost_roll28_max, {_roll('sum(c)', 28)} AS cost_roll28_sum, {_roll('quantile_cont(c, 0.5)', 28)} AS cost_roll28_median FROM (SELECT run_date, subscription_id, cast(cost AS double) AS c FROM daily)")
def _(t):
    d = daily(t).withColumn("cost", F.col("cost").cast("double"))
    return rounded(factory.add_rolling(d, ["subscription_id"], ["cost"], [28], stats=list(factory.STATS)).drop("cost"))


@query("pad1_pad_daily", ["raw_cost", "run_status"], GATE + f""", pools AS ({POOL_COST}), ends AS (SELECT subscription_id, batch_account_name, pool_name, min(run_date) AS lo, max(run_date) AS hi FROM pools GROUP BY 1, 2, 3),
  spine AS (SELECT subscription_id, batch_account_name, pool_name, cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS run_date FROM ends)
  SELECT {POOL}, {d6('coalesce(cost, 0)')} AS cost, cost IS NULL AS padded FROM spine LEFT JOIN pools USING ({POOL}) LEFT JOIN gate USING (run_date, subscription_id) WHERE cost IS NOT NULL OR coalesce(gate_complete, false)""")
def _(t):
    return rounded(factory.pad_daily(frames.daily_pool_cost(t["raw_cost"]), POOL_KEYS[1:], ["cost"], gate=gate.build_gate(t["run_status"])))


def _range(lo: int, hi: int) -> str:
    side = lambda n: "CURRENT ROW" if n == 0 else f"{-n} PRECEDING"
    return f"(PARTITION BY subscription_id, m ORDER BY n RANGE BETWEEN {side(lo)} AND {side(hi)})"


@query("win5_price_drift", ["raw_cost"], f""", p AS (SELECT run_date, subscription_id, meter_sub_category AS m, cast(sum(pre_tax_cost) AS double) AS c, sum(usage_quantity) AS u FROM raw_cost WHERE usage_quantity > 0 AND pre_tax_cost > 0 GROUP BY 1, 2, 3),
  e AS (SELECT subscription_id, m, min(run_date) AS lo, max(run_date) AS hi FROM p GROUP BY 1, 2),
  s AS (SELECT subscription_id, m, cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS run_date FROM e),
  x AS (SELECT s.*, c, c / u AS p, date_diff('day', DATE '1970-01-01', s.run_date) AS n FROM s LEFT JOIN p USING (subscription_id, m, run_date)),
  w AS (SELECT run_date, subscription_id, CASE WHEN count(p) OVER {_range(-13, 0)} >= 7 AND count(p) OVER {_range(-41, -14)} >= 14 THEN ln(avg(p) OVER {_range(-13, 0)} / avg(p) OVER {_range(-41, -14)}) END AS d, coalesce(sum(c) OVER {_range(-27, 0)}, 0) AS w FROM x)
  SELECT run_date, subscription_id, {d6('CASE WHEN sum(w) > 0 THEN sum(d * w) / sum(w) END')} AS price_drift FROM w WHERE d IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return rounded(factory.price_drift(t["raw_cost"], ["subscription_id"], "meter_sub_category"))


@query("agg12_meter_price", ["raw_cost"], f"SELECT run_date, meter, cast(sum(pre_tax_cost) AS double) / nullif(sum(usage_quantity), 0) AS unit_price FROM raw_cost WHERE usage_quantity > 0 AND pre_tax_cost > 0 GROUP BY 1, 2")
def _(t):
    return factory.unit_prices(t["raw_cost"], ["run_date", "meter"])  # one division of exact sums, so not rounded


# Teams.


TEAM = "coalesce(job_team, '__NULL_TEAM__')"
TEAM_DAYS = GATE + f""", per AS (SELECT run_date, team, sum(cost) AS cost, bool_and(gate_state = 'gated_complete') AS g FROM (SELECT run_date, {TEAM} AS team, cost, {STATE} AS gate_state FROM job_cost LEFT JOIN gate USING (run_date, subscription_id)) WHERE gate_state <> 'gated_failed' AND {REGIME} <> 'pre_coverage' GROUP BY 1, 2),
teams AS (SELECT run_date, team AS job_team, cost, coalesce(cast(sum(cost) FILTER (WHERE team IN ('Unknown', '__NULL_TEAM__')) OVER (PARTITION BY run_date) AS double), 0) / nullif(cast(sum(cost) OVER (PARTITION BY run_date) AS double), 0) AS unknown_pct, bool_and(g) OVER (PARTITION BY run_date) AS fully_gated FROM per)"""


@query("agg3_team_days", ["job_cost", "run_status"], TEAM_DAYS + f" SELECT run_date, job_team, {d6('cost')} AS cost, {d6('coalesce(unknown_pct, 0)')} AS unknown_pct, fully_gated FROM teams")
def _(t):
    return rounded(frames.team_days(t, ERAS))


@query("pad3_team_grid", ["job_cost", "run_status"], TEAM_DAYS + f" SELECT d.run_date, k.job_team, {d6('coalesce(cost, 0)')} AS cost, cost IS NULL AS padded FROM (SELECT DISTINCT run_date FROM teams) d CROSS JOIN (SELECT DISTINCT job_team FROM teams) k LEFT JOIN teams USING (run_date, job_team)")
def _(t):
    return rounded(frames.team_grid(frames.team_days(t, ERAS)).select("run_date", "job_team", "cost", "padded"))


SEVERITY = "CASE WHEN impact < 50 THEN 'low' WHEN impact < 500 AND score >= 1 THEN 'medium' WHEN score >= 1 THEN 'high' WHEN score >= 0.25 THEN 'medium' ELSE 'low' END"


def alert_sql(source: str, layer: str, metric: str, severity: str = SEVERITY) -> str:
    """The columns of alerts from source (run_date, scope, direction, observed, expected, lo, hi, score, impact), but for the message."""
    return f"""SELECT substr(sha1('{layer}|' || scope || '|' || cast(run_date AS varchar) || '|' || direction), 1, 12) AS alert_id, run_date, '{layer}' AS layer, scope, {metric} AS metric, {', '.join(f'{d6(c)} AS {c}' for c in ('observed', 'expected', 'lo', 'hi', 'score', 'impact'))}, direction, {severity} AS severity, 'new' AS status FROM {source}"""


ATTRIBUTION_SQL = """, un AS (SELECT DISTINCT run_date, 'estate' AS scope, 'above' AS direction, unknown_pct AS observed, 0.2::double AS expected, NULL AS lo, NULL AS hi, unknown_pct / 0.2::double - 1 AS score, NULL AS impact FROM teams WHERE unknown_pct > 0.2::double)"""


@query("det4_attribution_days", ["job_cost", "run_status"], TEAM_DAYS + ATTRIBUTION_SQL + " " + alert_sql("un", "attribution", "'unknown_pct'"))
def _(t):
    return rounded(detector.attribution_alerts(frames.team_days(t, ERAS)).drop("message"))


# Integrity.


@query("agg13_write_violations", ["raw_cost"], "SELECT run_date, subscription_id, resource_group_name, resource_type, meter, meter_sub_category, batch_account_name, pool_name, count(DISTINCT update_time) AS writes FROM raw_cost GROUP BY ALL HAVING count(DISTINCT update_time) > 1")
def _(t):
    return checks.write_violations(t["raw_cost"])


@query("agg14_duplicate_rate", ["raw_cost"], f"SELECT cast(sum(n) AS bigint) AS rows, cast(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS bigint) AS duplicate_rows, {d6('cast(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS double) / sum(n)')} AS rate FROM (SELECT count(*) AS n FROM raw_cost GROUP BY run_date, subscription_id, resource_group_name, meter, batch_account_name, pool_name)")
def _(t):
    return rounded(checks.duplicate_rate(t["raw_cost"], ["run_date", "subscription_id", "resource_group_name", "meter", "batch_account_name", "pool_name"]))


@query("ast5_partition_identity", ["raw_cost"], f"SELECT {d6('sum(pre_tax_cost)')} AS total, {d6('abs(sum(pre_tax_cost) - sum(pre_tax_cost) FILTER (WHERE pool_name IS NULL) - sum(pre_tax_cost) FILTER (WHERE pool_name IS NOT NULL))')} AS gap FROM raw_cost")
def _(t):
    raw = t["raw_cost"]
    total, gap = checks.partition_gap(raw, [gate.batch_slice(raw), gate.non_pool(raw)], "pre_tax_cost")
    return rounded(raw.sparkSession.createDataFrame([(total, round(gap, 4))], "total double, gap double"))


@query("ast15_stage_counts", ["job_usage", "job_cost"], JOINED + f""", st AS (SELECT 'usage' AS stage, count(*) AS n FROM job_usage GROUP BY {POOL}, job_id UNION ALL SELECT 'cost', count(*) FROM job_cost GROUP BY {POOL}, job_id UNION ALL SELECT 'joined', count(*) FROM attributed GROUP BY {POOL}, job_id)
  SELECT stage, cast(sum(n) AS bigint) AS rows, count(*) AS keys, max(n) AS most FROM st GROUP BY 1""")
def _(t):
    keys = [*POOL_KEYS, "job_id"]
    return checks.stage_counts({"usage": (t["job_usage"], keys), "cost": (t["job_cost"], keys), "joined": (joins.join_attributes(t["job_usage"], t["job_cost"], check=False), keys)})


# Decomposition.

DAY = date(1999, 6, 15)
GROUP = {"subscription_id": "sub-1"}
_N = f"(SELECT count(DISTINCT run_date) FROM raw_cost WHERE subscription_id = 'sub-1' AND run_date BETWEEN DATE '{DAY}' - 28 AND DATE '{DAY}' - 1)"


def _part(c: str, cond: str, over: str = "1") -> str:
    return f"coalesce(cast(sum({c}) FILTER (WHERE {cond}) AS double), 0) / {over}"


ITEMS = f""", it AS (SELECT meter, {_part('pre_tax_cost', f"run_date < DATE '{DAY}'", _N)} AS ca, {_part('usage_quantity', f"run_date < DATE '{DAY}'", _N)} AS ua, {_part('pre_tax_cost', f"run_date = DATE '{DAY}'")} AS cb, {_part('usage_quantity', f"run_date = DATE '{DAY}'")} AS ub
  FROM raw_cost WHERE subscription_id = 'sub-1' AND run_date BETWEEN DATE '{DAY}' - 28 AND DATE '{DAY}' GROUP BY meter),
ef AS (SELECT *, cb - ca AS delta, CASE WHEN ca = 0 AND ua = 0 THEN 'entering' WHEN cb = 0 AND ub = 0 THEN 'exiting' WHEN ua > 0 AND ub > 0 THEN 'priced' ELSE 'unpriced' END AS kind FROM it),
fx AS (SELECT meter, ca AS cost_a, cb AS cost_b, delta, kind, CASE WHEN kind = 'priced' THEN (cb / ub - ca / ua) * (ua + ub) / 2 ELSE 0 END AS price, CASE WHEN kind = 'priced' THEN (ub - ua) * (ca / ua + cb / ub) / 2 ELSE 0 END AS usage, CASE WHEN kind IN ('entering', 'exiting') THEN delta ELSE 0 END AS scope, CASE WHEN kind = 'unpriced' THEN delta ELSE 0 END AS unpriced FROM ef)"""


@query("jn14_decomposition", ["raw_cost"], ITEMS + f" SELECT meter, kind, {', '.join(f'{d6(c)} AS {c}' for c in ('cost_a', 'cost_b', 'delta', 'price', 'usage', 'scope', 'unpriced'))} FROM fx")
def _(t):
    return rounded(decompose.day_vs_baseline(t["raw_cost"], DAY, GROUP).drop("usage_a", "usage_b"))


@query("agg23_decomposition_totals", ["raw_cost"], ITEMS + f" SELECT {', '.join(f'coalesce(cast(round(cast(sum({c}) AS decimal(38, 6)), 2) AS double), 0) AS {n}' for n, c in {'total_a': 'cost_a', 'total_b': 'cost_b', 'delta': 'delta', 'price': 'price', 'usage': 'usage', 'scope': 'scope', 'unpriced': 'unpriced'}.items())} FROM fx")
def _(t):
    return decompose.summary(decompose.day_vs_baseline(t["raw_cost"], DAY, GROUP))


@query("ord2_top_items", ["raw_cost"], ITEMS + f" SELECT meter, kind, {d6('delta')} AS delta FROM fx ORDER BY abs({d6('delta')}) DESC, meter LIMIT 5")
def _(t):
    return decompose.top_items(rounded(decompose.day_vs_baseline(t["raw_cost"], DAY, GROUP).select("meter", "kind", "delta")), 5)


_NJ = _N.replace("raw_cost", "job_cost")


@query("agg24_team_contribution", ["job_cost"], f""", it AS (SELECT job_team, {_part('cost', f"run_date = DATE '{DAY}'")} AS day_cost, {_part('cost', f"run_date < DATE '{DAY}'", _NJ)} AS baseline_cost FROM job_cost WHERE subscription_id = 'sub-1' AND run_date BETWEEN DATE '{DAY}' - 28 AND DATE '{DAY}' GROUP BY 1),
  x AS (SELECT *, day_cost - baseline_cost AS delta, sum(day_cost - baseline_cost) OVER () AS whole FROM it)
  SELECT job_team, {d6('day_cost')} AS day_cost, {d6('baseline_cost')} AS baseline_cost, {d6('delta')} AS delta, {d6('CASE WHEN abs(whole) > 0.01 THEN delta / whole END')} AS share FROM x""")
def _(t):
    return rounded(decompose.team_contribution(t["job_cost"], DAY, GROUP).drop("ratio"))


# Forecasts.

_O = ", ".join(f"(DATE '{o}', DATE '{baselines._next_month(o)}')" for o in ORIGINS)
FOLDS = DAILY + f""", origins(origin, until) AS (VALUES {_O}), base AS (SELECT subscription_id, run_date AS day, cast(cost AS double) AS y FROM daily),
train AS (SELECT origin, b.* FROM base b, origins WHERE day < origin), test AS (SELECT origin, b.* FROM base b, origins WHERE day >= origin AND day < until)"""


def _banded(points: str, residuals: str, model: str) -> str:
    return f""", res_{model} AS ({residuals}), pt_{model} AS ({points}),
  by_{model} AS (SELECT origin, subscription_id, quantile_cont(r, 0.05) AS lo, quantile_cont(r, 0.95) AS hi FROM res_{model} WHERE r IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 20),
  all_{model} AS (SELECT origin, quantile_cont(r, 0.05) AS plo, quantile_cont(r, 0.95) AS phi FROM res_{model} WHERE r IS NOT NULL GROUP BY 1),
  l_{model} AS (SELECT day AS run_date, subscription_id, '{model}' AS model, origin, y AS y_true, CASE WHEN point IS NOT NULL THEN greatest(point + coalesce(lo, plo, 0), 0) END AS q05, CASE WHEN point IS NOT NULL THEN greatest(point, 0) END AS q50, CASE WHEN point IS NOT NULL THEN greatest(point + coalesce(hi, phi, 0), 0) END AS q95
    FROM pt_{model} LEFT JOIN by_{model} USING (origin, subscription_id) LEFT JOIN all_{model} USING (origin))"""


LEDGER_SQL = (
    FOLDS
    + _banded(
        "SELECT t.*, l.point FROM test t LEFT JOIN (SELECT origin, subscription_id, isodow(day) AS w, arg_max(y, day) AS point FROM train GROUP BY 1, 2, 3) l ON t.origin = l.origin AND t.subscription_id = l.subscription_id AND isodow(t.day) = l.w",
        "SELECT origin, subscription_id, y - lag(y, 7) OVER (PARTITION BY origin, subscription_id ORDER BY day) AS r FROM train",
        "seasonal_naive",
    )
    + """, near AS (SELECT t.*, cast(date_diff('day', origin, day) AS double) AS x FROM train t JOIN (SELECT origin, max(day) AS e FROM train GROUP BY 1) USING (origin) WHERE day > e - 90),
  fit AS (SELECT origin, subscription_id, CASE WHEN count(DISTINCT x) > 1 THEN regr_slope(y, x) ELSE 0 END AS slope, CASE WHEN count(DISTINCT x) > 1 THEN regr_intercept(y, x) ELSE avg(y) END AS level FROM near GROUP BY 1, 2)"""
    + _banded(
        "SELECT t.*, greatest(level + slope * date_diff('day', origin, day), 0) AS point FROM test t LEFT JOIN fit USING (origin, subscription_id)",
        "SELECT origin, subscription_id, y - (level + slope * x) AS r FROM near JOIN fit USING (origin, subscription_id)",
        "three_month_trend",
    )
    + _banded(
        "SELECT t.*, point FROM test t LEFT JOIN (SELECT origin, subscription_id, quantile_cont(y, 0.5) AS point FROM (SELECT *, row_number() OVER (PARTITION BY origin, subscription_id ORDER BY day DESC) AS k FROM train) WHERE k <= 28 GROUP BY 1, 2) USING (origin, subscription_id)",
        "SELECT origin, subscription_id, y - CASE WHEN count(y) OVER w >= 7 THEN quantile_cont(y, 0.5) OVER w END AS r FROM train WINDOW w AS (PARTITION BY origin, subscription_id ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)",
        "rolling_median",
    )
    + ", ledger AS (SELECT * FROM l_seasonal_naive UNION ALL SELECT * FROM l_three_month_trend UNION ALL SELECT * FROM l_rolling_median)"
)


def ledger(t: dict[str, DataFrame], models=baselines.MODELS) -> DataFrame:
    return baselines.walk_forward(daily(t), SPEC, ORIGINS, models)


@query("ml2_walk_forward", ["raw_cost"], LEDGER_SQL + f" SELECT run_date, subscription_id, model, origin, {', '.join(f'{d6(c)} AS {c}' for c in ('y_true', 'q05', 'q50', 'q95'))} FROM ledger")
def _(t):
    return rounded(ledger(t))


_PIN = lambda q, tau: f"avg(greatest({tau} * (y_true - {q}), ({tau} - 1) * (y_true - {q})))"


@query("agg22_metrics", ["raw_cost"], LEDGER_SQL + f""", flat AS (SELECT model, count(*) AS n, count(q50) AS n_scored, avg(abs(y_true - q50)) AS mae, {_PIN('q05', 0.05)} AS pinball_05, {_PIN('q50', 0.5)} AS pinball_50, {_PIN('q95', 0.95)} AS pinball_95, avg(CASE WHEN q50 IS NULL THEN NULL WHEN y_true BETWEEN q05 AND q95 THEN 1.0 ELSE 0.0 END) AS coverage FROM ledger GROUP BY 1),
  mo AS (SELECT model, origin, subscription_id, sum(y_true) AS a, sum(q50) AS p FROM ledger WHERE q50 IS NOT NULL GROUP BY 1, 2, 3),
  bm AS (SELECT model, avg(abs(p - a) / abs(a)) FILTER (WHERE abs(a) > 1e-9) AS monthly_pct_err, sum(abs(p - a)) / sum(abs(a)) AS wape FROM mo GROUP BY 1),
  es AS (SELECT model, avg(abs(p - a) / abs(a)) AS estate_pct_err, avg((p - a) / a) AS bias FROM (SELECT model, origin, sum(a) AS a, sum(p) AS p FROM mo GROUP BY 1, 2) GROUP BY 1)
  SELECT model, n, n_scored, {', '.join(f'{d6(c)} AS {c}' for c in ('mae', 'pinball_05', 'pinball_50', 'pinball_95', 'coverage', 'monthly_pct_err', 'wape', 'estate_pct_err', 'bias'))} FROM flat JOIN bm USING (model) JOIN es USING (model)""")
def _(t):
    return rounded(metrics.evaluate(ledger(t), SPEC.group_keys))


_SCORE = "greatest(q05 - y_true, y_true - q95) / greatest(q95 - q05, 1e-9)"
_KTH = "CASE WHEN count(s) = 0 THEN 0 ELSE list_sort(list(s))[cast(greatest(least(ceil((count(s) + 1) * 0.9::double), count(s)), 1) AS int)] END"
MARGINS = f""", sc AS (SELECT *, {_SCORE} AS s FROM ledger WHERE model = 'rolling_median' AND q50 IS NOT NULL),
  mg AS (SELECT cast(NULL AS varchar) AS subscription_id, {_KTH} AS margin, count(*) AS n, true AS pooled FROM sc UNION ALL SELECT subscription_id, {_KTH}, count(*), false FROM sc GROUP BY subscription_id HAVING count(*) >= 30)"""


@query("agg18_margins", ["raw_cost"], LEDGER_SQL + MARGINS + f" SELECT subscription_id, {d6('margin')} AS margin, n, pooled, ceil((n + 1) * 0.9::double) <= n AS guaranteed FROM mg")
def _(t):
    return rounded(calibrate.margins(ledger(t, ["rolling_median"]), ["subscription_id"]))


@query("jn15_apply_margins", ["raw_cost"], LEDGER_SQL + MARGINS + f""", ap AS (SELECT sc.*, coalesce(g.margin, (SELECT margin FROM mg WHERE pooled)) AS m FROM sc LEFT JOIN mg g ON g.subscription_id = sc.subscription_id AND NOT g.pooled)
  SELECT run_date, subscription_id, origin, {d6('greatest(least(q05 - m * (q95 - q05), q50), 0)')} AS q05, {d6('q50')} AS q50, {d6('greatest(greatest(q95 + m * (q95 - q05), q50), 0)')} AS q95 FROM ap""")
def _(t):
    one = ledger(t, ["rolling_median"])
    return rounded(calibrate.apply_margins(one, calibrate.margins(one, ["subscription_id"]), ["subscription_id"]).select("run_date", "subscription_id", "origin", "q05", "q50", "q95"))


# Detector. Its ledger: each subscription's day against a trailing median and spread.

DETECT = DetectorConfig(margin_window_days=60)
SERIES = DAILY + """, b AS (SELECT run_date, subscription_id, cast(cost AS double) AS y FROM daily),
  led AS (SELECT run_date, subscription_id, y AS y_true, quantile_cont(y, 0.5) OVER w AS q50, quantile_cont(y, 0.1) OVER w AS q05, quantile_cont(y, 0.9) OVER w AS q95 FROM b WINDOW w AS (PARTITION BY subscription_id ORDER BY run_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
  ld AS (SELECT * FROM led WHERE q50 IS NOT NULL)"""


def series_ledger(t: dict[str, DataFrame]) -> DataFrame:
    from pyspark.sql import Window as W

    w = W.partitionBy("subscription_id").orderBy("run_date").rowsBetween(-28, -1)
    d = daily(t).withColumn("y_true", F.col("cost").cast("double"))
    q = {n: F.percentile("y_true", F.lit(p)).over(w) for n, p in (("q05", 0.1), ("q50", 0.5), ("q95", 0.9))}
    return d.withColumns(q).where("q50 IS NOT NULL").select("run_date", "subscription_id", "y_true", *q)


SINCE = date(2001, 1, 1)


L1_SQL = SERIES + f""", s AS (SELECT run_date AS sd, subscription_id, {_SCORE} AS s FROM ld), days AS (SELECT DISTINCT run_date FROM ld WHERE run_date >= DATE '{SINCE}'),
  nr AS (SELECT d.run_date, s.subscription_id, s.s FROM days d JOIN s ON s.sd >= d.run_date - 60 AND s.sd < d.run_date),
  p AS (SELECT run_date, {_KTH} AS pm FROM nr GROUP BY 1), g AS (SELECT run_date, subscription_id, {_KTH} AS gm FROM nr GROUP BY 1, 2 HAVING count(*) >= 30),
  x AS (SELECT ld.*, coalesce(gm, pm) AS m FROM ld JOIN p USING (run_date) LEFT JOIN g USING (run_date, subscription_id)),
  y AS (SELECT *, greatest(least(q05 - m * (q95 - q05), q50), 0) AS lo, greatest(greatest(q95 + m * (q95 - q05), q50), 0) AS hi FROM x),
  z AS (SELECT *, greatest(y_true - hi, lo - y_true) AS impact, CASE WHEN y_true > hi THEN 'above' ELSE 'below' END AS direction FROM y WHERE y_true > hi OR y_true < lo),
  l1 AS (SELECT run_date, 'subscription_id=' || subscription_id AS scope, direction, y_true AS observed, q50 AS expected, lo, hi, impact / greatest(hi - lo, 1e-9) AS score, impact FROM z)"""


@query("det1_interval_alerts", ["raw_cost"], L1_SQL + " " + alert_sql("l1", "L1_interval", "'daily_cost'"))
def _(t):
    return rounded(detector.interval_alerts(series_ledger(t), ["subscription_id"], DETECT, SINCE).drop("message"))


CUSUM_SQL = f""", r AS (SELECT *, y_true - q50 AS e, row_number() OVER (PARTITION BY subscription_id ORDER BY run_date) AS i FROM ld),
  h AS (SELECT *, list(e) OVER (PARTITION BY subscription_id ORDER BY i ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS past FROM r),
  z0 AS (SELECT *, list_median(past) AS med FROM h WHERE len(past) >= 20),
  z1 AS (SELECT subscription_id, run_date, e, e / greatest(1.4826 * list_median(list_transform(past, lambda x: abs(x - med))), 1e-9) AS z, row_number() OVER (PARTITION BY subscription_id ORDER BY i) AS k FROM z0),
  c AS (SELECT subscription_id, run_date, e, k, z, greatest(0, z - 0.5) AS s_pos, greatest(0, -z - 0.5) AS s_neg FROM z1 WHERE k = 1
    UNION ALL SELECT n.subscription_id, n.run_date, n.e, n.k, n.z, greatest(0, CASE WHEN c.s_pos > 5 OR c.s_neg > 5 THEN 0 ELSE c.s_pos END + n.z - 0.5), greatest(0, CASE WHEN c.s_pos > 5 OR c.s_neg > 5 THEN 0 ELSE c.s_neg END - n.z - 0.5) FROM c JOIN z1 n ON n.subscription_id = c.subscription_id AND n.k = c.k + 1),
  l15 AS (SELECT run_date, 'subscription_id=' || subscription_id AS scope, CASE WHEN s_pos >= s_neg THEN 'above' ELSE 'below' END AS direction, e AS observed, 0 AS expected, NULL AS lo, NULL AS hi, (greatest(s_pos, s_neg) - 5) / 5 AS score, abs(e) AS impact FROM c WHERE greatest(s_pos, s_neg) > 5)"""


@query("det2_cusum", ["raw_cost"], SERIES + CUSUM_SQL + f" SELECT subscription_id, run_date, {d6('z')} AS z, {d6('s_pos')} AS s_pos, {d6('s_neg')} AS s_neg, CASE WHEN greatest(s_pos, s_neg) <= 5 THEN NULL WHEN s_pos >= s_neg THEN 'above' ELSE 'below' END AS alarm FROM c")
def _(t):
    return rounded(detector.cusum(series_ledger(t), ["subscription_id"]).where("z IS NOT NULL").select("subscription_id", "run_date", "z", "s_pos", "s_neg", "alarm"))


@query("det2_cusum_alerts", ["raw_cost"], SERIES + CUSUM_SQL + " " + alert_sql("l15", "L1.5_cusum", "'residual_drift'"))
def _(t):
    return rounded(detector.cusum_alerts(series_ledger(t), ["subscription_id"]).drop("message"))


JOB_DAYS = """, jobs AS (SELECT run_date, subscription_id, batch_account_name, pool_name, job_name, cast(sum(cost) AS double) AS cost FROM job_cost WHERE batch_account_name IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
  h AS (SELECT *, row_number() OVER w AS i, list(cost) OVER (PARTITION BY subscription_id, batch_account_name, pool_name, job_name ORDER BY run_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS past FROM jobs WINDOW w AS (PARTITION BY subscription_id, batch_account_name, pool_name, job_name ORDER BY run_date)),
  m AS (SELECT *, coalesce(len(past), 0) AS n, list_median(past) AS med FROM h), z AS (SELECT *, greatest(1.4826 * list_median(list_transform(past, lambda x: abs(x - med))), 1e-9) AS sigma FROM m),
  l2 AS (SELECT run_date, 'subscription_id=' || subscription_id || ';batch_account_name=' || batch_account_name || ';pool_name=' || pool_name || ';job_name=' || job_name AS scope, CASE WHEN i = 1 THEN 'new' WHEN cost > med THEN 'above' ELSE 'below' END AS direction, cost AS observed, CASE WHEN i > 1 THEN med END AS expected, NULL AS lo, NULL AS hi, CASE WHEN i = 1 THEN 0 ELSE abs(cost - med) / sigma / 5 - 1 END AS score, CASE WHEN i = 1 THEN cost ELSE abs(cost - med) END AS impact
    FROM z WHERE i = 1 OR (n >= 10 AND abs(cost - med) >= 5 AND abs(cost - med) / sigma > 5))"""
L2_SEVERITY = f"CASE WHEN direction = 'new' THEN 'low' ELSE {SEVERITY} END"
L2_METRIC = "CASE WHEN direction = 'new' THEN 'new_job' ELSE 'job_daily_cost' END"


@query("det3_job_alerts", ["job_cost"], JOB_DAYS + " " + alert_sql("l2", "L2_job", L2_METRIC, L2_SEVERITY))
def _(t):
    return rounded(detector.job_alerts(t["job_cost"]).drop("message"))


# Serving.


@query("win2_current_view", ["raw_cost"], DAILY + f""", preds AS (SELECT run_date, subscription_id, {d6('cost')} AS q50, 'v1' AS model_version, '20200101' AS scored_at FROM daily UNION ALL SELECT run_date, subscription_id, {d6('cost * 2')}, 'v1', '20200102' FROM daily WHERE day(run_date) <= 10)
  SELECT run_date, subscription_id, model_version, q50, scored_at FROM preds QUALIFY row_number() OVER (PARTITION BY run_date, subscription_id, model_version ORDER BY scored_at DESC) = 1""")
def _(t):
    d = rounded(daily(t).select("run_date", "subscription_id", F.col("cost").alias("q50")))
    twice = rounded(daily(t).where(F.dayofmonth("run_date") <= 10).select("run_date", "subscription_id", (F.col("cost") * 2).alias("q50")))
    all_ = d.withColumn("scored_at", F.lit("20200101")).unionByName(twice.withColumn("scored_at", F.lit("20200102"))).withColumn("model_version", F.lit("v1"))
    return ledgers.current_view(all_, ["subscription_id"], "v1")


FEATS = ["cost_lag1", "cost_lag7", "cost_roll28", "job_seconds_roll7", "price_drift_lag1", "price_drift_lag7", "dow"]


@query("udf_history_demand", None, "SELECT * FROM (VALUES " + ", ".join(f"('{f}', {n})" for f, n in zip(FEATS, (1, 7, 29, 8, 42, 48, 0))) + ") v(feature, days)")
def _(spark, sf_dir):
    return spark.createDataFrame([(f, scalars.history_days(f)) for f in FEATS], "feature string, days int")


# Frames: the pool skeleton against SQL; the full ones for their rows.


SHARES = [f"share_{v}" for v in LEVELS]
POOL_SQL = JOINED.replace("SELECT u.*,", "SELECT u.* REPLACE (coalesce(u.batch_account_name, '__NULL_BATCH__') AS batch_account_name),") + EVENTS.replace("FROM job_usage", "FROM attributed") + GATE + f""", act AS (SELECT {POOL}, sum(job_seconds) AS job_seconds, cast(sum(task_count) AS bigint) AS task_count FROM attributed GROUP BY {POOL}),
  mix AS (SELECT {POOL}, count(*) AS n_jobs, max(job_seconds) / nullif(sum(job_seconds), 0) AS largest_job_share, {MIX} FROM attributed GROUP BY {POOL}),
  f0 AS (SELECT {POOL}, cast(c.cost AS double) AS cost, job_seconds, task_count, cast(peak_concurrency AS bigint) AS peak_concurrency, mean_concurrency, n_jobs, largest_job_share, {', '.join(SHARES)}, {REGIME} AS data_regime, gate_complete, {STATE} AS gate_state FROM ({POOL_COST}) c LEFT JOIN act USING ({POOL}) LEFT JOIN conc USING ({POOL}) LEFT JOIN mix USING ({POOL}) LEFT JOIN gate USING (run_date, subscription_id)),
  f AS (SELECT * FROM f0 WHERE gate_state <> 'gated_failed' AND data_regime <> 'pre_coverage')"""
REALS = ["cost", "job_seconds", "mean_concurrency", "largest_job_share"]


def d6_all(cols: list[str]) -> str:
    return ", ".join(f"{d6(c)} AS {c}" for c in cols)


def calendar_sql(d: str = "run_date") -> str:
    return f"""cast(isodow({d}) - 1 AS bigint) AS dow, cast(day({d}) AS bigint) AS day_of_month, cast(month({d}) AS bigint) AS month, date_diff('day', {d}, last_day({d})) AS d_to_month_end,
  date_diff('day', {d}, last_day(cast(date_trunc('quarter', {d}) + INTERVAL 2 MONTH AS date))) AS d_to_quarter_end, isodow({d}) >= 6 AS is_weekend"""


def lags_sql(by: str, cols: dict[str, list[int]]) -> str:
    return ", ".join(f"{d6(f'lag({c}, {k}) OVER (PARTITION BY {by} ORDER BY run_date)')} AS {c}_lag{k}" for c, ks in cols.items() for k in ks)


def roll_sql(by: str, c: str, n: int) -> str:
    w = f"(PARTITION BY {by} ORDER BY run_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"{d6(f'CASE WHEN count({c}) OVER {w} >= {n} THEN avg({c}) OVER {w} END')} AS {c}_roll{n}"


def drift_sql(source: str, keys: str, meter: str = "meter") -> str:
    """CTEs up to drift (run_date, keys, price_drift)."""
    on = f"{keys}, {meter}"
    w = lambda lo, hi: f"(PARTITION BY {on} ORDER BY n RANGE BETWEEN {-lo} PRECEDING AND {'CURRENT ROW' if hi == 0 else f'{-hi} PRECEDING'})"
    return f""", dp AS (SELECT run_date, {on}, cast(sum(pre_tax_cost) AS double) AS c, sum(usage_quantity) AS u FROM {source} WHERE usage_quantity > 0 AND pre_tax_cost > 0 GROUP BY ALL),
  de AS (SELECT {on}, min(run_date) AS lo, max(run_date) AS hi FROM dp GROUP BY ALL),
  ds AS (SELECT {on}, cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS run_date FROM de),
  dx AS (SELECT ds.*, c, c / u AS p, date_diff('day', DATE '1970-01-01', ds.run_date) AS n FROM ds LEFT JOIN dp USING ({on}, run_date)),
  dw AS (SELECT run_date, {keys}, CASE WHEN count(p) OVER {w(-13, 0)} >= 7 AND count(p) OVER {w(-41, -14)} >= 14 THEN ln(avg(p) OVER {w(-13, 0)} / avg(p) OVER {w(-41, -14)}) END AS d, coalesce(sum(c) OVER {w(-27, 0)}, 0) AS w FROM dx),
  drift AS (SELECT run_date, {keys}, CASE WHEN sum(w) > 0 THEN sum(d * w) / sum(w) END AS price_drift FROM dw WHERE d IS NOT NULL GROUP BY ALL)"""


ENV = "subscription_name, environment_tier, environment_sub_tier, CASE WHEN subscription_name LIKE '%weu%' THEN 'westeurope' WHEN subscription_name LIKE '%neu%' THEN 'northeurope' ELSE 'unknown' END AS region"


@query("frm1_pool_frame", ["raw_cost", "job_usage", "job_cost", "run_status"], POOL_SQL + f" SELECT {POOL}, {d6_all(REALS)}, task_count, peak_concurrency, n_jobs, {', '.join(SHARES)}, data_regime, gate_complete, gate_state FROM f")
def _(t):
    return rounded(frames.pool_frame(t, ERAS, LEVELS, check=False))


BY = "subscription_id, batch_account_name, pool_name"
_PADDED = ", ".join([f"CASE WHEN f.cost IS NULL THEN 0 ELSE {c} END AS {c}" for c in ("cost", "job_seconds", "task_count", "peak_concurrency", "mean_concurrency", "n_jobs", "largest_job_share", *SHARES)])


@query("frm3_frame_1a", ["raw_cost", "job_usage", "job_cost", "run_status", "environment_config"], POOL_SQL + drift_sql(SLICE, BY) + f""", ends AS (SELECT {BY}, min(run_date) AS lo, max(run_date) AS hi FROM f GROUP BY ALL),
  spine AS (SELECT {BY}, cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS run_date FROM ends),
  p0 AS (SELECT {POOL}, {_PADDED}, f.gate_complete, f.cost IS NULL AS padded, {REGIME} AS data_regime, coalesce(f.gate_state, 'gated_complete') AS gate_state
    FROM spine LEFT JOIN f USING ({POOL}) LEFT JOIN (SELECT run_date, subscription_id, gate_complete AS g FROM gate) USING (run_date, subscription_id) WHERE f.cost IS NOT NULL OR coalesce(g, false)),
  p1 AS (SELECT * FROM p0 LEFT JOIN drift USING ({POOL}))
  SELECT {POOL}, {d6_all(REALS)}, cast(task_count AS bigint) AS task_count, cast(peak_concurrency AS bigint) AS peak_concurrency, cast(n_jobs AS bigint) AS n_jobs, {', '.join(SHARES)}, data_regime, gate_complete, gate_state, padded, {d6('price_drift')} AS price_drift,
  {lags_sql(BY, {'cost': [1, 7], 'job_seconds': [1], 'mean_concurrency': [1], 'largest_job_share': [1], 'price_drift': [1], **{c: [1] for c in SHARES}})},
  {', '.join(f'cast(lag({c}) OVER (PARTITION BY {BY} ORDER BY run_date) AS bigint) AS {c}_lag1' for c in ('task_count', 'peak_concurrency', 'n_jobs'))},
  {roll_sql(BY, 'cost', 28)}, {roll_sql(BY, 'job_seconds', 7)}, {calendar_sql()}, {ENV} FROM p1 LEFT JOIN environment_config USING (subscription_id)""")
def _(t):
    return rounded(frames.frame_1a(t, ERAS, LEVELS, check=False).df)


SEG = "subscription_id, segment"


@query("frm4_frame_1b", ["raw_cost", "run_status", "environment_config"], GATE + f""", rest AS (SELECT *, {SEGMENT} AS segment FROM raw_cost WHERE pool_name IS NULL),
  b0 AS (SELECT run_date, {SEG}, cast(sum(pre_tax_cost) AS double) AS c, count(*) AS n FROM rest GROUP BY ALL),
  spine AS (SELECT {SEG}, cast(unnest(generate_series((SELECT min(run_date) FROM b0), (SELECT max(run_date) FROM b0), INTERVAL 1 DAY)) AS date) AS run_date FROM (SELECT DISTINCT {SEG} FROM b0)),
  b1 AS (SELECT run_date, {SEG}, coalesce(c, 0) AS cost, coalesce(n, 0) AS line_count, c IS NULL AS padded, {REGIME} AS data_regime, gate_complete, {STATE} AS gate_state FROM spine LEFT JOIN b0 USING (run_date, {SEG}) LEFT JOIN gate USING (run_date, subscription_id) WHERE c IS NOT NULL OR coalesce(gate_complete, false))"""
  + drift_sql("rest", SEG) + f""", b2 AS (SELECT * FROM b1 LEFT JOIN drift USING (run_date, {SEG}) WHERE gate_state <> 'gated_failed' AND data_regime <> 'pre_coverage')
  SELECT run_date, {SEG}, {d6('cost')} AS cost, line_count, padded, data_regime, gate_complete, gate_state, {d6('price_drift')} AS price_drift, {lags_sql(SEG, {'cost': [1, 7], 'price_drift': [1]})},
  cast(lag(line_count) OVER (PARTITION BY {SEG} ORDER BY run_date) AS bigint) AS line_count_lag1, {roll_sql(SEG, 'cost', 28)}, {calendar_sql()}, run_date >= DATE '{ERAS.post_glide}' AS post_glide, {ENV} FROM b2 LEFT JOIN environment_config USING (subscription_id)""")
def _(t):
    return rounded(frames.frame_1b(t, ERAS, check=False).df)


TEAM_JOINED = JOINED.replace("FROM job_cost)", f"FROM (SELECT job_cost.* REPLACE ({TEAM} AS job_team) FROM job_cost LEFT JOIN gate USING (run_date, subscription_id) WHERE {STATE} <> 'gated_failed' AND {REGIME} <> 'pre_coverage'))")
LOW_MIX = ", ".join(f"coalesce({_share_sql(v)}, 0) AS share_{v.lower()}" for v in LEVELS)
TEAM_NUM = ["job_seconds", "task_count", "n_jobs", *(f"share_{v.lower()}" for v in LEVELS)]


@query("frm5_frame_2", ["job_usage", "job_cost", "run_status"], TEAM_DAYS + TEAM_JOINED + f""", days AS (SELECT run_date, max(coalesce(unknown_pct, 0)) AS unknown_pct, bool_and(fully_gated) AS fully_gated FROM teams GROUP BY 1),
  am AS (SELECT run_date, job_team, sum(job_seconds) AS job_seconds, cast(sum(task_count) AS bigint) AS task_count, count(*) AS n_jobs, {LOW_MIX} FROM attributed GROUP BY 1, 2),
  g2 AS (SELECT run_date, job_team, unknown_pct, fully_gated, coalesce(cast(cost AS double), 0) AS cost, cost IS NULL AS padded, {', '.join(f'coalesce(am.{c}, 0) AS {c}' for c in TEAM_NUM)}
    FROM days CROSS JOIN (SELECT DISTINCT job_team FROM teams) k LEFT JOIN (SELECT run_date, job_team, cost FROM teams) USING (run_date, job_team) LEFT JOIN am USING (run_date, job_team))
  SELECT run_date, job_team, fully_gated, padded, {d6_all(['cost', 'unknown_pct', *(c for c in TEAM_NUM if c not in ('task_count', 'n_jobs'))])}, cast(task_count AS bigint) AS task_count, cast(n_jobs AS bigint) AS n_jobs,
  {lags_sql('job_team', {'cost': [1, 7], **{c: [1] for c in TEAM_NUM if c not in ('task_count', 'n_jobs')}})}, {', '.join(f'cast(lag({c}) OVER (PARTITION BY job_team ORDER BY run_date) AS bigint) AS {c}_lag1' for c in ('task_count', 'n_jobs'))},
  {roll_sql('job_team', 'cost', 28)}, {calendar_sql()}, CASE WHEN fully_gated THEN 'gated_complete' ELSE 'ungated' END AS gate_state, {REGIME} AS data_regime FROM g2""")
def _(t):
    return rounded(frames.frame_2(t, ERAS, LEVELS, check=False).df)


@query("ml7_conformal_ledger", ["raw_cost"])
def _(t):
    return pipeline.run_models(daily(t), SPEC, {"c": calibrate.conformal(baselines.rolling_median)}, ORIGINS)


@query("ml5_quantile_gbm", ["raw_cost"])
def _(t):
    keys = ["subscription_id"]
    made = factory.lagged(["cost"], [1, 7], keys) | factory.rolled(["cost"], [28], keys)
    f = scalars.add_calendar(daily(t).withColumn("cost", F.col("cost").cast("double")).withColumns(made)).withColumn("is_weekend", F.col("is_weekend").cast("int"))
    return pipeline.gbm_forecaster(f, SPEC, [*made, "dow", "month", "subscription_id"], keys, ORIGINS[:1], rounds=30, conformal=True)[0]


def _labelled(name: str) -> str:
    return f"(SELECT * REPLACE ('frame_x:' || scope AS scope) FROM {name})"


@query("det5_run_detector", ["raw_cost", "job_cost", "run_status"], SERIES + L1_SQL.removeprefix(SERIES) + CUSUM_SQL + JOB_DAYS.replace("h AS", "jh AS").replace("FROM h)", "FROM jh)").replace("m AS", "jm AS").replace("FROM m)", "FROM jm)").replace(" z AS", " jz AS").replace("FROM z ", "FROM jz ") + TEAM_DAYS + ATTRIBUTION_SQL
  + f" SELECT * FROM ({alert_sql(_labelled('l1'), 'L1_interval', chr(39) + 'daily_cost' + chr(39))} UNION ALL {alert_sql(_labelled('l15'), 'L1.5_cusum', chr(39) + 'residual_drift' + chr(39))} UNION ALL {alert_sql('l2', 'L2_job', L2_METRIC, L2_SEVERITY)} UNION ALL {alert_sql('un', 'attribution', chr(39) + 'unknown_pct' + chr(39))}) WHERE run_date >= DATE '{SINCE}'")
def _(t):
    return rounded(detector.run_detector({"frame_x": (series_ledger(t), ["subscription_id"])}, t["job_cost"], frames.team_days(t, ERAS), DETECT, score_from=SINCE).drop("message"))


for _name in ("det2_cusum", "det2_cusum_alerts", "det5_run_detector"):
    ORACLE_SQL[_name] = ORACLE_SQL[_name].replace("WITH ", "WITH RECURSIVE ", 1)

for _name in sqlpack.PACK:
    QUERIES[_name] = sqlpack.query(_name)
    ORACLE_SQL[_name] = sqlpack.oracle_for(_name)
