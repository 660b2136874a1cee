"""The diagnostic SQL pack: 36 questions about a bill, as text that Spark and DuckDB both run.

Days and names are parameters with defaults for the driver's tables. Money is rounded as DECIMAL, never as DOUBLE (the
engines round doubles differently), and leaves as DOUBLE; reports cut to a number of rows break ties by all keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .lens import TABLES, lens, oracle

PARAMS = {
    "day": "1998-01-05",
    "from_day": "1998-01-01",
    "recent": "2000-06-01",
    "before": "1998-09-15",
    "break": "1998-12-15",
    "after": "1999-03-15",
    "zoom_lo": "1998-11-25",
    "zoom_hi": "1999-01-15",
    "team": "team-1",
    "job": "Brand#12",
    "sub": "sub-1",
    "service": "Virtual Machines",
    "vm": "microsoft.compute/virtualmachines",
}
POOL_DAY = "run_date, subscription_id, batch_account_name, pool_name"
GRAIN = "run_date, subscription_id, resource_group_name, resource_type, meter, batch_account_name, pool_name"


def money(x: str, digits: int = 2) -> str:
    return f"cast(round(cast({x} AS decimal(38, 6)), {digits}) AS double)"


def ratio(a: str, b: str, digits: int = 4, times: str = "") -> str:
    return money(f"({times}cast({a} AS double) / nullif(cast({b} AS double), 0))", digits)


def month(d: str = "run_date") -> str:
    return f"make_date(year({d}), month({d}), 1)"


_RAW_DAY = f"SELECT {POOL_DAY}, sum(pre_tax_cost) AS raw_cost FROM <raw_cost> WHERE pool_name IS NOT NULL GROUP BY {POOL_DAY}"
_JOB_DAY = f"SELECT {POOL_DAY}, sum(cost) AS job_cost FROM <job_cost> WHERE pool_name IS NOT NULL GROUP BY {POOL_DAY}"
_ON = " AND ".join(f"r.{k} = j.{k}" for k in POOL_DAY.split(", "))
_WRITES = f"SELECT {GRAIN}, update_time, sum(cost) AS at_write FROM <raw_cost> GROUP BY {GRAIN}, update_time"
_CHANGED = f"SELECT run_date, max(at_write) - min(at_write) AS moved FROM ({_WRITES}) w GROUP BY {GRAIN} HAVING count(DISTINCT at_write) > 1"
_UNKNOWN = "sum(cost) FILTER (WHERE job_team = 'Unknown')"
_SHARE = ratio(f"coalesce({_UNKNOWN}, 0)", "sum(cost)", 1, "100 * ")
_ZERO_DAYS = f"""SELECT environment_tier, count(*) AS sub_days, count(*) FILTER (WHERE day_cost = 0) AS zero_days,
  {ratio('count(*) FILTER (WHERE day_cost = 0)', 'count(*)', 2, '100 * ')} AS pct_zero_days
  FROM (SELECT subscription_id, run_date, sum(pre_tax_cost) AS day_cost FROM <raw_cost> WHERE pool_name IS NOT NULL AND run_date >= DATE '<from_day>' GROUP BY subscription_id, run_date) d
  JOIN <environment_config> e USING (subscription_id) GROUP BY environment_tier"""
_VM = "pool_name IS NULL AND service_name = '<service>' AND resource_type = '<vm>'"

PACK = {
    # every pool once with its presence on either side; without an account none is the same pool
    "s01_pool_overlap": """SELECT count_if(billed AND worked) AS in_both, count_if(NOT worked) AS raw_only, count_if(NOT billed) AS job_only
      FROM (SELECT bool_or(side = 'raw') AS billed, bool_or(side = 'job') AS worked FROM (
        SELECT 'raw' AS side, subscription_id, batch_account_name, pool_name, run_date FROM <raw_cost> UNION ALL SELECT 'job', subscription_id, batch_account_name, pool_name, run_date FROM <job_cost>) u
        WHERE run_date = DATE '<day>' AND pool_name IS NOT NULL
        GROUP BY subscription_id, batch_account_name, pool_name, CASE WHEN subscription_id IS NULL OR batch_account_name IS NULL THEN side END) p""",
    "s02_shared_pool_days": f"""SELECT count(*) AS shared_pool_days, {money('avg(rel)', 4)} AS mean_rel_diff,
      {money('percentile_cont(0.5) WITHIN GROUP (ORDER BY rel)', 4)} AS median_rel_diff, {money('min(rel)', 4)} AS min_rel_diff, {money('max(rel)', 4)} AS max_rel_diff,
      count(*) FILTER (WHERE job_cost > raw_cost) AS days_job_exceeds_raw, count(*) FILTER (WHERE job_cost = 0) AS days_job_zero,
      {money('sum(job_cost)')} AS total_job_cost, {money('sum(raw_cost)')} AS total_raw_cost, {ratio('sum(job_cost)', 'sum(raw_cost)')} AS agg_ratio
      FROM (SELECT raw_cost, job_cost, cast(job_cost - raw_cost AS double) / nullif(cast(raw_cost AS double), 0) AS rel FROM ({_RAW_DAY}) r JOIN ({_JOB_DAY}) j ON {_ON}) x""",
    "s03_idle_by_month": f"""SELECT {month()} AS month, count(*) AS pool_days, count(*) FILTER (WHERE no_job) AS idle_pool_days, {money('sum(raw_cost)')} AS total_cost,
      {money('sum(raw_cost - job_cost)')} AS idle_cost, {ratio('sum(raw_cost - job_cost)', 'sum(raw_cost)', 1, '100 * ')} AS idle_pct
      FROM (SELECT r.run_date, raw_cost, coalesce(job_cost, 0) AS job_cost, j.pool_name IS NULL AS no_job FROM ({_RAW_DAY}) r LEFT JOIN ({_JOB_DAY}) j ON {_ON}) x GROUP BY {month()}""",
    "s04_residual_grain": "SELECT run_date, subscription_id, count(*) AS n FROM <raw_cost> WHERE pool_name IS NULL GROUP BY run_date, subscription_id HAVING count(*) > 1 ORDER BY n DESC, run_date, subscription_id LIMIT 20",
    "s05_partition_by_branch": f"SELECT CASE WHEN pool_name IS NULL THEN 'non_pool' ELSE 'pool' END AS branch, count(*) AS n, {money('sum(cost)')} AS total_cost, min(run_date) AS first_date, max(run_date) AS last_date FROM <raw_cost> GROUP BY CASE WHEN pool_name IS NULL THEN 'non_pool' ELSE 'pool' END",
    # the literal mode: a pool-day's job cost counts once for each of its billing lines
    "s06_three_series": f"""SELECT {month()} AS month, {money('sum(attributed)')} AS attributed_pool_cost, {money('sum(billed - attributed)')} AS idle_cost, {money('max(residual)')} AS residual_cost
      FROM (SELECT run_date, billed, coalesce(lines * worked, 0) AS attributed, max(loose) OVER (PARTITION BY run_date) AS residual, pool_name FROM (
        SELECT run_date, pool_name, sum(line) AS lines, sum(raw) AS billed, sum(job) AS worked, CASE WHEN pool_name IS NULL THEN sum(raw) END AS loose FROM (
          SELECT run_date, pool_name, 1 AS line, cost AS raw, NULL AS job FROM <raw_cost> UNION ALL SELECT run_date, pool_name, 0, NULL, cost FROM <job_cost>) u GROUP BY run_date, pool_name) g) d
      WHERE pool_name IS NOT NULL AND billed IS NOT NULL GROUP BY {month()}""",
    "s06_three_series_exact": f"""SELECT {month('r.run_date')} AS month, {money('sum(coalesce(job_cost, 0))')} AS attributed_pool_cost, {money('sum(raw_cost - coalesce(job_cost, 0))')} AS idle_cost
      FROM ({_RAW_DAY}) r LEFT JOIN ({_JOB_DAY}) j ON {_ON} GROUP BY {month('r.run_date')}""",
    "s07_daily_residual": f"SELECT run_date, count(*) AS n, {money('sum(pre_tax_cost)')} AS residual_cost FROM <raw_cost> WHERE pool_name IS NULL AND run_date >= DATE '<from_day>' GROUP BY run_date",
    "s08_daily_residual_by_subscription": f"SELECT run_date, subscription_id, {money('sum(pre_tax_cost)')} AS residual_cost FROM <raw_cost> WHERE pool_name IS NULL AND run_date >= DATE '<from_day>' GROUP BY run_date, subscription_id",
    "s09_residual_by_category": f"SELECT meter_category, n, {money('c')} AS total_cost, {ratio('c', 'sum(c) OVER ()', 1, '100 * ')} AS pct_of_residual FROM (SELECT meter_category, count(*) AS n, sum(pre_tax_cost) AS c FROM <raw_cost> WHERE pool_name IS NULL AND run_date >= DATE '<from_day>' GROUP BY meter_category) x ORDER BY total_cost DESC, meter_category LIMIT 20",
    "s10_before_after": f"""SELECT service_name, meter_category, resource_type, rows_before, rows_after, {money('before')} AS cost_before, {money('after')} AS cost_after, {money('after - before')} AS cost_delta,
      CASE WHEN rows_before = 0 THEN 'APPEARED' WHEN rows_after = 0 THEN 'DISAPPEARED' ELSE 'both' END AS status
      FROM (SELECT service_name, meter_category, resource_type, count_if(NOT late) AS rows_before, count_if(late) AS rows_after, sum(CASE WHEN late THEN 0 ELSE pre_tax_cost END) AS before, sum(CASE WHEN late THEN pre_tax_cost ELSE 0 END) AS after
        FROM (SELECT *, run_date >= DATE '<break>' AS late FROM <raw_cost> WHERE pool_name IS NULL AND run_date >= DATE '<before>' AND run_date < DATE '<after>') r GROUP BY service_name, meter_category, resource_type) x
      ORDER BY abs(after - before) DESC, service_name, meter_category, resource_type LIMIT 40""",
    "s11_daily_service": f"SELECT run_date, count(*) AS n, {money('sum(pre_tax_cost)')} AS cost FROM <raw_cost> WHERE pool_name IS NULL AND service_name = '<service>' AND run_date BETWEEN DATE '<zoom_lo>' AND DATE '<zoom_hi>' GROUP BY run_date",
    "s12_effective_price": f"SELECT CASE WHEN run_date < DATE '<break>' THEN 'before' ELSE 'after' END AS win, count(*) AS n, {money('sum(pre_tax_cost)')} AS cost, {money('sum(usage_quantity)')} AS usage_total, {ratio('sum(pre_tax_cost)', 'sum(usage_quantity)', 6)} AS eff_price FROM <raw_cost> WHERE {_VM} AND run_date >= DATE '<before>' AND run_date < DATE '<after>' GROUP BY CASE WHEN run_date < DATE '<break>' THEN 'before' ELSE 'after' END",
    "s13_daily_vm": f"SELECT run_date, count(*) AS n, {money('sum(pre_tax_cost)')} AS cost FROM <raw_cost> WHERE {_VM} AND run_date BETWEEN DATE '<zoom_lo>' AND DATE '<zoom_hi>' GROUP BY run_date",
    "s14_orphan_residual_days": f"SELECT n.run_date, {money('residual')} AS orphan_residual FROM (SELECT run_date, sum(pre_tax_cost) AS residual FROM <raw_cost> WHERE pool_name IS NULL GROUP BY run_date) n LEFT JOIN (SELECT DISTINCT run_date FROM <raw_cost> WHERE pool_name IS NOT NULL) p ON p.run_date = n.run_date WHERE p.run_date IS NULL",
    "s15_negative_idle": f"""SELECT count(*) AS negative_idle_pool_days, {money('sum(raw_pool - attributed)')} AS total_negative FROM (SELECT r.run_date, r.pool_name, raw_pool, coalesce(a, 0) AS attributed
      FROM (SELECT run_date, pool_name, sum(pre_tax_cost) AS raw_pool FROM <raw_cost> WHERE pool_name IS NOT NULL GROUP BY run_date, pool_name) r
      LEFT JOIN (SELECT run_date, pool_name, sum(cost) AS a FROM <job_cost> GROUP BY run_date, pool_name) j ON j.run_date = r.run_date AND j.pool_name = r.pool_name) x WHERE raw_pool - attributed < -0.005""",
    "s16_unknown_by_month": f"SELECT {month()} AS month, {money(f'coalesce({_UNKNOWN}, 0)')} AS unknown_cost, {money('sum(cost)')} AS total_cost, {_SHARE} AS unknown_pct FROM <job_cost> WHERE run_date >= DATE '<from_day>' GROUP BY {month()}",
    "s17_team_first_seen": "SELECT min(run_date) AS first_seen, count(DISTINCT job_name) AS distinct_jobs, min(run_date) FILTER (WHERE run_date < DATE '<from_day>') AS any_earlier FROM <job_cost> WHERE job_team = '<team>'",
    "s18_team_jobs": "SELECT job_name, min(run_date) AS first_seen, count(DISTINCT run_date) AS days FROM <job_cost> WHERE job_team = '<team>' GROUP BY job_name",
    "s19_unknown_by_day": f"SELECT run_date, {money(f'coalesce({_UNKNOWN}, 0)')} AS unknown_cost, {_SHARE} AS unknown_pct FROM <job_cost> WHERE run_date BETWEEN DATE '<before>' AND DATE '<after>' GROUP BY run_date",
    "s20_unknown_jobs": f"SELECT job_name, count(DISTINCT run_date) AS days, min(run_date) AS first_seen, {money('sum(cost)')} AS total_cost FROM <job_cost> WHERE job_team = 'Unknown' AND run_date >= DATE '<recent>' GROUP BY job_name ORDER BY total_cost DESC, job_name LIMIT 20",
    "s21_job_teams": "SELECT job_team, min(run_date) AS first_seen, max(run_date) AS last_seen, count(DISTINCT run_date) AS days FROM <job_cost> WHERE job_name = '<job>' GROUP BY job_team",
    "s22_bad_days_status": f"SELECT b.run_date, {money('unk_pct', 1)} AS unk_pct, s.subscription_id, s.run_type, s.status FROM (SELECT run_date, 100 * cast(coalesce({_UNKNOWN}, 0) AS double) / nullif(cast(sum(cost) AS double), 0) AS unk_pct FROM <job_cost> WHERE run_date >= DATE '<from_day>' GROUP BY run_date) b LEFT JOIN <run_status> s ON s.run_date = b.run_date WHERE unk_pct > 40",
    "s23_rewritten_days": f"SELECT run_date, count(DISTINCT update_time) AS writes, {money('sum(pre_tax_cost)')} AS final_cost FROM <raw_cost> WHERE run_date >= DATE '<from_day>' GROUP BY run_date HAVING count(DISTINCT update_time) > 1 ORDER BY writes DESC, run_date LIMIT 20",
    "s24_writes_by_subscription_day": "SELECT run_date, subscription_id, count(DISTINCT update_time) AS writes FROM <raw_cost> WHERE run_date >= DATE '<recent>' GROUP BY run_date, subscription_id ORDER BY writes DESC, run_date, subscription_id LIMIT 20",
    "s25_subscriptions": "SELECT count(DISTINCT subscription_id) AS n_subscriptions FROM <raw_cost> WHERE run_date >= DATE '<recent>'",
    "s26_rewritten_rows": f"""SELECT {GRAIN}, count(DISTINCT update_time) AS writes, count(DISTINCT at_write) AS distinct_cost_values, cast(min(at_write) AS double) AS min_cost, cast(max(at_write) AS double) AS max_cost, cast(max(at_write) - min(at_write) AS double) AS cost_delta
      FROM ({_WRITES}) w GROUP BY {GRAIN} HAVING count(DISTINCT update_time) > 1 ORDER BY cost_delta DESC, {GRAIN} LIMIT 100""",
    "s27_rewritten_by_month_abs": f"SELECT {month()} AS run_month, count(*) AS rows_rewritten, {money('sum(abs(moved))', 4)} AS total_abs_cost_moved FROM ({_CHANGED}) c GROUP BY {month()}",
    "s28_rewritten_by_month": f"SELECT {month()} AS run_month, count(*) AS rows_rewritten, {money('sum(moved)')} AS total_cost_moved FROM ({_CHANGED}) c GROUP BY {month()}",
    "s29_branch_totals": f"SELECT CASE WHEN pool_name IS NULL THEN 'non_pool' ELSE 'pool' END AS branch, count(*) AS n, {money('sum(pre_tax_cost)')} AS branch_cost FROM <raw_cost> GROUP BY CASE WHEN pool_name IS NULL THEN 'non_pool' ELSE 'pool' END UNION ALL SELECT 'GRAND_TOTAL', count(*), {money('sum(pre_tax_cost)')} FROM <raw_cost>",
    "s30_grand_total": f"SELECT {money('sum(pre_tax_cost)')} AS grand_total, count(*) AS n, min(run_date) AS first_date, max(run_date) AS last_date FROM <raw_cost>",
    "s31_suspect_rows": f"SELECT pool_name IS NULL AS pool_null, batch_account_name IS NULL AS batch_null, resource_type, count(*) AS n, {money('sum(pre_tax_cost)')} AS total_cost FROM <raw_cost> GROUP BY pool_name IS NULL, batch_account_name IS NULL, resource_type HAVING abs(sum(pre_tax_cost)) > 1000",
    "s32_pool_without_account": f"SELECT count(*) AS n, {money('sum(pre_tax_cost)')} AS dropped_cost FROM <raw_cost> WHERE pool_name IS NOT NULL AND batch_account_name IS NULL",
    "s33_tiers": "SELECT subscription_id, environment_tier FROM <environment_config> WHERE subscription_id IN ('sub-1', 'sub-2', 'sub-3')",
    "s34_cost_per_job_second": f"""SELECT run_date, {money('day_cost')} AS day_cost, cast(task_count AS bigint) AS task_count, job_seconds, {ratio('day_cost', 'job_seconds', 6)} AS cost_per_job_second
      FROM (SELECT run_date, sum(pre_tax_cost) AS day_cost FROM <raw_cost> WHERE subscription_id = '<sub>' AND pool_name IS NOT NULL AND run_date BETWEEN DATE '<zoom_lo>' AND DATE '<zoom_hi>' GROUP BY run_date) r
      LEFT JOIN (SELECT run_date, sum(task_count) AS task_count, sum(job_seconds) AS job_seconds FROM <job_usage> WHERE subscription_id = '<sub>' AND run_date BETWEEN DATE '<zoom_lo>' AND DATE '<zoom_hi>' GROUP BY run_date) a USING (run_date)""",
    "s35_zero_days_by_tier": _ZERO_DAYS,
    "s36_cost_by_tier_and_priority": f"SELECT environment_tier, low_priority_type, count(*) AS n, {money('sum(pre_tax_cost)')} AS total_cost FROM <raw_cost> r JOIN <environment_config> e USING (subscription_id) WHERE pool_name IS NOT NULL AND run_date >= DATE '<from_day>' GROUP BY environment_tier, low_priority_type",
}


_K = "run_date, subscription_id, batch_account_name, pool_name"
_SIDES = f"(SELECT {_K}, pre_tax_cost AS r0, NULL AS j0 FROM raw_cost UNION ALL SELECT {_K}, NULL, cost FROM job_cost)"
_BOTH = f"(SELECT {_K}, sum(r0) AS rc, CASE WHEN batch_account_name IS NOT NULL THEN sum(j0) END AS jc FROM {_SIDES} WHERE pool_name IS NOT NULL GROUP BY {_K} HAVING count(r0) > 0)"
_R2 = lambda x, n=2: f"cast(round(cast({x} AS decimal(38, 6)), {n}) AS double)"
_AT = f"(SELECT DISTINCT {GRAIN}, sum(cost) OVER (PARTITION BY {GRAIN}, update_time) AS c, update_time AS u FROM raw_cost)"
_ROWS = f"(SELECT {GRAIN}, len(list_distinct(list(u))) AS writes, len(list_distinct(list(c))) AS vals, list_min(list(c)) AS lo, list_max(list(c)) AS hi FROM {_AT} GROUP BY ALL)"
#: DuckDB texts of their own for questions whose answer hangs on how tables meet: by one grouped union, correlated
#: subqueries, window functions or lists, where the pack joins and aggregates, or the other way round.
ORACLES = {
    "s01_pool_overlap": """, r AS (SELECT DISTINCT subscription_id AS s, batch_account_name AS b, pool_name AS p FROM raw_cost WHERE run_date = DATE '<day>' AND pool_name IS NOT NULL),
      j AS (SELECT DISTINCT subscription_id AS s, batch_account_name AS b, pool_name AS p FROM job_cost WHERE run_date = DATE '<day>' AND pool_name IS NOT NULL),
      k AS (SELECT count(*) AS n FROM r WHERE EXISTS (SELECT 1 FROM j WHERE j.s = r.s AND j.b = r.b AND j.p = r.p))
      SELECT (SELECT n FROM k) AS in_both, (SELECT count(*) FROM r) - (SELECT n FROM k) AS raw_only, (SELECT count(*) FROM j) - (SELECT n FROM k) AS job_only""",
    "s02_shared_pool_days": f""", b AS (SELECT rc, jc, cast(jc - rc AS double) / nullif(cast(rc AS double), 0) AS rel FROM {_BOTH} WHERE jc IS NOT NULL)
      SELECT count(*) AS shared_pool_days, {_R2('avg(rel)', 4)} AS mean_rel_diff, {_R2('median(rel)', 4)} AS median_rel_diff, {_R2('min(rel)', 4)} AS min_rel_diff, {_R2('max(rel)', 4)} AS max_rel_diff, count_if(jc > rc) AS days_job_exceeds_raw, count_if(jc = 0) AS days_job_zero,
      {_R2('sum(jc)')} AS total_job_cost, {_R2('sum(rc)')} AS total_raw_cost, {_R2('cast(sum(jc) AS double) / nullif(cast(sum(rc) AS double), 0)', 4)} AS agg_ratio FROM b""",
    "s03_idle_by_month": f""" SELECT cast(date_trunc('month', run_date) AS date) AS month, count(*) AS pool_days, count_if(jc IS NULL) AS idle_pool_days, {_R2('sum(rc)')} AS total_cost, {_R2('sum(rc) - coalesce(sum(jc), 0)')} AS idle_cost,
      {_R2('100 * cast(sum(rc) - coalesce(sum(jc), 0) AS double) / nullif(cast(sum(rc) AS double), 0)', 1)} AS idle_pct FROM {_BOTH} GROUP BY 1""",
    "s06_three_series": f""", l AS (SELECT run_date, cost, coalesce((SELECT sum(j.cost) FROM job_cost j WHERE j.run_date = r.run_date AND j.pool_name = r.pool_name), 0) AS w FROM raw_cost r WHERE pool_name IS NOT NULL),
      n AS (SELECT run_date, sum(cost) AS c FROM raw_cost WHERE pool_name IS NULL GROUP BY 1)
      SELECT cast(date_trunc('month', run_date) AS date) AS month, {_R2('sum(w)')} AS attributed_pool_cost, {_R2('sum(cost) - sum(w)')} AS idle_cost, {_R2('max(n.c)')} AS residual_cost FROM l LEFT JOIN n USING (run_date) GROUP BY 1""",
    "s06_three_series_exact": f" SELECT cast(date_trunc('month', run_date) AS date) AS month, {_R2('coalesce(sum(jc), 0)')} AS attributed_pool_cost, {_R2('sum(rc) - coalesce(sum(jc), 0)')} AS idle_cost FROM {_BOTH} GROUP BY 1",
    "s09_residual_by_category": f""", c AS (SELECT meter_category, count(*) AS n, sum(pre_tax_cost) AS c FROM raw_cost WHERE pool_name IS NULL AND run_date >= DATE '<from_day>' GROUP BY 1)
      SELECT meter_category, n, {_R2('c')} AS total_cost, {_R2('100 * cast(c AS double) / nullif(cast((SELECT sum(c) FROM c) AS double), 0)', 1)} AS pct_of_residual FROM c QUALIFY row_number() OVER (ORDER BY total_cost DESC, meter_category) <= 20""",
    "s10_before_after": f""", w AS (SELECT service_name, meter_category, resource_type, CASE WHEN run_date < DATE '<break>' THEN 0 ELSE 1 END AS side, count(*) AS n, sum(pre_tax_cost) AS c FROM raw_cost WHERE pool_name IS NULL AND run_date BETWEEN DATE '<before>' AND DATE '<after>' - 1 GROUP BY ALL),
      q AS (SELECT coalesce(b.service_name, a.service_name) AS service_name, coalesce(b.meter_category, a.meter_category) AS meter_category, coalesce(b.resource_type, a.resource_type) AS resource_type, coalesce(b.n, 0) AS rows_before, coalesce(a.n, 0) AS rows_after, coalesce(b.c, 0) AS cb, coalesce(a.c, 0) AS ca
        FROM (SELECT * FROM w WHERE side = 0) b FULL JOIN (SELECT * FROM w WHERE side = 1) a ON a.service_name IS NOT DISTINCT FROM b.service_name AND a.meter_category IS NOT DISTINCT FROM b.meter_category AND a.resource_type IS NOT DISTINCT FROM b.resource_type)
      SELECT service_name, meter_category, resource_type, rows_before, rows_after, {_R2('cb')} AS cost_before, {_R2('ca')} AS cost_after, {_R2('ca - cb')} AS cost_delta, CASE WHEN rows_before = 0 THEN 'APPEARED' WHEN rows_after = 0 THEN 'DISAPPEARED' ELSE 'both' END AS status
      FROM q QUALIFY row_number() OVER (ORDER BY abs(ca - cb) DESC, service_name, meter_category, resource_type) <= 40""",
    "s14_orphan_residual_days": f" SELECT run_date, {_R2('sum(pre_tax_cost)')} AS orphan_residual FROM raw_cost GROUP BY 1 HAVING count(pool_name) = 0",
    "s15_negative_idle": f""", d AS (SELECT run_date, pool_name, sum(r0) AS rc, coalesce(sum(j0), 0) AS jc FROM {_SIDES} WHERE pool_name IS NOT NULL GROUP BY run_date, pool_name HAVING count(r0) > 0)
      SELECT count(*) AS negative_idle_pool_days, {_R2('sum(rc - jc)')} AS total_negative FROM d WHERE rc - jc < -0.005""",
    "s22_bad_days_status": f""", b AS (SELECT DISTINCT run_date, 100 * cast(sum(CASE WHEN job_team = 'Unknown' THEN cost ELSE 0 END) OVER w AS double) / nullif(cast(sum(cost) OVER w AS double), 0) AS pct FROM job_cost WHERE run_date >= DATE '<from_day>' WINDOW w AS (PARTITION BY run_date))
      SELECT run_date, {_R2('pct', 1)} AS unk_pct, subscription_id, run_type, status FROM b LEFT JOIN run_status USING (run_date) WHERE pct > 40""",
    "s26_rewritten_rows": f""" SELECT {GRAIN}, writes, vals AS distinct_cost_values, cast(lo AS double) AS min_cost, cast(hi AS double) AS max_cost, cast(hi - lo AS double) AS cost_delta FROM {_ROWS} WHERE writes > 1 QUALIFY row_number() OVER (ORDER BY cost_delta DESC, {GRAIN}) <= 100""",
    "s27_rewritten_by_month_abs": f" SELECT cast(date_trunc('month', run_date) AS date) AS run_month, count(*) AS rows_rewritten, {_R2('sum(abs(hi - lo))', 4)} AS total_abs_cost_moved FROM {_ROWS} WHERE vals > 1 GROUP BY 1",
    "s28_rewritten_by_month": f" SELECT cast(date_trunc('month', run_date) AS date) AS run_month, count(*) AS rows_rewritten, {_R2('sum(hi - lo)')} AS total_cost_moved FROM {_ROWS} WHERE vals > 1 GROUP BY 1",
    "s29_branch_totals": f" SELECT coalesce(branch, 'GRAND_TOTAL') AS branch, count(*) AS n, {_R2('sum(pre_tax_cost)')} AS branch_cost FROM (SELECT CASE WHEN pool_name IS NULL THEN 'non_pool' ELSE 'pool' END AS branch, pre_tax_cost FROM raw_cost) GROUP BY ROLLUP (branch)",
    "s34_cost_per_job_second": f""", r AS (SELECT DISTINCT run_date AS d FROM raw_cost WHERE subscription_id = '<sub>' AND pool_name IS NOT NULL AND run_date BETWEEN DATE '<zoom_lo>' AND DATE '<zoom_hi>'),
      x AS (SELECT d, (SELECT sum(pre_tax_cost) FROM raw_cost WHERE run_date = d AND subscription_id = '<sub>' AND pool_name IS NOT NULL) AS c, (SELECT sum(task_count) FROM job_usage WHERE run_date = d AND subscription_id = '<sub>') AS t, (SELECT sum(job_seconds) FROM job_usage WHERE run_date = d AND subscription_id = '<sub>') AS s FROM r)
      SELECT d AS run_date, {_R2('c')} AS day_cost, cast(t AS bigint) AS task_count, s AS job_seconds, {_R2('cast(c AS double) / nullif(cast(s AS double), 0)', 6)} AS cost_per_job_second FROM x""",
    "s35_zero_days_by_tier": f""", d AS (SELECT DISTINCT subscription_id, run_date, sum(pre_tax_cost) OVER (PARTITION BY subscription_id, run_date) = 0 AS zero FROM raw_cost WHERE pool_name IS NOT NULL AND run_date >= DATE '<from_day>')
      SELECT environment_tier, count(*) AS sub_days, count_if(zero) AS zero_days, {_R2('100 * cast(count_if(zero) AS double) / nullif(cast(count(*) AS double), 0)')} AS pct_zero_days FROM environment_config JOIN d USING (subscription_id) GROUP BY 1""",
}


def text(name: str, table=lambda t: t, params: dict[str, str] | None = None) -> str:
    return _filled(PACK[name], table, params)


def _filled(out: str, table=lambda t: t, params: dict[str, str] | None = None) -> str:
    for k, v in (PARAMS | (params or {})).items():
        out = out.replace(f"<{k}>", v)
    for t in TABLES:
        out = out.replace(f"<{t}>", table(t))
    return out


def used(name: str) -> list[str]:
    return [t for t in TABLES if f"<{t}>" in PACK[name]]


def run(spark: SparkSession, tables: dict[str, DataFrame], name: str, params: dict[str, str] | None = None) -> DataFrame:
    return spark.sql(text(name, lambda t: "{" + t + "}", params), **{t: tables[t] for t in used(name)})


def query(name: str):
    return lambda spark, sf_dir: run(spark, lens(spark, sf_dir, used(name)), name)


def oracle_for(name: str) -> str:
    """DuckDB SQL: a text of its own if there is one, else the question's (a single grouped scan)."""
    return oracle(used(name), _filled(ORACLES[name]) if name in ORACLES else text(name))
