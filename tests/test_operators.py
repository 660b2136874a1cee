"""Small cases with answers worked out by hand."""

import datetime as dt
import hashlib
import math
import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from costloom.config import DetectorConfig, Eras, Frame, FrameSpec
from costloom.errors import BacktestError, DataQualityError
from costloom.functions import scalars
from costloom.operators import baselines, calibrate, checks, decompose, detector, factory, features, gate, joins, metrics, ranks

D = date


def days(start, n):
    return [start + dt.timedelta(days=i) for i in range(n)]


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()]


def one(spark, exprs):
    return spark.range(1).select(*(e.alias(str(i)) for i, e in enumerate(exprs))).first()


# Labels and calendar.


def test_regimes(spark):
    d = [D(2022, 1, 1), D(2022, 8, 1), D(2023, 8, 1), D(2024, 1, 2)]
    df = spark.createDataFrame([(x,) for x in d], "run_date date").orderBy("run_date")
    assert rows(gate.stamp_regime(df, Eras()), "data_regime") == ["pre_coverage", "cost_only", "featured_ungated", "featured_gated"]
    assert gate.drop_pre_coverage(gate.stamp_regime(df, Eras())).count() == 3


@pytest.mark.parametrize("d,want", [(D(2025, 12, 31), (2, 31, 12, 0, 0, False)), (D(2025, 12, 3), (2, 3, 12, 28, 28, False)), (D(2025, 11, 30), (6, 30, 11, 0, 31, True))])
def test_calendar(spark, d, want):
    r = scalars.add_calendar(spark.createDataFrame([(d,)], "run_date date")).first()
    assert tuple(r)[1:] == want


def test_region_and_segment(spark):
    df = spark.createDataFrame([("x-NEU-1",), ("a-weu",), ("neu-weu",), ("zz",), (None,)], "n string")
    assert rows(df.select(scalars.region("n").alias("r")), "r") == ["northeurope", "westeurope", "westeurope", "unknown", "unknown"]
    df = spark.createDataFrame([("microsoft.compute/virtualMachineScaleSets", None, None), (None, "Virtual Machines", None), (None, None, None), ("microsoft.storage/x", "Storage", "Storage")], "resource_type string, meter_category string, service_name string")
    assert rows(df.select(scalars.segment().alias("s")), "s") == ["vm_compute", "vm_compute", "platform", "platform"]


@pytest.mark.parametrize("score,impact,want", [(2.0, None, "high"), (0.3, None, "medium"), (0.1, 9e9, "low"), (2.0, 49.0, "low"), (2.0, 499.0, "medium"), (2.0, 500.0, "high")])
def test_severity(spark, score, impact, want):
    assert one(spark, [scalars.severity(F.lit(score), F.lit(impact).cast("double"))])[0] == want


def test_history_demand():
    f = ["cost_lag7", "cost_roll28", "price_drift_lag1", "price_drift_lag7"]
    assert [scalars.history_days(x) for x in f] == [7, 29, 42, 48]
    assert scalars.min_history_days(f[:3]) == 42 and scalars.min_history_days(f[:3], 30) == 71
    assert scalars.recommended_pull_days(f[:3]) == 115


def test_month_starts():
    assert scalars.month_starts(D(2021, 11, 5), D(2022, 2, 1)) == [D(2021, 11, 1), D(2021, 12, 1), D(2022, 1, 1), D(2022, 2, 1)]
    assert scalars.window_start(10, D(2024, 1, 5)) == D(2023, 12, 26)


def test_coerced(spark):
    df = scalars.coerced(spark.createDataFrame([("2024-01-01", "bad"), ("x", "2024-01-01 10:00:00")], "run_date string, update_time string"))
    assert [(r.run_date is None, r.update_time is None) for r in df.collect()] == [(False, True), (True, False)]


# Gate.

STATUS = "run_date date, subscription_id string, run_type string, status string, update_time timestamp"


def status(day, sub, **kinds):
    return [(day, sub, k, s, datetime(2024, 1, 1, 10)) for k, s in kinds.items()]


def test_gate_takes_the_latest_load(spark):
    d = D(2024, 2, 1)
    log = [*status(d, "s", Usage="Complete", Attribution="Complete"), (d, "s", "Cost", "Error", datetime(2024, 2, 1, 8)), (d, "s", "Cost", "Complete", datetime(2024, 2, 1, 10)), *status(d, "t", Cost="Complete", Usage="Complete")]
    got = dict(rows(gate.build_gate(spark.createDataFrame(log, STATUS)), "subscription_id", "gate_complete"))
    assert got == {"s": True, "t": False}


def test_gate_has_three_states(spark):
    era = D(2024, 1, 2)
    g = spark.createDataFrame([(D(2024, 1, 5), "s", True), (D(2024, 1, 6), "s", False), (D(2023, 12, 30), "s", False)], "run_date date, subscription_id string, gate_complete boolean")
    f = spark.createDataFrame([(x, "s") for x in (D(2024, 1, 5), D(2024, 1, 6), D(2024, 1, 7), D(2023, 12, 30), D(2023, 12, 31))], "run_date date, subscription_id string")
    out = gate.apply_gate(f, g, era)
    assert dict(rows(out, "run_date", "gate_state")) == {D(2024, 1, 5): "gated_complete", D(2023, 12, 31): "ungated"}
    checks.assert_gated(out, "t")
    with pytest.raises(DataQualityError):
        checks.assert_gated(f, "t")
    with pytest.raises(DataQualityError):
        checks.assert_gated(gate.gate_states(f, g, era), "t")


def test_tier_filter_keeps_unknown_tiers(spark):
    cfg = spark.createDataFrame([("p", "PROD"), ("d", " dev "), ("t", "TEST"), ("n", None)], "subscription_id string, environment_tier string")
    raw = spark.createDataFrame([("p", 100), ("d", 50), ("t", 25), ("n", 7), (None, 1)], "subscription_id string, c int")
    cal = spark.createDataFrame([(D(2024, 1, 1), True)], "run_date date, is_holiday boolean")
    out = gate.filter_tiers({"environment_config": cfg, "raw": raw, "cal": cal})
    assert out["raw"].agg(F.sum("c")).first()[0] == 108 and out["cal"].count() == 1
    assert gate.filter_tiers({"raw": raw})["raw"].count() == 5


RAW = "run_date date, subscription_id string, batch_account_name string, pool_name string, pre_tax_cost double"


def test_null_batch_account_is_a_group_and_the_branches_add_up(spark):
    d = D(2024, 1, 1)
    raw = spark.createDataFrame([(d, "s", "ba", "p", 100.0), (d, "s", None, "p", 17.5), (d, "s", None, None, 3.0)], RAW)
    from costloom.plans.frames import daily_pool_cost

    pool = daily_pool_cost(raw)
    assert pool.count() == 2 and pool.agg(F.sum("cost")).first()[0] == 117.5
    checks.assert_partition(raw, [gate.batch_slice(raw), gate.non_pool(raw)], "pre_tax_cost", "t")
    with pytest.raises(DataQualityError):
        checks.assert_partition(raw, [gate.batch_slice(raw)], "pre_tax_cost", "t")


# Joins.

KEYS = "run_date date, subscription_id string, batch_account_name string, pool_name string, job_id string"
K = (D(2024, 1, 1), "s", None, "p")


def test_five_key_join_marks_orphans_and_never_fans_out(spark):
    usage = spark.createDataFrame([(*K, "j1"), (*K, "j2"), (*K, "j3")], KEYS)
    cost = spark.createDataFrame([(*K, "j1", "a", "t1"), (*K, "j1", "a", "t1"), (*K, "j3", "b", None), (*K, "j9", "c", "t")], KEYS + ", job_name string, job_team string")
    got = {r.job_id: (r.job_name, r.job_team, r.usage_only) for r in joins.join_attributes(usage, cost).collect()}
    assert got == {"j1": ("a", "t1", False), "j2": ("Unknown", "Unknown", True), "j3": ("b", "Unknown", False)}
    with pytest.raises(DataQualityError):
        joins.join_attributes(usage.union(usage), cost)
    assert dict(rows(joins.provenance(usage, cost, ["job_id"], "u", "c"), "source", "n")) == {"both": 2, "u_only": 1, "c_only": 1}


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert checks.null_safe(a, b, ["k"], "inner").count() == 1 and checks.null_safe(a, b, ["k"], "full").count() == 3
    assert checks.null_safe(a, b, ["k"], "left_anti").count() == 1


def test_reconciliation(spark):
    raw = spark.createDataFrame([(d, "s", "b", "p", 100.0) for d in days(D(2024, 1, 1), 3)], RAW)
    job = spark.createDataFrame([(D(2024, 1, 1), "s", "b", "p", 100.0)], RAW.replace("pre_tax_cost", "cost"))
    s = joins.reconciliation_summary(joins.reconcile(raw, job)).first()
    assert (s.raw_only, s.both, s.job_only, s.verdict) == (2, 1, 0, "EXACT SUBSET") and abs(s.unattributed_share - 2 / 3) < 1e-9
    zero = joins.reconcile(raw.withColumn("pre_tax_cost", F.lit(0.0)), job).where("coverage = 'both'").first()
    assert zero.rel_diff is None and not zero.within_tol


def test_enrichment_counts_a_subscription_once(spark):
    cfg = spark.createDataFrame([("s", "x-neu", "PROD")] * 2, "subscription_id string, subscription_name string, environment_tier string")
    out = joins.enrich_environment(spark.createDataFrame([("s", 1), ("t", 2)], "subscription_id string, c int"), cfg)
    assert sorted(rows(out, "c", "region", "environment_tier"), key=str) == [(1, "northeurope", "PROD"), (2, "unknown", None)]


# Features.

JOBS = "run_date date, subscription_id string, batch_account_name string, pool_name string, job_id string, start_time timestamp, end_time timestamp, job_seconds double, task_count int, job_category string"


def jobs(spark, spans, sec=lambda a, b: 1.0):
    day = D(2024, 1, 1)
    return spark.createDataFrame([(day, "s", "b", "p", f"j{i}", datetime(2024, 1, 1, a) if a is not None else None, datetime(2024, 1, 1 + b // 24, b % 24) if b is not None else None, 1.0, 1, "x") for i, (a, b) in enumerate(spans)], JOBS)


@pytest.mark.parametrize("spans,peak", [([(9, 11), (10, 12)], 2), ([(9, 10), (10, 11)], 1), ([(9, 12), (9, 12), (10, 11)], 3)])
def test_sweep(spark, spans, peak):
    assert features.concurrency(jobs(spark, spans)).first().peak_concurrency == peak


def test_sweep_crosses_midnight_and_skips_open_jobs(spark):
    got = {r.run_date: (r.peak_concurrency, r.mean_concurrency) for r in features.concurrency(jobs(spark, [(9, 33), (5, None)])).collect()}
    assert got == {D(2024, 1, 1): (1, 1.0), D(2024, 1, 2): (0, 0.0)}


def test_mix(spark):
    base = (D(2024, 1, 1), "s", "b", "p")
    df = spark.createDataFrame([(*base, "A", 300.0), (*base, "b", 100.0)], "run_date date, subscription_id string, batch_account_name string, pool_name string, job_category string, job_seconds double")
    r = features.job_mix(df).first()
    assert (r.n_jobs, r.largest_job_share, r.share_A, r.share_b) == (2, 0.75, 0.75, 0.25)
    z = features.job_mix(df.withColumn("job_seconds", F.lit(0.0)), ["A", "C"]).first()
    assert (z.largest_job_share, z.share_A, z.share_C) == (0.0, 0.0, 0.0)
    out, novel = features.reindexed_shares(features.job_mix(df), ["share_A", "share_Z"])
    assert novel == ["share_b"] and out.first().share_Z == 0.0


def test_frozen_levels(spark):
    df = spark.createDataFrame([("a",)] * 19 + [("new",)], "c string")
    out, n = features.frozen_levels(df, {"c": ["a"]})
    assert n == {"c": 1} and out.where("c IS NULL").count() == 1
    with pytest.raises(DataQualityError):
        features.frozen_levels(df, {"c": ["b"]})


# Factory.

SERIES = "run_date date, subscription_id string, cost double"


def test_rolls_end_the_day_before(spark):
    df = spark.createDataFrame([(d, "s", c) for d, c in zip(days(D(2024, 1, 1), 3), (10.0, 20.0, 999.0))], SERIES)
    out = factory.add_rolling(df, ["subscription_id"], ["cost"], [2], stats=("mean", "max")).orderBy("run_date").collect()
    assert [r.cost_roll2 for r in out] == [None, None, 15.0] and out[2].cost_roll2_max == 20.0
    assert [r.cost_lag1 for r in factory.add_lags(df, ["subscription_id"], ["cost"], [1]).orderBy("run_date").collect()] == [None, 10.0, 20.0]


@pytest.mark.parametrize("state,want", [(True, 3), (False, 2), (None, 2)])
def test_padding_needs_a_complete_gate(spark, state, want):
    d = days(D(2024, 1, 1), 3)
    f = spark.createDataFrame([(d[0], "s", 5.0, "x"), (d[2], "s", 7.0, "x")], SERIES + ", note string")
    g = spark.createDataFrame([(d[1], "s", state)] if state is not None else [], "run_date date, subscription_id string, gate_complete boolean")
    out = factory.pad_daily(f, ["subscription_id"], ["cost"], gate=g).orderBy("run_date").collect()
    assert len(out) == want
    if want == 3:
        assert (out[1].cost, out[1].note, out[1].padded) == (0.0, None, True)
    assert factory.pad_daily(f, ["subscription_id"], ["cost"]).count() == 3


def test_drift(spark):
    line = "run_date date, subscription_id string, meter string, usage_quantity double, pre_tax_cost double"
    d = days(D(2024, 1, 1), 70)
    step = spark.createDataFrame([(x, "s", "m", 10.0, 10.0 if i < 50 else 5.0) for i, x in enumerate(d)], line)
    got = rows(factory.price_drift(step, ["subscription_id"]).orderBy("run_date"), "price_drift")
    assert got[-1] < -0.3
    flat = spark.createDataFrame([(x, "s", "m", 10.0, 10.0) for x in d], line)
    assert all(abs(v) < 1e-12 for v in rows(factory.price_drift(flat, ["subscription_id"]), "price_drift"))
    assert factory.price_drift(flat.limit(0), ["subscription_id"]).count() == 0


# Decomposition.


def periods(spark, a, b):
    return spark.createDataFrame([("a", m, c, u) for m, c, u in a] + [("b", m, c, u) for m, c, u in b], "p string, meter string, pre_tax_cost double, usage_quantity double")


@pytest.mark.parametrize("a,b,want", [([("m", 100.0, 500.0)], [("m", 125.0, 500.0)], (25, 0, 0)), ([("m", 100.0, 500.0)], [("m", 120.0, 600.0)], (0, 20, 0)), ([("m", 1.0, 1.0)], [("m", 1.0, 1.0), ("n", 40.0, 4.0)], (0, 0, 40))])
def test_effects(spark, a, b, want):
    it = decompose.decompose(periods(spark, a, b), F.col("p") == "a", F.col("p") == "b")
    decompose.assert_identity(it)
    s = decompose.summary(it).first()
    assert (s.price, s.usage, s.scope) == want


def test_effects_always_add_up(spark):
    rng = random.Random(1)
    made = lambda: [(f"m{i}" if i else None, rng.choice([0.0, rng.uniform(0, 100)]), rng.choice([0.0, rng.uniform(0, 50)])) for i in range(40) if rng.random() < 0.8]
    decompose.assert_identity(decompose.decompose(periods(spark, made(), made()), F.col("p") == "a", F.col("p") == "b"))


def test_day_against_its_baseline(spark):
    d = days(D(2024, 1, 1), 29)
    df = spark.createDataFrame([(x, "s", "m", 100.0 if i < 28 else 150.0, 10.0 if i < 28 else 15.0) for i, x in enumerate(d)], "run_date date, g string, meter string, pre_tax_cost double, usage_quantity double")
    s = decompose.summary(decompose.day_vs_baseline(df, d[-1], {"g": "s"})).first()
    assert (s.total_a, s.delta, s.usage, s.price) == (100.0, 50.0, 50.0, 0.0)
    with pytest.raises(DataQualityError):
        decompose.day_vs_baseline(df, d[0], {"g": "s"})


def test_teams_with_a_null_team(spark):
    d = days(D(2024, 1, 1), 2)
    df = spark.createDataFrame([(d[0], "a", 10.0), (d[1], "a", 10.0), (d[1], None, 5.0)], "run_date date, job_team string, cost double")
    got = {r.job_team: (r.delta, r.share, r.ratio) for r in decompose.team_contribution(df, d[1], {}).collect()}
    assert got == {"a": (0.0, 0.0, 1.0), None: (5.0, 1.0, math.inf)}


# Forecasts.


def test_origins():
    assert baselines.origins_between(D(2024, 1, 1), D(2024, 8, 31), 180) == [D(2024, 7, 1), D(2024, 8, 1)]
    assert baselines.origins_between(D(2024, 1, 1), D(2024, 8, 30), 180) == [D(2024, 7, 1)]


def test_baselines_and_unseen_groups(spark):
    d = days(D(2024, 1, 1), 121)
    df = spark.createDataFrame([(x, "s", float(x.weekday())) for x in d] + [(D(2024, 4, 10), "new", 3.0)], SERIES)
    led = baselines.walk_forward(df, FrameSpec(["subscription_id"]), [D(2024, 4, 1)])
    naive = led.where("model = 'seasonal_naive' AND subscription_id = 's'").collect()
    assert len(naive) == 30 and all(r.q50 == r.y_true == r.q05 == r.q95 for r in naive)
    assert led.where("subscription_id = 'new' AND q50 IS NOT NULL").count() == 0
    median = led.where("model = 'rolling_median' AND subscription_id = 's'").first()
    assert median.q50 == 3.0
    with pytest.raises(BacktestError):
        baselines.walk_forward(df, FrameSpec(["subscription_id"]), [])
    with pytest.raises(BacktestError):
        baselines.prepare(df, mask=F.lit(False))


def test_trend_follows_a_line(spark):
    d = days(D(2024, 1, 1), 121)
    df = spark.createDataFrame([(x, "s", 5.0 + 2 * i) for i, x in enumerate(d)], SERIES)
    led = baselines.walk_forward(df, FrameSpec(["subscription_id"]), [D(2024, 4, 1)], ["three_month_trend"])
    assert all(abs(r.q50 - r.y_true) < 1e-6 for r in led.collect())


LEDGER = "run_date date, g string, model string, origin date, y_true double, q05 double, q50 double, q95 double"


def test_metrics(spark):
    o = D(2024, 1, 1)
    led = spark.createDataFrame([(o, "g", "m", o, 100.0, 90.0, 110.0, 120.0), (D(2024, 1, 2), "g", "m", o, 100.0, 90.0, 100.0, 95.0)], LEDGER)
    r = metrics.evaluate(led, ["g"]).first()
    assert (r.mae, round(r.monthly_pct_err, 9), r.coverage) == (5.0, 0.05, 0.5)
    off = spark.createDataFrame([(o, "a", "m", o, 100.0, 0.0, 110.0, 200.0), (o, "b", "m", o, 100.0, 0.0, 90.0, 200.0)], LEDGER)
    r = metrics.evaluate(off, ["g"]).first()
    assert (r.estate_pct_err, round(r.wape, 9), r.bias) == (0.0, 0.1, 0.0)


def test_finite_sample_quantile(spark):
    f = lambda x: spark.createDataFrame([(float(v),) for v in x], "s double").agg(calibrate.finite_sample_quantile("s", 0.9)).first()[0]
    assert (f(range(1, 10)), f(range(1, 6)), f([])) == (9.0, 5.0, 0.0)


def test_cqr_scores(spark):
    df = spark.createDataFrame([(10.0, 8.0, 12.0), (10.0, 12.0, 14.0), (10.0, 9.0, 9.5), (None, 1.0, 2.0)], "y_true double, q05 double, q95 double")
    assert rows(df.select(scalars.cqr_score(scaled=False).alias("s")), "s") == [-2.0, 2.0, 0.5, None]


def test_scaled_margin_widens_by_width(spark):
    df = spark.createDataFrame([(100.0, 110.0, 120.0), (100.0, 150.0, 200.0)], "q05 double, q50 double, q95 double")
    lo, hi = scalars.widened("q05", "q50", "q95", F.lit(0.5))
    assert rows(df.select((hi - lo).alias("w")), "w") == [40.0, 200.0]


def test_calibration_reaches_its_coverage(spark):
    rng = random.Random(5)
    led = spark.createDataFrame([(d, "g", "m", D(2024, 1, 1), rng.gauss(100, 10), 98.0, 100.0, 102.0) for d in days(D(2024, 1, 1), 400)], LEDGER)
    cal, test = led.where("run_date < DATE'2024-10-01'"), led.where("run_date >= DATE'2024-10-01'")
    out = calibrate.apply_margins(test, calibrate.margins(cal, ["g"]), ["g"])
    assert calibrate.coverage(out).first().coverage >= 0.8 > calibrate.coverage(test).first().coverage


# Detector.


def test_cusum_equals_a_loop(spark):
    rng = random.Random(4)
    d = days(D(2024, 1, 1), 200)
    y = [rng.gauss(0, 1) + (2 if i > 150 else 0) for i in range(200)]
    led = spark.createDataFrame([(x, "g", "m", d[0], v, -2.0, 0.0, 2.0) for x, v in zip(d, y)], LEDGER)
    got = {r.run_date: (r.s_pos, r.s_neg, r.alarm) for r in detector.cusum(led, ["g"]).collect()}

    def med(x):
        s = sorted(x)
        n = len(s)
        return (s[(n - 1) // 2] + s[n // 2]) / 2

    p = n = 0.0
    seen = 0
    for i, x in enumerate(d):
        past = y[max(0, i - 60) : i]
        if len(past) < 20:
            assert got[x] == (None, None, None)
            continue
        m = med(past)
        z = y[i] / max(1.4826 * med([abs(v - m) for v in past]), 1e-9)
        p, n = max(0.0, p + z - 0.5), max(0.0, n - z - 0.5)
        alarm = None if max(p, n) <= 5 else "above" if p >= n else "below"
        a, b, c = got[x]
        assert abs(a - p) < 1e-9 and abs(b - n) < 1e-9 and c == alarm
        if alarm:
            p = n = 0.0
            seen += 1
    assert seen
    # piece by piece, as batches come, it is the same
    whole, walk = detector.Cusum()(np.array(y)), detector.Cusum()
    for got_, want in zip(zip(*(walk(np.array(y[a : a + 7])) for a in range(0, 200, 7))), whole):
        part = np.concatenate(got_)
        assert [None if v is None or v != v else v for v in part] == [None if v is None or v != v else v for v in want]


def test_order_statistics(spark):
    rng = random.Random(2)
    data = [(g, round(rng.gauss(0, 30), rng.choice((0, 2)))) for g in "abc" for _ in range({"a": 1, "b": 40, "c": 333}[g])] + [("a", None), ("d", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r for r in ranks.order_statistics(df, ["g"], "v", {"k": ranks.conformal_rank(0.9), "low": lambda n: F.lit(1)}).collect()}
    for g in "abc":
        v = sorted(x for h, x in data if h == g and x is not None)
        assert (got[g].n, got[g].k, got[g].low) == (len(v), v[min(-(-(len(v) + 1) * 9 // 10), len(v)) - 1], v[0])
    assert "d" not in got and ranks.order_statistics(df.limit(0), [], "v", {"k": ranks.conformal_rank(0.9)}).count() == 0
    q = {r.g: r for r in ranks.quantiles(df, ["g"], "v", {"lo": 0.05, "hi": 0.95}).collect()}
    for g in "abc":
        v = [x for h, x in data if h == g and x is not None]
        assert abs(q[g].lo - np.quantile(v, 0.05)) < 1e-9 and abs(q[g].hi - np.quantile(v, 0.95)) < 1e-9


@pytest.mark.parametrize("last,want", [(1000.0, ["above", "new"]), (102.0, ["new"])])
def test_jobs_against_their_history(spark, last, want):
    d = days(D(2024, 1, 1), 31)
    df = spark.createDataFrame([(x, "s", "b", "p", "j", 100.0 + (i % 3) * 0.1 if i < 30 else last) for i, x in enumerate(d)], "run_date date, subscription_id string, batch_account_name string, pool_name string, job_name string, cost double")
    got = detector.job_alerts(df).collect()
    assert sorted(r.direction for r in got) == want and {r.layer for r in got} == {"L2_job"}
    assert {r.metric for r in got if r.direction == "new"} == {"new_job"}
    # only the scored days, with the whole history before them
    assert [(r.run_date, r.direction) for r in detector.job_alerts(df, score_from=d[-1]).collect()] == [(d[-1], x) for x in want if x != "new"]


def test_attribution_and_triage(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "a", 0.02), (D(2024, 1, 2), "a", 0.847), (D(2024, 1, 2), "b", 0.847)], "run_date date, job_team string, unknown_pct double")
    got = detector.attribution_alerts(df).collect()
    assert [(r.run_date, r.severity, r.direction) for r in got] == [(D(2024, 1, 2), "high", "above")]
    old = detector.attribution_alerts(df).withColumn("status", F.lit("known"))
    assert (got[0].layer, got[0].scope, got[0].metric, got[0].impact) == ("attribution", "estate", "unknown_pct", None)
    out = detector.run_detector({}, frame_2=df, previous_alerts=old)
    assert rows(out, "status") == ["known"] and out.columns == scalars.ALERT_COLUMNS


def test_spike_is_seen_the_same_day(spark):
    rng = random.Random(7)
    d = days(D(2024, 1, 1), 120)
    led = spark.createDataFrame([(x, "g", "m", d[0], rng.gauss(100, 5) + (200 if i == 110 else 0), 92.0, 100.0, 108.0) for i, x in enumerate(d)], LEDGER)
    got = detector.run_detector({"frame_1a": (led, ["g"])}, score_from=d[-30]).collect()
    hit = [r for r in got if r.run_date == d[110]]
    assert {r.layer for r in hit} == {"L1_interval", "L1.5_cusum"} and all(r.scope == "frame_1a:g=g" for r in hit) and got[0].run_date == d[110]
    assert {r.layer: r.metric for r in hit} == {"L1_interval": "daily_cost", "L1.5_cusum": "residual_drift"}
    at = f"L1_interval|frame_1a:g=g|{d[110]}|above"
    assert hashlib.sha1(at.encode()).hexdigest()[:12] in {r.alert_id for r in hit}


def test_segments(spark):
    """The fixed values: a licence line's service alone does not make it compute."""
    df = spark.createDataFrame([("microsoft.compute/virtualMachineScaleSets", "x", "x"), ("x", "Virtual Machines Licences", "x"), ("x", "x", "Virtual Machines"), ("x", "x", "Virtual Machines Licences"), ("microsoft.compute/virtualmachine", "x", "x"), (None, None, None)], "resource_type string, meter_category string, service_name string")
    assert rows(df.select(scalars.segment().alias("s")), "s") == ["vm_compute"] * 3 + ["platform"] * 3


# Checks.


def test_write_rule(spark):
    t = [datetime(2024, 1, 1, h) for h in (1, 2)]
    df = spark.createDataFrame([("m", None, t[0]), ("m", None, t[0]), ("n", "p", t[0]), ("n", "p", t[1])], "meter string, pool_name string, update_time timestamp")
    assert rows(checks.write_violations(df), "meter") == ["n"]
    with pytest.raises(DataQualityError):
        checks.assert_one_write(df, "t")
    with pytest.raises(DataQualityError):
        checks.assert_one_write(df.drop("update_time"), "t")
    assert checks.duplicate_rate(df, ["meter"]).first().rate == 1.0 and checks.duplicate_rate(df.limit(0), ["meter"]).first().rate == 0.0


def test_leaks_schema_and_nulls(spark):
    with pytest.raises(DataQualityError):
        checks.assert_no_unlagged(["cost", "cost_lag1"], "y", "t")
    with pytest.raises(DataQualityError):
        checks.assert_no_unlagged(["y"], "y", "t")
    checks.assert_no_unlagged(["cost_lag1", "dow"], "cost", "t")
    df = spark.createDataFrame([(1, None)], "a int, b int")
    checks.assert_schema(df, {"a": "int"}, "t")
    with pytest.raises(DataQualityError):
        checks.assert_schema(df, {"a": "string"}, "t")
    with pytest.raises(DataQualityError):
        checks.assert_no_new_nulls(df, ["b"], "t")
    with pytest.raises(DataQualityError):
        checks.assert_same_rows(1, 2, "t")
    with pytest.raises(ValueError):
        FrameSpec([])
    assert DetectorConfig().cusum_h == 5 and Frame(df, FrameSpec(["a"])).feature_cols == []
