"""Frames, snapshots, ledger, model bundles, scoring, streams and the registered queries."""

import random
from datetime import date, datetime, timedelta

import pytest
from compare import spark_rows, sql_rows
from pyspark.sql import functions as F

from costloom import queries
from costloom.config import LENS_ERAS, Eras, FrameSpec
from costloom.errors import DataQualityError, LedgerError, PersistenceError, ScoringAborted
from costloom.operators import calibrate, detector, factory, features
from costloom.operators.gbm import QuantileGBM, transform_experiment
from costloom.plans import frames, pipeline
from costloom.plans.lens import lens
from costloom.sources import snapshot
from costloom.sources.ledger import ModelCard, PredictionLedger, current_view, load_bundle, save_bundle, schema_hash
from costloom.streaming import streams

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    if name in queries.ORACLE_SQL:
        assert spark_rows(got) == sql_rows(duck, queries.ORACLE_SQL[name])
    else:
        assert got.count() >= 0


@pytest.fixture(scope="module")
def tables(spark):
    """120 days of three pools and a storage account, one job for each pool and day, all loads complete."""
    rng = random.Random(7)
    raw, use, cost, log = [], [], [], []
    for i in range(120):
        d = date(2026, 1, 1) + timedelta(days=i)
        at = datetime(2026, 1, 1) + timedelta(days=i)
        for p in ("p1", "p2", "p3"):
            c = 100 * (0.6 if d.weekday() >= 5 else 1) * rng.lognormvariate(0, 0.1)
            raw.append((d, "s", "rg", "microsoft.compute/virtualmachinescalesets", "VM", "Virtual Machines", "m1", "x", "b" if p != "p3" else None, p, c, c * 5, at))
            use.append((d, "s", "b" if p != "p3" else None, p, f"j-{i}", at + timedelta(hours=9), at + timedelta(hours=11), 7200.0, 3))
            cost.append((d, "s", "b" if p != "p3" else None, p, f"j-{i}", "job", "Reg", "own", None if p == "p2" else "team", c))
        raw.append((d, "s", "rg", "microsoft.storage/storageaccounts", "Storage", "Storage", "m2", "x", None, None, 5.0, 1.0, at))
        log += [(d, "s", k, "Complete", at) for k in ("Cost", "Usage", "Attribution")]
    keys = "run_date date, subscription_id string"
    return {
        "raw_cost": spark.createDataFrame(raw, f"{keys}, resource_group_name string, resource_type string, service_name string, meter_category string, meter string, meter_sub_category string, batch_account_name string, pool_name string, pre_tax_cost double, usage_quantity double, update_time timestamp").cache(),
        "job_usage": spark.createDataFrame(use, f"{keys}, batch_account_name string, pool_name string, job_id string, start_time timestamp, end_time timestamp, job_seconds double, task_count int").cache(),
        "job_cost": spark.createDataFrame(cost, f"{keys}, batch_account_name string, pool_name string, job_id string, job_name string, job_category string, job_ownership string, job_team string, cost double").cache(),
        "run_status": spark.createDataFrame(log, f"{keys}, run_type string, status string, update_time timestamp").cache(),
        "environment_config": spark.createDataFrame([("s", "x-neu", "PROD", "core")], "subscription_id string, subscription_name string, environment_tier string, environment_sub_tier string"),
    }


def test_frames(tables):
    got = pipeline.build(tables)
    a = got["1a"].df.where("pool_name = 'p3'").orderBy("run_date").collect()
    assert len(a) == 120 and a[1].cost_lag1 == a[0].cost and a[1].job_seconds_lag1 == 7200 and a[5].peak_concurrency == 1 and a[0].region == "northeurope" and {"pool_name", "region"} <= set(got["1a"].categorical_cols) <= set(got["1a"].feature_cols)
    assert a[0].batch_account_name == "__NULL_BATCH__" and a[60].price_drift == pytest.approx(0)
    assert got["1b"].df.select("segment").distinct().first()[0] == "platform" and got["1b"].df.count() == 120
    two = got["2"].df
    assert {r[0] for r in two.select("job_team").distinct().collect()} == {"team", "__NULL_TEAM__"} and abs(two.first().unknown_pct - 1 / 3) < 0.2
    with pytest.raises(DataQualityError):
        pipeline.build({k: v for k, v in tables.items() if k != "raw_cost"})


def test_padding_fills_a_complete_gap(tables):
    gap = dict(tables)
    gap["raw_cost"] = tables["raw_cost"].where("NOT (pool_name <=> 'p1' AND run_date = DATE'2026-02-01')")
    f = frames.frame_1a(gap).df.where("pool_name = 'p1' AND run_date = DATE'2026-02-01'").first()
    assert f.padded and f.cost == 0 == f.peak_concurrency == f.share_Reg and f.gate_state == "gated_complete" and f.data_regime == "featured_gated"


def test_backtest_and_detection(tables):
    f = pipeline.build(tables)["1a"]
    ledger, table = pipeline.backtest(f, "1a", min_train_days=60)
    assert {r.model for r in table.collect()} == set(pipeline.models_for(False))
    alerts = pipeline.detect({"1a": (ledger, f.spec.group_keys)}, tables)
    assert alerts.count() >= 0
    page = pipeline.report("R", {"metrics": table}, {"cost": f.df.groupBy("run_date").agg(F.sum("cost")).orderBy("run_date")})
    assert "<svg" in page and "mae" in page
    assert pipeline.top_groups(f.df, ["pool_name"], 2).count() == 2 and pipeline.reconciliation(tables).count() == 1
    story = pipeline.explain_event(f, None, tables, {"pool_name": "p1"}, date(2026, 4, 1))
    assert abs(sum(story["change"][k] for k in ("price", "usage", "scope", "unpriced")) - story["change"]["delta"]) < 0.02
    assert "meter" in pipeline.format_explanation(story)
    with pytest.raises(DataQualityError):
        pipeline.explain_event(f, None, tables, {"pool_name": "none"}, date(2026, 4, 1))


def test_quantile_gbm_learns_and_survives_its_bundle(spark, tables, tmp_path):
    f = pipeline.build(tables)["1a"]
    df = f.df.withColumn("batch_account_name", F.col("batch_account_name"))
    feats = ["cost_lag1", "cost_lag7", "dow", "pool_name"]
    train, test = df.where("run_date < DATE'2026-04-01'"), df.where("run_date >= DATE'2026-04-01'")
    m = QuantileGBM(feats, ["pool_name"], rounds=60).fit(train, f.spec)
    p = m.predict(test.select("run_date", *f.spec.group_keys, *[c for c in feats if c != "pool_name"], "cost")).toPandas()
    assert (p.q05 <= p.q50).all() and (p.q50 <= p.q95).all()
    assert (p.q50 - p.cost).abs().mean() < 0.6 * (p.cost - p.cost.median()).abs().mean()
    assert 0.6 <= ((p.cost >= p.q05) & (p.cost <= p.q95)).mean() <= 1
    assert m.importance()[0][1] > 0
    row = test.limit(1).toPandas()
    parts = m.explain(row)
    assert set(parts) == {*feats, "base"}
    assert len(transform_experiment(train, test, f.spec, ["dow"], names=("asinh", "none"))) == 2
    types = {"cost_lag1": "double", "cost_lag7": "double", "dow": "int", "pool_name": "string"}
    card = ModelCard("1a", "v1", "cost", f.spec.group_keys, feats, types, {"pool_name": ["p1", "p2", "p3"]}, list(m.boosters))
    at = str(tmp_path / "bundle")
    margins = spark.createDataFrame([(None, None, None, 1.0, 1.0, True)], "subscription_id string, batch_account_name string, pool_name string, lower_margin double, upper_margin double, pooled boolean")
    save_bundle(spark, at, m.state(), card, margins)
    with pytest.raises(PersistenceError):
        save_bundle(spark, at, m.state(), card)
    back, boosters, _ = load_bundle(spark, at)
    assert back == card and back.schema_hash == schema_hash(feats, types)
    q = QuantileGBM.from_state(boosters).predict(test.select("run_date", *f.spec.group_keys, *[c for c in feats if c != "pool_name"], "cost")).toPandas()
    assert q.equals(p)
    # scoring: once, then nothing new; a wrong ledger aborts
    led = PredictionLedger(spark, str(tmp_path / "ledger"), "1a", f.spec.group_keys)
    run = lambda: pipeline.score(spark, at, tables, led, str(tmp_path / "manifest.json"), frames.frame_1a)
    info = run()
    assert info["status"] == "scored" and led.watermark("v1") == date(2026, 4, 30) and led.current().count() == info["rows"] == 360
    with pytest.raises(ScoringAborted) as e:
        run()
    assert e.value.soft and snapshot.read_json(spark, str(tmp_path / "manifest.json"))["status"] == "nothing new"
    with pytest.raises(ScoringAborted):
        pipeline.score(spark, at, tables, PredictionLedger(spark, str(tmp_path / "l2"), "2", ["x"]), str(tmp_path / "m2.json"), frames.frame_2)
    with pytest.raises(LedgerError):
        led.advance("v1", date(2020, 1, 1))


def test_ledger_is_append_only(spark, tmp_path):
    led = PredictionLedger(spark, str(tmp_path), "1a", ["g"])
    p = lambda v: spark.createDataFrame([(date(2026, 1, 1), "a", v)], "run_date date, g string, q50 double")
    led.append(p(100.0), "v1", datetime(2026, 1, 2))
    led.append(p(150.0), "v1", datetime(2026, 1, 3))
    assert led.current("v1").first().q50 == 150 and led.read_all().count() == 2
    with pytest.raises(LedgerError):
        led.append(p(1.0).union(p(2.0)), "v1", datetime(2026, 1, 4))
    led.append(p(1.0), "v2", datetime(2026, 1, 5))
    with pytest.raises(LedgerError):
        current_view(led.read_all(), ["g"])


def test_snapshot_round_trip(spark, tables, tmp_path):
    at = str(tmp_path / "snap")
    m = snapshot.write_snapshot(tables, at)
    assert m["tables"]["raw_cost"]["density"]["2026-01"] == 31 * 4
    back = snapshot.load_snapshot(spark, at)
    assert set(back) == set(tables) and back["raw_cost"].count() == 480
    feb = snapshot.between_days(back["raw_cost"], date(2026, 2, 1), date(2026, 2, 10))
    assert feb.count() == 40 and "run_month" in feb._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    assert snapshot.read_json(spark, f"{at}/_manifest.json")["tables"]["job_cost"]["rows"] == 360


def test_month_predicates():
    p = snapshot.month_predicates(date(2024, 11, 20), date(2025, 1, 3), date(2024, 12, 5))
    assert p == ["run_date >= DATE '2024-12-05' AND run_date < DATE '2025-01-01'", "run_date >= DATE '2025-01-01' AND run_date < DATE '2025-02-01'"]


def test_conformal_wrapper(spark):
    t = lens(spark, "/root/testdata/sf0.01", ["raw_cost"])
    d = queries.daily(t)
    led = pipeline.run_models(d, FrameSpec(["subscription_id"]), {m: f for m, f in pipeline.models_for().items() if m.endswith("rolling_median")}, queries.ORIGINS)
    cov = {r.model: r.coverage for r in calibrate.coverage(led).collect()}
    assert 0.8 < cov["conformal_rolling_median"] <= 1


def test_gate_before_lag_reads_the_day_before(spark):
    """A padded spine keeps positions and days together."""
    d = [date(2024, 1, 1), date(2024, 1, 3)]
    f = spark.createDataFrame([(x, "s", float(i)) for i, x in enumerate(d)], "run_date date, subscription_id string, cost double")
    out = factory.add_lags(factory.pad_daily(f, ["subscription_id"], []), ["subscription_id"], ["cost"], [1]).orderBy("run_date").collect()
    assert [r.cost_lag1 for r in out] == [None, 0.0, None]


def test_streams_equal_batch(spark, tables, tmp_path):
    src = str(tmp_path / "src")
    raw = tables["raw_cost"]
    raw.repartition(3).write.parquet(src)
    got = []
    q = streams.run_available(streams.daily_cost(streams.read_stream(spark, src, raw.schema, 1)).selectExpr("to_date(window.start) AS day", "pool_name", "cost"), str(tmp_path / "c"), lambda df, _: got.extend(df.collect()))
    q.awaitTermination(60)
    want = {(r.run_date, r.pool_name): r.cost for r in raw.groupBy("run_date", "pool_name").agg(F.sum("pre_tax_cost").alias("cost")).collect()}
    # days inside the watermark are still open
    assert got and all(abs(want[r.day, r.pool_name] - r.cost) < 1e-6 for r in got)
    seen = []
    q = streams.run_available(streams.rewrites(streams.read_stream(spark, src, raw.schema)), str(tmp_path / "c2"), lambda df, _: seen.append(df.count()))
    q.awaitTermination(60)
    assert sum(seen) == 480


def _by_day(spark, rows, schema, at, parts=3):
    """Files whose days follow each other, as loads do."""
    df = spark.createDataFrame(sorted(rows, key=lambda r: r[0]), schema)
    size = -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(sorted(rows, key=lambda r: r[0])[k * size : (k + 1) * size], schema).coalesce(1).write.mode("append").parquet(at)
    return df


def test_stateful_streams_equal_batch(spark, tmp_path):
    rng = random.Random(11)
    d = [date(2024, 1, 1) + timedelta(days=i) for i in range(90)]
    kind = "run_date date, g string, y_true double, q05 double, q50 double, q95 double"
    led = _by_day(spark, [(x, g, rng.gauss(100, 5) + (12 if i > 60 and g == "a" else 0), 95.0, 100.0, 105.0) for i, x in enumerate(d) for g in "ab"], kind, str(tmp_path / "led"))
    src = lambda: streams.read_stream(spark, str(tmp_path / "led"), kind, 1)
    got = []
    streams.run_available(streams.cusum_stream(src(), ["g"]), str(tmp_path / "c1"), lambda b, _: got.extend(b.collect())).awaitTermination(90)
    want = {(r.g, r.run_date): r for r in detector.cusum(led, ["g"]).collect()}
    assert len(got) == len(want) == 180 and any(r.alarm for r in got)
    for r in got:
        w = want[r.g, r.run_date]
        assert r.alarm == w.alarm and (w.z is None or abs(r.z - w.z) < 1e-9)
    got = []
    streams.run_available(streams.margin_stream(src(), ["g"]), str(tmp_path / "c2"), lambda b, _: got.extend(b.collect())).awaitTermination(90)
    own = {(r.g, r.run_date): r.margin for r in detector.calibrated(led, ["g"]).collect()}
    assert len(got) == 180 and all(r.margin is None or abs(r.margin - own[r.g, r.run_date]) < 1e-12 for r in got) and sum(r.margin is not None for r in got) == 120


def test_concurrency_and_rewrites_streams(spark, tmp_path):
    rng = random.Random(12)
    t0 = datetime(2024, 1, 1)
    jobs = [(t0 + timedelta(days=i, hours=rng.randrange(20)), f"p{i % 2}") for i in range(40) for _ in range(4)]
    jobs = [(a, a + timedelta(hours=rng.randrange(1, 30)), p) for a, p in jobs] + [(t0, None, "p0")]
    kind = "start_time timestamp, end_time timestamp, pool_name string"
    df = _by_day(spark, jobs, kind, str(tmp_path / "jobs"))
    got = []
    streams.run_available(streams.concurrency_stream(streams.read_stream(spark, str(tmp_path / "jobs"), kind, 1), ["pool_name"], 3), str(tmp_path / "c1"), lambda b, _: got.extend(b.collect())).awaitTermination(90)
    want = {(r.pool_name, r.run_date): (r.peak_concurrency, r.mean_concurrency) for r in features.concurrency(df, ["pool_name"]).collect()}
    assert 60 < len(got) < len(want)
    for r in got:
        assert (r.peak_concurrency, pytest.approx(r.mean_concurrency)) == want[r.pool_name, r.run_date]
    at = [datetime(2024, 1, 2, h) for h in range(3)]
    kind = "run_date date, subscription_id string, meter string, update_time timestamp"
    spark.createDataFrame([(date(2024, 1, 1), "s", "m", at[0]), (date(2024, 1, 1), "s", "m", at[0]), (date(2024, 1, 1), "s", "n", at[0]), (date(2024, 1, 1), "s", "n", at[2])], kind).write.parquet(str(tmp_path / "raw"))
    seen = []
    q = streams.violations(streams.read_stream(spark, str(tmp_path / "raw"), kind)).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).foreachBatch(lambda b, _: seen.extend(b.collect())).start()
    q.awaitTermination(90)
    assert {(r.meter, r.last_write) for r in seen} == {("n", at[2])}
    days, kind = [], "run_date date, subscription_id string, run_type string, status string"
    for k, status in enumerate(("Error", "Complete")):
        spark.createDataFrame([(date(2024, 1, 1), "s", "Cost", status)], kind).write.mode("append").parquet(str(tmp_path / "log"))
        streams.completed_loads(streams.read_stream(spark, str(tmp_path / "log"), kind), lambda b, _: days.extend(b.collect()), str(tmp_path / "c3")).awaitTermination(90)
        assert len(days) == k


def test_eras_are_parameters(spark):
    assert LENS_ERAS.gated < Eras().gated


def test_command_line(spark, tables, tmp_path, capsys):
    from costloom.__main__ import main

    snap, out = str(tmp_path / "s"), str(tmp_path / "o")
    snapshot.write_snapshot(tables, snap)
    assert main(["diagnose", "--snapshot", snap]) == 0
    assert main(["run", "--snapshot", snap, "--out", out, "--reconcile-only"]) == 0
    assert "verdict" in capsys.readouterr().out
    assert main(["run", "--snapshot", snap, "--out", out, "--report", str(tmp_path / "r.html")]) == 0
    assert (tmp_path / "r.html").read_text().startswith("<!doctype html>")
    assert spark.read.parquet(f"{out}/alerts.parquet").count() >= 0
