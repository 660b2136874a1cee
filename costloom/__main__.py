"""Command line: extract a snapshot, run the pipeline on one, score, or diagnose fan-out.

    python -m costloom extract --url jdbc:postgresql://... --out snap [--days-back 115]
    python -m costloom run --snapshot snap --out out [--reconcile-only] [--gbm] [--detect-days 30] [--report out/report.html]
    python -m costloom score --snapshot snap --bundle b --ledger l --frame 1a --manifest m.json
    python -m costloom diagnose --snapshot snap
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from .config import JOB_KEYS, POOL_KEYS
from .errors import BacktestError, ScoringAborted
from .operators import checks, detector, gate, joins
from .plans import frames, pipeline
from .session import session
from .sources import snapshot
from .sources.ledger import PredictionLedger


def extract(a) -> int:
    spark = session()
    props = {"user": a.user, "password": a.password} if a.user else {}
    print(json.dumps(snapshot.extract(spark, a.url, a.out, props, a.days_back), default=str))
    return 0


def run(a) -> int:
    """Frames, reconciliation, back-tests and alerts into out; previous alerts there keep their triage status."""
    spark = session()
    tables = snapshot.load_snapshot(spark, a.snapshot)
    summary = pipeline.reconciliation(tables)
    snapshot.write_json(spark, f"{a.out}/reconciliation.json", summary.first().asDict())
    joins.reconcile(tables["raw_cost"], tables["job_cost"]).write.mode("overwrite").parquet(f"{a.out}/reconciliation.parquet")
    summary.show(truncate=False)
    if a.reconcile_only:
        return 0
    built = pipeline.build(tables)
    snapshot.write_frames({f"frame_{n}": f.df for n, f in built.items()}, a.out)
    manifest = pipeline.manifest_of(built)
    snapshot.write_json(spark, f"{a.out}/ml_manifest.json", manifest)
    for n, m in manifest.items():
        print(f"{n}: {m['rows']} rows, {len(m['feature_cols'])} features")
    built["1a"].df.groupBy("data_regime").count().show()
    ledgers, tabs, results = {}, {}, {}
    for n, f in built.items():
        try:
            ledger, table = pipeline.backtest(f, n, gbm=a.gbm)
        except BacktestError as e:  # a frame that can't be judged is reported, the others go on
            print(f"frame {n}: {e}")
            results[f"frame_{n}"] = {"error": str(e)}
            continue
        ledger.write.mode("overwrite").parquet(f"{a.out}/ledger_{n}.parquet")
        ledgers[n] = (ledger, f.spec.group_keys)
        tabs[n] = table.cache()
        results[f"frame_{n}"] = [r.asDict() for r in table.collect()]  # a row for each model
        table.show(truncate=False)
    snapshot.write_json(spark, f"{a.out}/backtest_summary.json", results)
    old = spark.read.parquet(f"{a.out}/alerts.parquet").cache() if snapshot.exists(spark, f"{a.out}/alerts.parquet") else None
    if old is not None:
        old.count()  # the file is replaced below
    alerts = pipeline.detect(ledgers, tables, built["2"].df, old, score_days=a.detect_days or None)
    alerts.write.mode("overwrite").parquet(f"{a.out}/alerts.parquet")
    detector.alert_counts(alerts).show()
    alerts.show(3, truncate=False)
    if a.report:
        charts = {"pool cost": built["1a"].df.groupBy("run_date").agg(F.sum("cost").cast("double").alias("cost")).orderBy("run_date")}
        bars = {}
        for n, table in tabs.items():
            ledger, keys = ledgers[n]
            bars |= {f"frame {n}: mean absolute error": (table.select("model", "mae"), None), f"frame {n}: coverage": (table.select("model", "coverage"), 0.9)}
            best = table.first().model
            for g in pipeline.top_groups(built[n].df, keys).collect():
                group = {k: g[k] for k in keys}
                charts[f"frame {n}, {best}: {group}"] = pipeline.forecast_chart(ledger.where(F.col("model") == best), group)
        page = pipeline.report("Cost", {"reconciliation": summary, "alerts": alerts.limit(8), **{f"back-test {n}": t for n, t in tabs.items()}}, charts, bars=bars)
        snapshot.write_text(spark, a.report, page)
    return 0


def score(a) -> int:
    spark = session()
    builder = frames.BUILDERS[a.frame]
    tables = snapshot.load_snapshot(spark, a.snapshot)
    ledger = PredictionLedger(spark, a.ledger, a.frame, a.keys.split(",") if a.keys else POOL_KEYS[1:])
    try:
        for k, v in pipeline.score(spark, a.bundle, tables, ledger, a.manifest, builder, a.featurize, ignore_watermark=a.ignore_watermark).items():
            print(f"{k:16} {v}")
    except ScoringAborted as e:
        print(e, file=sys.stderr)
        return 0 if e.soft else 1
    return 0


def diagnose(a) -> int:
    """Rows and keys of each stage, to see where a join fans out."""
    t = snapshot.load_snapshot(session(), a.snapshot)
    target = frames.daily_pool_cost(t["raw_cost"])
    joined = joins.join_attributes(t["job_usage"], t["job_cost"], check=False)
    checks.stage_counts({"pool lines": (gate.batch_slice(t["raw_cost"]), POOL_KEYS), "pool days": (target, POOL_KEYS), "jobs": (t["job_usage"], JOB_KEYS), "job costs": (t["job_cost"], JOB_KEYS), "attributed": (joined, JOB_KEYS)}).show(truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="costloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)
    x = sub.add_parser("extract")
    x.add_argument("--url", required=True)
    x.add_argument("--out", required=True)
    x.add_argument("--user")
    x.add_argument("--password")
    x.add_argument("--days-back", type=int)
    x.set_defaults(f=extract)
    x = sub.add_parser("run")
    x.add_argument("--snapshot", required=True)
    x.add_argument("--out", required=True)
    x.add_argument("--reconcile-only", action="store_true")
    x.add_argument("--gbm", action="store_true", help="add the quantile GBM, as it is and calibrated, to the back-test")
    x.add_argument("--detect-days", type=int, default=30, help="alerts of the last so many days; 0: of all days")
    x.add_argument("--report")
    x.set_defaults(f=run)
    x = sub.add_parser("score")
    for n in ("snapshot", "bundle", "ledger", "manifest"):
        x.add_argument(f"--{n}", required=True)
    x.add_argument("--frame", default="1a", choices=sorted(frames.BUILDERS))
    x.add_argument("--keys")
    x.add_argument("--featurize")
    x.add_argument("--ignore-watermark", action="store_true")
    x.set_defaults(f=score)
    x = sub.add_parser("diagnose")
    x.add_argument("--snapshot", required=True)
    x.set_defaults(f=diagnose)
    a = p.parse_args(argv)
    return a.f(a)


if __name__ == "__main__":
    sys.exit(main())
