"""Orchestration: build, back-test, detect, score, explain, report."""

from __future__ import annotations

import html
import importlib
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DetectorConfig, Eras, Frame, FrameSpec
from ..errors import BacktestError, DataQualityError, ScoringAborted
from ..functions.scalars import min_history_days
from ..operators import baselines, calibrate, checks, decompose, detector, features, gate, joins, metrics
from ..operators.gbm import QuantileGBM
from ..sources import snapshot
from ..sources.ledger import ModelCard, PredictionLedger, load_bundle
from ..sources.scratch import stored
from . import frames as fr


def build(tables: dict[str, DataFrame], eras: Eras = Eras(), check: bool = True) -> dict[str, Frame]:
    """The three frames, each stored in the shared folder: what reads a frame starts from its rows, not from its plan."""
    lack = snapshot.missing_tables(tables)
    if lack:
        raise DataQualityError(f"tables are missing: {lack}")
    if check:
        checks.assert_one_write(tables["raw_cost"], "billing", None)
    out = {name: f(tables, eras, check=check) for name, f in fr.BUILDERS.items()}
    for name, f in out.items():
        f.df = stored(f.df)
        if check:  # no join has copied a row
            rows, keys = f.df.agg(F.count("*"), F.countDistinct(F.struct(f.spec.date_col, *f.spec.group_keys))).first()
            checks.assert_same_rows(keys, rows, f"frame {name} by its keys")
    return out


def backtest(frame: Frame, name: str, models: Sequence[str] = baselines.MODELS, regimes: Sequence[str] = baselines.DEFAULT_REGIMES, min_train_days: int = 180, gbm: bool = False, rounds: int = 60) -> tuple[DataFrame, DataFrame]:
    """(ledger, metrics) of the baselines, and of the quantile GBM as it is and calibrated if asked, on the frame's honest slice. The ledger is stored."""
    rows = baselines.prepare(fr.SLICES[name](frame.df), regimes)
    origins = baselines.monthly_origins(rows, min_train_days)
    if not origins:
        raise BacktestError(f"{name}: no month follows {min_train_days} days of history")
    ledger = baselines.walk_forward(rows, frame.spec, origins, models).withColumn("pred_mean", F.lit(None).cast("double"))
    if gbm:
        ledger = ledger.unionByName(gbm_forecaster(rows, frame.spec, frame.feature_cols, frame.categorical_cols, origins, rounds, conformal=True)[0])
    ledger = stored(ledger)
    return ledger, metrics.evaluate(ledger, frame.spec.group_keys)


def gbm_forecaster(frame: DataFrame, spec: FrameSpec, feats: Sequence[str], categorical: Sequence[str], origins: Sequence[date], rounds: int = 60, conformal: bool = False) -> tuple[DataFrame, list[dict]]:
    """The ledger of a quantile GBM refitted at each origin, and a report of each origin's calibration; origins are few, each is a bounded fit.

    conformal adds the same predictions with calibrated intervals: a model fitted without the last TAIL_DAYS days is held
    against them. Too thin a tail leaves the interval as it is, and the report says so.
    """
    day = F.col(spec.date_col)
    own = frame.select(spec.date_col, *dict.fromkeys([*spec.group_keys, *feats]), F.col(spec.target).cast("double").alias("y_true"))
    out, reports = None, []

    def predicted(model: QuantileGBM, rows: DataFrame, o: date) -> DataFrame:
        return model.predict(rows).select(F.col(spec.date_col).alias("run_date"), *spec.group_keys, F.lit("quantile_gbm").alias("model"), F.lit(o).alias("origin"), "y_true", "q05", "q50", "q95", "pred_mean")

    for o in origins:
        train, test = frame.where(day < F.lit(o)), own.where((day >= F.lit(o)) & (day < F.lit(baselines._next_month(o))))
        raw = predicted(QuantileGBM(feats, categorical, rounds=rounds).fit(train, spec), test, o)
        made = [raw]
        if conformal:
            cut = train.agg(F.max(day)).first()[0] - timedelta(days=calibrate.TAIL_DAYS - 1)
            n = train.where(day >= F.lit(cut)).count()
            report = {"origin": str(o), "tail_rows": n, "calibrated": n >= calibrate.MIN_GROUP_SCORES and train.where(day < F.lit(cut)).limit(1).count() > 0}
            wide = raw
            if report["calibrated"]:
                early = QuantileGBM(feats, categorical, rounds=rounds).fit(train.where(day < F.lit(cut)), spec)
                tail = stored(predicted(early, own.where((day >= F.lit(cut)) & (day < F.lit(o))), o))
                wide = calibrate.apply_margins(raw, stored(calibrate.margins(tail, spec.group_keys)), spec.group_keys)
                report["raw_coverage_on_tail"] = calibrate.coverage(tail).first().coverage
            reports.append(report)
            made.append(wide.withColumn("model", F.lit("conformal_quantile_gbm")))
        for one in made:
            out = one if out is None else out.unionByName(one)
    return out, reports


def models_for(conformal: bool = True) -> dict[str, Callable]:
    """The set-based forecasters, and each wrapped in its calibration."""
    out = dict(baselines.FORECASTERS)
    if conformal:
        out |= {f"conformal_{n}": calibrate.conformal(f) for n, f in baselines.FORECASTERS.items()}
    return out


def run_models(frame: DataFrame, spec: FrameSpec, models: Mapping[str, Callable], origins: Sequence[date]) -> DataFrame:
    train, test = baselines.folds(frame, spec, origins)
    out = None
    for f in models.values():
        one = f(train, test, spec.group_keys)
        out = one if out is None else out.unionByName(one)
    return out


#: Whose ledger the detector reads: the first of these that there is.
LEDGER_PREFERENCE = ("quantile_gbm", "rolling_median", "seasonal_naive", "three_month_trend")


def detect(ledgers: Mapping[str, tuple[DataFrame, Sequence[str]]], tables: dict[str, DataFrame], team_frame: DataFrame | None = None, previous: DataFrame | None = None, config: DetectorConfig = DetectorConfig(), score_days: int | None = 30, preferred: Sequence[str] = LEDGER_PREFERENCE) -> DataFrame:
    """Alerts of the last score_days days of all ledgers (all days if none), from the first preferred model that each ledger has; stored."""
    chosen, last = {}, None
    for name, (ledger, keys) in ledgers.items():
        have = {r.model: r.last for r in ledger.groupBy("model").agg(F.max("run_date").alias("last")).collect()}
        pick = next((m for m in preferred if m in have), None)
        if pick:
            chosen[f"frame_{name}"] = (ledger.where(F.col("model") == pick), keys)
            last = max(filter(None, (last, have[pick])), default=None)
    since = last - timedelta(days=score_days - 1) if score_days and last else None
    return detector.triaged(stored(detector.run_detector(chosen, tables.get("job_cost"), team_frame, config, previous, since)))


def manifest_of(frames: Mapping[str, Frame]) -> dict:
    """What a Parquet file of a frame does not say: target, keys, features, labels, origin and reports."""
    out = {}
    for name, f in frames.items():
        reports = {k: [r.asDict() for r in v.collect()] for k, v in f.reports.items()}  # a few counts each
        out[f"frame_{name}"] = {"rows": f.df.count(), "target": f.spec.target, "group_keys": f.spec.group_keys, "feature_cols": f.feature_cols, "categorical_cols": f.categorical_cols, "train_origin": f.train_origin and str(f.train_origin), **{f"{k}_report": v for k, v in reports.items()}}
    return out


# Serving.


def resolve(path: str) -> Callable[[DataFrame], DataFrame]:
    """module:function."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def design(frame: DataFrame, card: ModelCard) -> tuple[DataFrame, dict]:
    """The frame as the model expects it: shares filled in, labels frozen, types equal; and what was unseen: labels by column, shares."""
    out, novel = features.reindexed_shares(frame, card.feature_names)
    unseen: dict[str, int] = {}
    if card.levels:
        out, unseen = features.frozen_levels(out, card.levels)
    out = out.withColumns({c: F.col(c).cast(t) for c, t in card.dtypes.items() if c in out.columns})
    checks.assert_schema(out, card.dtypes, "design matrix")
    checks.assert_no_unlagged(card.feature_names, card.target, "model card")
    # the calendar and other whole numbers of the day itself; lags may have nulls where a series begins
    whole = [c for c, t in card.dtypes.items() if t in ("tinyint", "smallint", "int", "bigint", "boolean") and "_lag" not in c and "_roll" not in c]
    checks.assert_no_new_nulls(out, whole, "design matrix")
    return out, {"unseen_levels": unseen, "novel_shares": novel}


def score(spark: SparkSession, bundle: str, tables: dict[str, DataFrame], ledger: PredictionLedger, manifest: str, builder: Callable[[dict[str, DataFrame]], Frame], featurize: str | None = None, now: datetime | None = None, ignore_watermark: bool = False) -> dict:
    """Score the days after the watermark, or all, and append them. Whatever stops it is in the manifest before it raises."""
    now = now or datetime.now(timezone.utc)
    info: dict = {"scored_at": now.isoformat(), "bundle": bundle, "status": "started"}

    def stop(why: str, soft: bool = False):
        snapshot.write_json(spark, manifest, info | {"status": "nothing new" if soft else "aborted", "reason": why})
        raise ScoringAborted(why, soft)

    card, boosters, margins = load_bundle(spark, bundle)
    if card.frame != ledger.frame:
        stop(f"the bundle is for frame {card.frame}, the ledger for {ledger.frame}")
    lack = snapshot.missing_tables(tables)
    if lack:
        stop(f"tables are missing: {lack}")
    lo, hi = tables["raw_cost"].agg(F.min("run_date"), F.max("run_date")).first()
    need = min_history_days(card.feature_names, card.horizon)
    if lo is None or (hi - lo).days < need:
        stop(f"the features need {need} days of history")
    try:
        frame = builder(tables)
    except DataQualityError as e:
        stop(str(e))
    df = stored(frame.df if featurize is None else frame.df.transform(resolve(featurize)))
    mark = None if ignore_watermark else ledger.watermark(card.version)
    rows = df.where("data_regime = 'featured_gated' AND gate_state = 'gated_complete'")
    rows = rows.where(F.col("run_date") > F.lit(mark)) if mark else rows
    if not rows.limit(1).count():
        stop("no complete day is newer than the watermark", soft=True)
    try:
        ready, seen = design(rows, card)
    except DataQualityError as e:
        stop(str(e))
    preds = QuantileGBM.from_state(boosters).predict(ready.select("run_date", *dict.fromkeys([*card.group_keys, *card.feature_names])))
    preds = preds.select("run_date", *card.group_keys, "q05", "q50", "q95", "pred_mean")
    if margins is not None:
        preds = calibrate.apply_additive(preds, margins, card.group_keys)
    at = ledger.append(preds, card.version, now)
    n, last = spark.read.parquet(at).agg(F.count("*"), F.max("run_date")).first()
    ledger.advance(card.version, last)
    info |= {"status": "scored", "frame": card.frame, "version": card.version, "rows": n, "last_day": str(last), "path": at, **seen}
    snapshot.write_json(spark, manifest, info)
    return info


# Explanations and report.


def explain_event(frame: Frame, model: QuantileGBM | None, tables: dict[str, DataFrame], group: Mapping[str, object], day: date, k: int = 5) -> dict:
    """One alert's story: what the model saw, what changed by meter and by team."""
    rows = frame.df.where(decompose.where_equal(group) & (F.col("run_date") == F.lit(day))).limit(2).toPandas()
    if len(rows) != 1:
        raise DataQualityError(f"{len(rows)} frame rows for {dict(group)} on {day}; one is needed")
    out: dict = {"group": dict(group), "run_date": str(day), "observed": float(rows[frame.spec.target].iloc[0])}
    if model is not None:
        for c in model.features:
            rows[c] = rows[c].astype(str) if c in model.categorical else rows[c].astype(float)
        parts = model.explain(rows)
        out["drivers"] = [(f, v) for f, v in sorted(parts.items(), key=lambda x: -abs(x[1])) if f != "base" and abs(v) > 0.005][:k]
    raw = gate.batch_slice(tables["raw_cost"])
    items = decompose.day_vs_baseline(raw, day, group)
    decompose.assert_identity(items)
    out["change"] = decompose.summary(items).first().asDict()
    out["meters"] = [r.asDict() for r in decompose.top_items(items, k).collect()]
    cost = tables["job_cost"].withColumn("batch_account_name", F.coalesce("batch_account_name", F.lit("__NULL_BATCH__")))
    try:
        teams = decompose.team_contribution(cost, day, group)
        out["teams"] = [r.asDict() for r in decompose.top_items(teams, k, tie="job_team").collect()]
    except DataQualityError:
        out["teams"] = []
    return out


def format_explanation(e: dict) -> str:
    lines = [f"{e['run_date']} {e['group']}: {e['observed']:.2f}"]
    c = e["change"]
    lines.append(f"change {c['delta']:+.2f}: price {c['price']:+.2f}, usage {c['usage']:+.2f}, scope {c['scope']:+.2f}, unpriced {c['unpriced']:+.2f}")
    lines += [f"  meter {m['meter']}: {m['delta']:+.2f} ({m['kind']})" for m in e["meters"]]
    lines += [f"  team {t['job_team']}: {t['delta']:+.2f}" for t in e["teams"]]
    lines += [f"  driver {f}: {v:+.3f}" for f, v in e.get("drivers", [])]
    return "\n".join(lines)


def _table(df: DataFrame, rows: int) -> str:
    got = df.limit(rows).collect()
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else f'{v:.4g}' if isinstance(v, float) else str(v))}</td>" for v in r) + "</tr>" for r in got)
    return f"<table><tr>{head}</tr>{body}</table>"


#: Points that a chart draws.
CHART_POINTS = 2000


def _chart(rows: Sequence[Mapping], width: int = 640, height: int = 160) -> str:
    """Values by day; with q05, q50 and q95 the band, the median dashed, and a thin line at each origin."""
    if not rows:
        return ""
    num = lambda v: None if v is None else float(v)
    x = [r["x"].toordinal() if hasattr(r["x"], "toordinal") else float(r["x"]) for r in rows]
    cols = {c: [num(r.get(c)) for r in rows] for c in ("y", "q05", "q50", "q95")}
    known = [v for c in cols.values() for v in c if v is not None] or [0.0]
    fx = lambda v: 4 + (v - min(x)) / ((max(x) - min(x)) or 1) * (width - 8)
    fy = lambda v: height - 4 - (v - min(known)) / ((max(known) - min(known)) or 1) * (height - 8)
    line = lambda c: " ".join(f"{fx(a):.1f},{fy(b):.1f}" for a, b in zip(x, cols[c]) if b is not None)
    out = [f'<line x1="{fx(o):.1f}" x2="{fx(o):.1f}" y1="0" y2="{height}" stroke="#ccc"/>' for o in sorted({r["origin"].toordinal() for r in rows if r.get("origin")}) if min(x) <= o <= max(x)]
    band = [(a, lo, hi) for a, lo, hi in zip(x, cols["q05"], cols["q95"]) if lo is not None and hi is not None]
    if band:
        edge = [f"{fx(a):.1f},{fy(lo):.1f}" for a, lo, _ in band] + [f"{fx(a):.1f},{fy(hi):.1f}" for a, _, hi in reversed(band)]
        out += [f'<polygon class="band" fill="#336" fill-opacity="0.15" points="{" ".join(edge)}"/>', f'<polyline fill="none" stroke="#336" stroke-dasharray="4 3" points="{line("q50")}"/>']
    out.append(f'<polyline fill="none" stroke="#000" points="{line("y")}"/>')
    return f'<svg width="{width}" height="{height}">{"".join(out)}</svg>'


def _bars(rows: Sequence[tuple[str, float | None]], mark: float | None = None, width: int = 640) -> str:
    """A bar for each label, and a dashed line at `mark`."""
    top = max([abs(v) for _, v in rows if v is not None] + ([mark] if mark else []) + [1e-12])
    at = lambda v: 160 + max(v, 0) / top * (width - 240)
    out = [f'<text x="0" y="{20 * i + 14}">{html.escape(n)}</text>' + ("" if v is None else f'<rect x="160" y="{20 * i + 3}" width="{at(v) - 160:.1f}" height="13" fill="#336"/><text x="{at(v) + 4:.1f}" y="{20 * i + 14}">{v:.4g}</text>') for i, (n, v) in enumerate(rows)]
    if mark is not None:
        out.append(f'<line x1="{at(mark):.1f}" x2="{at(mark):.1f}" y1="0" y2="{20 * len(rows)}" stroke="#a33" stroke-dasharray="4 3"/>')
    return f'<svg width="{width}" height="{20 * len(rows) + 4}">{"".join(out)}</svg>'


def forecast_chart(ledger: DataFrame, group: Mapping[str, object]) -> DataFrame:
    """One group's ledger rows of one model as a series with its interval."""
    return ledger.where(decompose.where_equal(group)).select(F.col("run_date").alias("x"), F.col("y_true").alias("y"), "q05", "q50", "q95", "origin").orderBy("x")


def report(title: str, sections: Mapping[str, DataFrame], series: Mapping[str, DataFrame] | None = None, rows: int = 50, bars: Mapping[str, tuple[DataFrame, float | None]] | None = None) -> str:
    """Self-contained HTML: up to `rows` rows of each section, bars (label, value) with a mark, and a chart for each series.

    A series has x and y, or its first two columns are taken as such, and may have q05, q50, q95 and origin; up to CHART_POINTS points.
    """
    parts = [f"<h2>{html.escape(n)}</h2>{_table(d, rows)}" for n, d in sections.items()]
    for n, (d, mark) in (bars or {}).items():
        parts.append(f"<h2>{html.escape(n)}</h2>{_bars([(str(r[0]), None if r[1] is None else float(r[1])) for r in d.limit(rows).collect()], mark)}")
    for n, d in (series or {}).items():
        named = d if "x" in d.columns else d.toDF("x", "y", *d.columns[2:])
        parts.append(f"<h2>{html.escape(n)}</h2>{_chart(sorted((r.asDict() for r in named.limit(CHART_POINTS).collect()), key=lambda r: r['x']))}")
    return f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><style>body{{font:14px sans-serif}}td,th{{padding:2px 8px;text-align:left}}</style><h1>{html.escape(title)}</h1>{''.join(parts)}"


def top_groups(frame: DataFrame, keys: Sequence[str], n: int = 3, col: str = "cost") -> DataFrame:
    """The n groups of largest spend."""
    return frame.groupBy(*keys).agg(F.sum(col).alias("spend")).orderBy(F.col("spend").desc(), *keys).limit(n)


def reconciliation(tables: dict[str, DataFrame]) -> DataFrame:
    return joins.reconciliation_summary(joins.reconcile(tables["raw_cost"], tables["job_cost"]))
