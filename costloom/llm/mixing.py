"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The cells' token totals are raked: scaled so that each
dimension's marginal meets its targets in turn, over and over. The resulting factor of a cell, divided by the largest, is
the chance that each of its documents is drawn, so the expected tokens of the draw have the target marginals.

Targets: a marginal's share is its token share raised to an exponent (1 keeps the mixture, 0 levels it), or an explicit
weight for each value; values without a weight share what is left by their tokens. A topic is the first rule whose
pattern a text holds.

Sweeps go on until each marginal is within a tolerance of its target; what is left is logged. Documents are only touched by
DataFrame functions; the few cells are swept on the driver, many as a DataFrame. Defined results: null source or language is a value of its own, `-`; null or wordless
text has no tokens, its own cell's factor still draws it; repeated rows draw alike; a null doc_id draws like id `-`; an
empty table gives an empty result; further columns are kept by `drawn`.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spare, stored

#: (topic, pattern), the first that matches; else `prose`.
TOPICS = (
    ("license", "(?i)licen[sc]ed? (under|text)|license, version|public license"),
    ("markup", r"\S(\*\*\*|###|%%%|&&&|\$\$\$)"),
    ("table", r" \| \S+ \| "),
    ("loud", r"[A-Z]{2,}!! "),
)
DIMENSIONS = ("source", "lang", "topic")
EXPONENTS = {"source": 0.7, "lang": 0.5, "topic": 0.8}
#: Sweeps that are always made. More follow until no marginal is off its target by more than TOLERANCE of it, up to MOST:
#: targets that no weights of the given cells can meet would go on for ever. The residual is logged, a larger one as a warning.
SWEEPS, MOST = 12, 20_000
#: It is above what the SQL's 12 sweeps leave on sf0.001 (2e-6; 5e-13 on sf0.01), whose rows the query has to give.
TOLERANCE = 1e-5
#: Up to so many cells are swept on the driver; more as DataFrames.
LOCAL_CELLS = 1_000_000

log = logging.getLogger(__name__)


def topic(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return F.coalesce(out, F.lit("prose"))


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens (words between white space)."""
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("-")).alias("source"), F.coalesce(F.col("lang").cast("string"), F.lit("-")).alias("lang"), topic(F.col("text")).alias("topic"), words.alias("n_tokens"))


def _shares(cells: DataFrame, dim: str, target: float | Mapping[str, float]) -> DataFrame:
    """(dim, goal): target shares of the tokens, in all 1."""
    by = cells.groupBy(dim).agg(F.sum("tokens").alias("t"))
    total = lambda df, c: df.agg(F.sum(c)).first()[0] or 1
    if isinstance(target, Mapping):
        given = F.coalesce(*(F.when(F.col(dim) == k, F.lit(float(v))) for k, v in target.items()))
        left = max(0.0, 1.0 - sum(target.values()))
        by = by.withColumn("g", given)
        raw = F.coalesce("g", F.col("t") / F.lit(total(by.where("g IS NULL"), "t")) * left)
    else:
        raw = F.pow(F.col("t").cast("double"), F.lit(float(target)))
    by = by.withColumn("raw", raw)
    return by.select(dim, (F.col("raw") / F.lit(total(by, "raw"))).alias("goal"))


def _swept(weight: np.ndarray, at: list[np.ndarray], goals: list[np.ndarray], sweeps: int) -> tuple[np.ndarray, float, int]:
    """The raked weights, the largest relative deviation of a marginal, and the sweeps made. at: the value of each dimension in each cell."""
    for k in range(1, max(sweeps, MOST) + 1):
        before = weight
        for i, goal in zip(at, goals):
            now = np.bincount(i, weight, len(goal))
            weight = weight * np.divide(goal, now, out=np.zeros(len(goal)), where=now > 0)[i]
        off = max(float(np.abs(np.bincount(i, weight, len(goal))[goal > 0] / goal[goal > 0] - 1).max()) for i, goal in zip(at, goals))
        # weights that a whole sweep leaves as they are will not come closer
        if k >= sweeps and (off <= TOLERANCE or np.array_equal(weight, before)):
            break
    return weight, off, k


def _report(off: float, k: int) -> None:
    log.log(logging.INFO if off <= TOLERANCE else logging.WARNING, "raking: %d sweeps, largest relative deviation of a marginal %.3g (tolerance %.0e)", k, off, TOLERANCE)


def raked(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = EXPONENTS, sweeps: int = SWEEPS) -> DataFrame:
    """The cells (dimensions, tokens > 0) with `weight`, their share of the tokens after raking (at least `sweeps` sweeps, and as many as the tolerance asks); stored."""
    out = cells
    for dim, target in targets.items():
        out = out.join(_shares(cells, dim, target).withColumnRenamed("goal", f"goal_{dim}"), dim)
    out = stored(out.withColumn("weight", F.col("tokens").cast("double")))
    n = out.count()
    if not n:
        return out.drop(*(f"goal_{d}" for d in targets))
    if n <= LOCAL_CELLS:
        rows = out.drop("weight").orderBy(*targets).toArrow()
        at, goals = [], []
        for dim in targets:
            _, first, i = np.unique(rows.column(dim).to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
            at.append(i)
            goals.append(rows.column(f"goal_{dim}").to_numpy()[first])
        weight, off, k = _swept(rows.column("tokens").to_numpy().astype(np.float64), at, goals, sweeps)
        _report(off, k)
        rows = rows.drop_columns([f"goal_{d}" for d in targets]).append_column("weight", pa.array(weight))
        return stored(cells.sparkSession.createDataFrame(rows, out.drop(*(f"goal_{d}" for d in targets)).schema))
    k, off = 0, math.inf
    while k < max(sweeps, MOST) and (k < sweeps or off > TOLERANCE):
        for dim in targets:  # sums combine before they move, a value with most of the cells is no hot key
            sums = out.groupBy(F.col(dim).alias("_d")).agg(F.sum("weight").alias("_w"))
            out = out.join(sums, F.col(dim) == F.col("_d")).withColumn("weight", F.when(F.col("weight") > 0, F.col("weight") * F.col(f"goal_{dim}") / F.col("_w")).otherwise(0.0)).drop("_d", "_w")
        out, k = stored(out), k + 1  # else the plan grows with the sweeps
        offs = [out.groupBy(d).agg(F.sum("weight").alias("w"), F.first(f"goal_{d}").alias("g")).where("g > 0").agg(F.max(F.abs(F.col("w") / F.col("g") - 1))).first()[0] for d in targets]
        last, off = off, max(offs)
        if k >= sweeps and off == last:
            break
    _report(off, k)
    return out.drop(*(f"goal_{d}" for d in targets))


def unit(col: Column, seed: str) -> Column:
    """A number in [0, 1) that only the value and the seed decide."""
    text = F.concat(F.lit(seed), F.lit(":"), F.coalesce(col.cast("string"), F.lit("-")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)


def chances(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]], sweeps: int) -> DataFrame:
    """(dimensions, p): the chance of each cell's documents; broadcast if its rows are few."""
    cells = stored(labelled(docs).groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")))
    fit = raked(cells.where("tokens > 0"), targets, sweeps).withColumn("factor", F.col("weight") / F.col("tokens"))
    top = fit.agg(F.max("factor")).first()[0]
    out = stored(fit.select(*DIMENSIONS, (F.col("factor") / F.lit(top)).alias("p")))
    return F.broadcast(out) if out.count() <= 100_000 else out


def mixed(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = EXPONENTS, sweeps: int = SWEEPS, seed: str = "mix") -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, prob (rounded to 9 digits; the draw takes it whole), sampled, for each document."""
    out = labelled(docs).join(chances(docs, targets, sweeps), list(DIMENSIONS), "left").withColumn("p", F.coalesce("p", F.lit(1.0)))
    return out.select("doc_id", *DIMENSIONS, "n_tokens", F.round("p", 9).alias("prob"), (unit(F.col("doc_id"), seed) < F.col("p")).alias("sampled"))


def drawn(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = EXPONENTS, sweeps: int = SWEEPS, seed: str = "mix") -> DataFrame:
    """The drawn documents, all their columns, with `topic`, `prob` and n_tokens after them (a column so named before is replaced)."""
    base = docs.drop("topic", "prob", "n_tokens")
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    s, l, t, p = spare([*base.columns, "topic", "prob", "n_tokens"], "_s", "_l", "_t", "_p")
    near = chances(docs, targets, sweeps).withColumnsRenamed({"source": s, "lang": l, "topic": t, "p": p})
    own = base.withColumn("topic", topic(F.col("text")))
    on = (F.coalesce(F.col("source").cast("string"), F.lit("-")) == F.col(s)) & (F.coalesce(F.col("lang").cast("string"), F.lit("-")) == F.col(l)) & (F.col("topic") == F.col(t))
    out = own.join(near, on, "left").withColumn(p, F.coalesce(p, F.lit(1.0))).where(unit(F.col("doc_id"), seed) < F.col(p))
    return out.select(*base.columns, "topic", F.round(p, 9).alias("prob"), words.alias("n_tokens"))


def oracle() -> str:
    """DuckDB SQL for `mixed` with its defaults."""
    case = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS)
    sql = f"""
WITH own AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '-') AS source, coalesce(lang, '-') AS lang, CASE {case} ELSE 'prose' END AS topic,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM own GROUP BY ALL HAVING sum(n_tokens) > 0)"""
    for d in DIMENSIONS:
        sql += f""",
g_{d} AS MATERIALIZED (SELECT {d}, r / sum(r) OVER () AS goal FROM (SELECT {d}, pow(CAST(sum(tokens) AS DOUBLE), {EXPONENTS[d]}) AS r FROM cells GROUP BY 1))"""
    last = "s0"
    sql += ",\ns0 AS MATERIALIZED (SELECT source, lang, topic, CAST(tokens AS DOUBLE) AS tokens, CAST(tokens AS DOUBLE) AS weight FROM cells)"
    for k in range(SWEEPS):
        for d in DIMENSIONS:
            name = f"s{k}_{d}"
            sql += f",\n{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, weight * goal / sum(weight) OVER (PARTITION BY {d}) AS weight FROM {last} JOIN g_{d} USING ({d}))"
            last = name
    return sql + f""",
p AS (SELECT source, lang, topic, (weight / tokens) / max(weight / tokens) OVER () AS prob FROM {last}),
j AS (SELECT doc_id, source, lang, topic, n_tokens, coalesce(prob, 1.0) AS prob FROM own LEFT JOIN p USING (source, lang, topic))
SELECT doc_id, source, lang, topic, n_tokens, round(prob, 9) AS prob,
  CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0 < prob AS sampled FROM j
"""


ORACLE = oracle()
