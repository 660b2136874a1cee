"""Quantile gradient boosting.

Trees split on binned features; a leaf's value is the quantile of its rows' residuals (for the mean booster, their mean).
Missing values have a bin of their own, and so has every label. The trees are grown on the driver from a bounded sample of the training rows
(`max_rows` of smallest hash); every row is scored on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FrameSpec
from ..functions.scalars import TRANSFORMS

MAX_ROWS = 200_000
QUANTILES = {"q05": 0.05, "q50": 0.5, "q95": 0.95}
TAIL_DAYS, MIN_TAIL = 60, 30


@dataclass
class Booster:
    """bias and trees of (features, cuts, values, training rows of each leaf), breadth first; a row goes right if its bin is above the cut."""

    bias: float
    trees: list
    gain: list

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(bins), self.bias), np.arange(len(bins))
        for feature, cut, value, _ in self.trees:
            node = np.zeros(len(bins), int)
            feature, cut, value = np.asarray(feature, int), np.asarray(cut, int), np.asarray(value, float)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            out += value[node - len(feature)] if node.size else 0
        return out

    def contributions(self, bins: np.ndarray) -> np.ndarray:
        """(rows, features + 1): Shapley values of each row's features, then the expected value; they add up to the prediction.

        The value of a set of features is the tree's mean where splits on others are passed by the shares of training rows
        that went either way. A tree of few levels has few features, so their sets are all gone through.
        """
        n_feat = len(self.gain)
        out = np.zeros((len(bins), n_feat + 1))
        out[:, -1] = self.bias
        for feature, cut, value, cover in self.trees:
            inner = len(feature)
            used = sorted({feature[i] for i in range(inner) if cut[i] < np.iinfo(np.int32).max})
            rows_in = [0.0] * inner + list(map(float, cover))
            for i in range(inner - 1, -1, -1):
                rows_in[i] = rows_in[2 * i + 1] + rows_in[2 * i + 2]

            def mean(x: np.ndarray, known: int, node: int = 0) -> float:
                if node >= inner:
                    return value[node - inner]
                left = 2 * node + 1
                if feature[node] in used and known >> used.index(feature[node]) & 1:
                    return mean(x, known, left + int(x[feature[node]] > cut[node]))
                share = rows_in[left] / rows_in[node] if rows_in[node] else 0.5
                return share * mean(x, known, left) + (1 - share) * mean(x, known, left + 1)

            m = len(used)
            for r, x in enumerate(bins):
                by_set = [mean(x, s) for s in range(1 << m)]
                out[r, -1] += by_set[0]
                for j, f in enumerate(used):
                    for s in range(1 << m):
                        if not s >> j & 1:
                            k = s.bit_count()
                            out[r, f] += factorial(k) * factorial(m - k - 1) / factorial(m) * (by_set[s | 1 << j] - by_set[s])
        return out

    def to_json(self) -> dict:
        return {"bias": self.bias, "gain": list(map(float, self.gain)), "trees": [[list(map(int, f)), list(map(int, c)), list(map(float, v)), list(map(int, n))] for f, c, v, n in self.trees]}

    @classmethod
    def from_json(cls, x: dict) -> Booster:
        return cls(x["bias"], x["trees"], x["gain"])


def boost(bins: np.ndarray, y: np.ndarray, tau: float | None, rounds: int = 60, depth: int = 3, rate: float = 0.1, valid: np.ndarray | None = None, patience: int = 15) -> Booster:
    """tau None: least squares. valid marks rows that only decide when to stop; the best number of rounds is kept."""
    fit = ~valid if valid is not None else np.ones(len(y), bool)
    loss = (lambda d: (d**2).mean()) if tau is None else (lambda d: np.maximum(tau * d, (tau - 1) * d).mean())
    start = float(y[fit].mean() if tau is None else np.quantile(y[fit], tau))
    f, b, trees, gain, best, best_at = np.full(len(y), start), bins, [], np.zeros(bins.shape[1]), np.inf, 0
    n_inner, n_bins, never = (1 << depth) - 1, int(bins.max(initial=0)) + 1, int(np.iinfo(np.int32).max)
    for r in range(rounds):
        d = y - f
        g = d if tau is None else np.where(d > 0, tau, tau - 1)
        node = np.zeros(len(y), int)
        feature, cut = np.zeros(n_inner, int), np.full(n_inner, never)
        for lvl in range(depth):
            lo, k = (1 << lvl) - 1, 1 << lvl
            top = np.full(k, 1e-12)
            for j in range(b.shape[1]):
                key = (node[fit] - lo) * n_bins + b[fit, j]
                s = np.bincount(key, g[fit], k * n_bins).reshape(k, n_bins).cumsum(1)
                c = np.bincount(key, minlength=k * n_bins).reshape(k, n_bins).cumsum(1)
                ts, tc = s[:, -1:], c[:, -1:]
                ok = (c >= 10) & (tc - c >= 10)
                got = np.where(ok, s**2 / np.maximum(c, 1) + (ts - s) ** 2 / np.maximum(tc - c, 1) - ts**2 / np.maximum(tc, 1), 0)
                at = got.argmax(1)
                v = got[np.arange(k), at]
                m = v > top
                top[m] = v[m]
                feature[lo : lo + k][m], cut[lo : lo + k][m] = j, at[m]
            for i in range(k):
                if cut[lo + i] < never:
                    gain[feature[lo + i]] += top[i]
            node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - n_inner
        value = np.zeros(n_inner + 1)
        for i in np.unique(leaf[fit]):
            x = d[fit & (leaf == i)]
            value[i] = rate * (x.mean() if tau is None else np.quantile(x, tau))
        f = f + value[leaf]
        trees.append((feature.tolist(), cut.tolist(), value.tolist(), np.bincount(leaf[fit], minlength=n_inner + 1).tolist()))
        if valid is not None and valid.any():
            now = loss(y[valid] - f[valid])
            if now < best - 1e-12:
                best, best_at = now, r + 1
            elif r + 1 - best_at >= patience:
                break
    return Booster(start, trees[: best_at or len(trees)] if valid is not None and valid.any() else trees, gain.tolist())


class QuantileGBM:
    """Boosters at 5, 50 and 95 % of the transformed target and one of its mean."""

    def __init__(self, features: Sequence[str], categorical: Sequence[str] = (), transform: str = "asinh", rounds: int = 60, max_rows: int = MAX_ROWS):
        self.features, self.categorical, self.transform, self.rounds, self.max_rows = list(features), list(categorical), transform, rounds, max_rows
        self.edges: dict[str, np.ndarray] = {}
        self.levels: dict[str, list[str]] = {}
        self.boosters: dict[str, Booster] = {}

    def bins(self, x: pd.DataFrame) -> np.ndarray:
        """Missing and unknown labels are bin 0."""
        out = np.zeros((len(x), len(self.features)), int)
        for j, c in enumerate(self.features):
            if c in self.categorical:
                at = {v: i + 1 for i, v in enumerate(self.levels[c])}
                out[:, j] = [at.get(v, 0) for v in x[c]]
            else:
                v = pd.to_numeric(x[c], errors="coerce").to_numpy(float)
                out[:, j] = np.where(np.isnan(v), 0, 1 + np.searchsorted(self.edges[c], np.nan_to_num(v)))
        return out

    def fit(self, train: DataFrame, spec: FrameSpec) -> QuantileGBM:
        own = train.where(F.col(spec.target).isNotNull())
        cols = [F.col(c).cast("string" if c in self.categorical else "double").alias(c) for c in self.features]
        keyed = own.select(*cols, F.col(spec.date_col).alias("_day"), F.col(spec.target).cast("double").alias("_y"), F.xxhash64(spec.date_col, *spec.group_keys).alias("_h"))
        got = keyed.orderBy("_h").limit(self.max_rows).toPandas().sort_values(["_day", "_h"]).reset_index(drop=True)
        if got.empty:
            raise ValueError("no training rows")
        fwd = {"asinh": np.arcsinh, "log1p": np.log1p, "none": lambda v: v}[self.transform]
        for c in self.features:
            if c in self.categorical:
                n = got[c].value_counts()
                self.levels[c] = sorted(n.index)
            else:
                v = got[c].dropna().to_numpy(float)
                self.edges[c] = np.unique(np.quantile(v, np.linspace(0, 1, 64)[1:-1])) if len(v) else np.empty(0)
        b, y = self.bins(got), got["_y"].to_numpy(float)
        day = pd.to_datetime(got["_day"])
        late = (day > day.max() - pd.Timedelta(days=TAIL_DAYS)).to_numpy()
        stop = late if late.sum() >= MIN_TAIL and (~late).sum() >= MIN_TAIL else None
        for name, tau in [*QUANTILES.items(), ("mean", None)]:
            t = y if tau is None else fwd(y)
            trial = boost(b, t, tau, self.rounds, valid=stop)
            self.boosters[name] = boost(b, t, tau, max(len(trial.trees), 1)) if stop is not None else trial
        return self

    def predict(self, test: DataFrame) -> DataFrame:
        """test with q05 <= q50 <= q95 and pred_mean, none below 0."""
        me, kind = self, test.schema
        cols = test.columns

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for x in batches:
                b = me.bins(x)
                for q in QUANTILES:
                    x[f"_{q}"] = me.boosters[q].predict(b)
                x["pred_mean"] = np.maximum(me.boosters["mean"].predict(b), 0)
                yield x

        raw = test.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kind), *(f"_{q} double" for q in QUANTILES), "pred_mean double"]))
        back = TRANSFORMS[self.transform][1]
        order = F.array_sort(F.array(*(back(F.col(f"_{q}")) for q in QUANTILES)))
        return raw.select(*cols, *(F.greatest(order[i], F.lit(0.0)).alias(q) for i, q in enumerate(QUANTILES)), "pred_mean")

    def importance(self) -> list[tuple[str, float]]:
        total = np.sum([b.gain for b in self.boosters.values()], 0)
        return sorted(zip(self.features, map(float, total)), key=lambda x: (-x[1], x[0]))

    def explain(self, row: pd.DataFrame, booster: str = "mean") -> dict[str, float]:
        """Each feature's contribution to one row's prediction, and `base`; they add up to it within 1e-6."""
        b = self.bins(row)
        c = self.boosters[booster].contributions(b)[0]
        if abs(c.sum() - self.boosters[booster].predict(b)[0]) > 1e-6:
            raise AssertionError("contributions don't add up to the prediction")
        return dict(zip([*self.features, "base"], map(float, c)))

    def state(self) -> dict[str, dict]:
        """JSON of each booster, each with the bins, so that a bundle is whole."""
        common = {"edges": {c: list(map(float, e)) for c, e in self.edges.items()}, "levels": self.levels, "features": self.features, "categorical": self.categorical, "transform": self.transform}
        return {n: {"booster": b.to_json(), **common} for n, b in self.boosters.items()}

    @classmethod
    def from_state(cls, state: dict[str, dict]) -> QuantileGBM:
        first = next(iter(state.values()))
        out = cls(first["features"], first["categorical"], first["transform"])
        out.edges = {c: np.array(e) for c, e in first["edges"].items()}
        out.levels = first["levels"]
        out.boosters = {n: Booster.from_json(s["booster"]) for n, s in state.items()}
        return out


def transform_experiment(train: DataFrame, test: DataFrame, spec: FrameSpec, features: Sequence[str], categorical: Sequence[str] = (), names: Sequence[str] = ("asinh", "log1p", "none")) -> list[tuple[str, float]]:
    """(transform, |bias|) of the summed medians, best first."""
    out = []
    for n in names:
        p = QuantileGBM(features, categorical, n).fit(train, spec).predict(test)
        a, f = p.agg(F.sum(F.col(spec.target).cast("double")), F.sum("q50")).first()
        out.append((n, abs((f - a) / a) if a else float("inf")))
    return sorted(out, key=lambda x: x[1])
