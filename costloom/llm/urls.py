"""URL filters: listed rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host, all its subdomains with it, and a start of the path; the longest that fits decides. The trees learn
from URLs with known verdicts (here: those that rules decide) and read only the URL's letters: lengths, depth, digit
share, character entropy, parameters, hyphens, labels, and how often the host's last labels are blocked.

How often a suffix is blocked is counted over all distinct labelled URLs and joined to the URLs; the rows that the trees learn
from are rated by the other folds' labels. The trees are fitted on the
driver to a bounded sample of them: of each verdict the rows of smallest hash, a twentieth of SAMPLE at least where there
are so many, weighted to stand for all of that verdict. Every URL is judged.

Defined results: host and path are empty for null and for text without ://; no rule fits an empty host; a rule's path is a
plain prefix; without labelled URLs, or with one verdict only, the rest get `allow` or that verdict; repeated rows are
judged alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: (verdict, host/path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
SAMPLE = 20_000
#: Folds of the labelled URLs: a suffix's rate, where it is learned from, is that of the other folds.
FOLDS = 5
#: Suffixes of up to so many rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
ROUNDS, LEAVES_DEPTH, RATE, BINS = 60, 3, 0.2, 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    rest = F.regexp_extract(url, r"^(?s)(.*?)://(.*)$", 2)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The rule (host/path) that decides, else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        h, p = rule.split("/", 1)
        out = F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}"), rule).otherwise(out)
    return out


def suffixes(host: Column) -> tuple[Column, Column]:
    """The last label of a host, and the last two."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)


#: Of a URL, with the two rates.
FEATURES = 12


def lexical(url: Column, host: Column, path: Column) -> Column:
    """The features of a URL but for its suffixes' rates, as an array: lengths of the URL, its host and path, depth, digit share, entropy of its characters (bits), parameters, hyphens, labels, length of the first label."""
    u = F.coalesce(url, F.lit(""))
    size = F.length(u)
    some = F.greatest(size, F.lit(1)).cast("double")
    tail = F.regexp_extract(u, r"^(?s).*?://[^/?#]*(.*)$", 1)
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern))
    # -sum of p log2 p = log2 n - sum of c log2 c / n over the different characters' counts c
    chars = F.array_distinct(F.split(u, ""))
    each = F.transform(chars, lambda c: (size - F.length(F.replace(u, c, F.lit("")))).cast("double"))
    logs = F.aggregate(each, F.lit(0.0), lambda s, c: s + F.when(c > 0, c * F.log2(c)).otherwise(0.0))
    entropy = F.log2(some) - logs / some
    labels = F.split(host, "[.]")
    return F.array(*(c.cast("double") for c in (size, F.length(host), F.length(path), count(path, "/"), count(u, "[0-9]") / some, entropy, count(tail, "[=&]"), count(host, "-"), F.size(labels), F.length(F.get(labels, F.lit(0))))))


class Trees:
    """Gradient-boosted trees for the log odds of `block`, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, w: np.ndarray):
        """w: how many rows each one stands for."""
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._bins(x)
        p = np.clip(np.average(y, weights=w), 1e-6, 1 - 1e-6)
        self.bias, self.trees = float(np.log(p / (1 - p))), []
        f = np.full(len(y), self.bias)
        for _ in range(ROUNDS):
            prob = 1 / (1 + np.exp(-f))
            tree, leaf = self._grow(b, w * (y - prob), w * prob * (1 - prob))
            self.trees.append(tree)
            f += tree[2][leaf]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    @staticmethod
    def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray):
        """A tree of full depth as (feature, cut) of its inner nodes, breadth first, and the leaves' values."""
        n_inner = (1 << LEAVES_DEPTH) - 1
        feature, cut = np.zeros(n_inner, int), np.full(n_inner, BINS)
        node = np.zeros(len(b), int)
        for d in range(LEAVES_DEPTH):
            lo, k = (1 << d) - 1, 1 << d
            best = np.full(k, 1e-9)
            for j in range(b.shape[1]):
                key = (node - lo) * BINS + b[:, j]
                sg = np.bincount(key, g, k * BINS).reshape(k, BINS).cumsum(1)
                sh = np.bincount(key, h, k * BINS).reshape(k, BINS).cumsum(1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg**2 / (th + 1)
                at = gain.argmax(1)
                top = gain[np.arange(k), at]
                better = top > best + 1e-12
                best[better] = top[better]
                feature[lo : lo + k][better], cut[lo : lo + k][better] = j, at[better]
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        leaf = node - n_inner
        sg, sh = np.bincount(leaf, g, n_inner + 1), np.bincount(leaf, h, n_inner + 1)
        return (feature, cut, RATE * sg / (sh + 1)), leaf

    def chance(self, x: np.ndarray) -> np.ndarray:
        """The probability of `block`."""
        b = self._bins(x)
        f = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(LEAVES_DEPTH):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            f += value[node - len(feature)]
        return 1 / (1 + np.exp(-f))


class UrlModel:
    """The trees over (features, rates of the last label and the last two) of labelled URLs; one verdict alone is its own model."""

    def __init__(self, x: np.ndarray, y: np.ndarray, base: float, weights: np.ndarray):
        """y: 1 if blocked. base: the share of all labelled URLs that is. weights: how many URLs each row stands for."""
        self.base = base
        self.trees = Trees(x, y, weights) if len(y) and 0 < base < 1 else None

    def chance(self, x: np.ndarray) -> np.ndarray:
        return self.trees.chance(x) if self.trees is not None and len(x) else np.full(len(x), self.base)


def fold(url: Column) -> Column:
    """The fold of a labelled URL."""
    return F.pmod(F.xxhash64(F.lit("fold"), url), F.lit(FOLDS))


def rated(labelled: DataFrame) -> tuple[DataFrame, float]:
    """(suffix, fold, b, n) over all of the labelled (url, host, v), stored: blocked and all URLs; and the share that is blocked."""
    ends = F.array_distinct(F.array(*suffixes(F.col("host"))))
    n, blocked = labelled.agg(F.count("*"), F.sum("v")).first()
    base = (blocked or 0) / n if n else 0.0
    return stored(labelled.select(F.explode(ends).alias("suffix"), fold(F.col("url")).alias("fold"), "v").groupBy("suffix", "fold").agg(F.sum("v").alias("b"), F.count("*").alias("n"))), base


def with_rates(urls: DataFrame, counts: DataFrame, base: float, own: bool = False) -> DataFrame:
    """urls (url, host, ...) and `r1`, `r2`: how often labelled URLs of the host's last label, and of its last two, are blocked; the base rate where there are none.

    own: the urls are labelled ones, and each is rated by the other folds alone, so that no rate knows its own label.
    """
    by = counts.groupBy("suffix").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
    if own:
        by = by.alias("a").join(counts.alias("c"), "suffix").select("suffix", "fold", (F.col("a.b") - F.col("c.b")).alias("b"), (F.col("a.n") - F.col("c.n")).alias("n"))
    rates = stored(by.withColumn("rate", (F.col("b") + base) / (F.col("n") + 1)).drop("b", "n"))
    near = F.broadcast(rates) if rates.count() <= BROADCAST_ROWS else rates
    out = urls
    for name, end in zip(("r1", "r2"), suffixes(F.col("host"))):
        side = near.select(F.col("suffix").alias("_s"), *([F.col("fold").alias("_f")] if own else []), F.col("rate").alias(name))
        on = F.col("_e") == F.col("_s")
        on = on & (fold(F.col("url")) == F.col("_f")) if own else on
        out = out.withColumn("_e", end).join(side, on, "left").drop("_s", "_f", "_e").withColumn(name, F.coalesce(name, F.lit(base)))
    return out


def featured(urls: DataFrame) -> DataFrame:
    """urls (url, host, path, r1, r2, ...) with x, all features."""
    return urls.withColumn("x", F.concat(lexical(F.col("url"), F.col("host"), F.col("path")), F.array("r1", "r2"))).drop("r1", "r2")


def sampled(labelled: DataFrame, size: int) -> list[tuple[DataFrame, float]]:
    """Of each verdict the rows of smallest hash, and how many labelled URLs each of them stands for: in proportion, but a twentieth of `size` at least where there are so many."""
    have = {r.v: r.n for r in labelled.groupBy("v").agg(F.count("*").alias("n")).collect()}
    total, floor, out = sum(have.values()), -(-size // 20), []
    take = {v: n if total <= size else min(n, max(floor, size * n // total)) for v, n in have.items()}
    if sum(take.values()) > size:
        most = max(take, key=take.get)
        take[most] -= sum(take.values()) - size
    for v, n in take.items():
        out.append((labelled.where(F.col("v") == v).orderBy(F.xxhash64("url"), "url").limit(n), have[v] / n))
    return out


def fitted(labelled: DataFrame, size: int = SAMPLE) -> tuple[UrlModel, DataFrame]:
    """labelled: (url, blocked 0 or 1). The model of a sample of `size` distinct ones, with the suffix counts of all of them."""
    host, path = parts(F.col("url"))
    own = stored(labelled.where("url IS NOT NULL AND blocked IS NOT NULL").select("url", host.alias("host"), path.alias("path"), F.col("blocked").cast("int").alias("v")).distinct())
    counts, base = rated(own)
    got = sorted((r.url, r.v, w, r.x) for few, w in sampled(own, size) for r in featured(with_rates(few, counts, base, own=True)).collect())
    x = np.array([g[3] for g in got]).reshape(len(got), FEATURES)
    return UrlModel(x, np.array([g[1] for g in got], float), base, np.array([g[2] for g in got], float)), counts


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, size: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict, block_chance (null where a rule decides) of each url."""
    url = F.col("url").cast("string")
    host, path = parts(url)
    own = pages.select("page_id", url.alias("url"), host.alias("host"), path.alias("path"))
    own = own.withColumn("rule", fitting(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for kind, rule in rules:
        verdict = F.when(F.col("rule") == rule, kind).otherwise(verdict)
    own = own.withColumn("by_rule", verdict)
    fit, counts = fitted(own.where("rule IS NOT NULL").select("url", (F.col("by_rule") == "block").cast("int").alias("blocked")), size)
    model = own.sparkSession.sparkContext.broadcast(fit)
    own = featured(with_rates(own, counts, fit.base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rule = part.column("by_rule")
            open_ = np.flatnonzero(rule.is_null().to_numpy(zero_copy_only=False))
            x = part.column("x").flatten().to_numpy().reshape(part.num_rows, FEATURES)
            chance = np.full(part.num_rows, np.nan)
            chance[open_] = model.value.chance(x[open_])
            verdict = pc.coalesce(rule, pa.array(np.where(chance >= 0.5, "block", "allow")).cast(pa.string()))
            cols = [part.column(c) for c in ("page_id", "host", "path", "rule")]
            yield pa.RecordBatch.from_arrays([*cols, verdict, pa.array(chance, mask=np.isnan(chance))], ["page_id", "host", "path", "rule", "verdict", "block_chance"])

    kind = own.schema["page_id"].dataType.simpleString()
    return own.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, block_chance double")


ORACLE_RULES = """
SELECT page_id, host, path, CASE
  WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
FROM (SELECT page_id, translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages)
"""
