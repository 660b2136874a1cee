"""MinHash near-duplicate groups from bottom-k sketches of one hash function.

A document's set holds the 64-bit hashes of its distinct word shingles; its sketch is the k smallest. Documents with
equal sets (128-bit fingerprint and size) become one node. Inverted lists of the retained values give candidates: a
node's values are taken rarest first, and only so many that two nodes as similar as asked must share one (sets of up to
k * threshold shingles: certain; larger ones: they miss each other with a chance under 1e-10). A list is never expanded
into all its pairs: first every member meets the list's smallest node (union-sketch estimation drops hopeless pairs, the
exact Jaccard index of the full sets confirms the rest); when the components of these links are known, only members of
different components meet again, by exact bounds on their full sets.

Defined results: null or wordless text has an empty set, is linked with nothing and kept; fewer words than a shingle
make one shingle; ids keep their type and order as it does; a null doc_id is linked with nothing, has a null component and is kept; repeated rows share a class and
each comes back; further columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, id_type, lists, mix, shingle_sets, steps, stored

#: A side of up to so many rows of a few longs (some 30 MB) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000


def overlap_bound(k: int, share: float, miss: float = 1e-10) -> int:
    """The most values that sketches of k, of sets this similar, share but for a chance of `miss`."""
    total, o = 0.0, 0
    while o < k:
        total += math.comb(k, o) * share**o * (1 - share) ** (k - o)
        if total > miss:
            return max(o, 1)
        o += 1
    return k


def _sketcher(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            sets = shingle_sets(Words(part.column(1)), width)
            salted = [mix(s.view(np.uint64) + np.uint64(0x5851F42D4C957F2D)) for s in sets]
            f1 = np.array([s.sum(dtype=np.uint64) for s in salted], np.uint64).view(np.int64)
            f2 = np.array([mix(s * np.uint64(5)).sum(dtype=np.uint64) for s in salted], np.uint64).view(np.int64)
            n = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(f1), pa.array(f2), lists([s[:k] for s in sets], pa.int64())], ["doc_id", "n", "f1", "f2", "sketch"])

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), lists(shingle_sets(Words(part.column(1)), width), pa.int64())], ["id", "s"])

    return run


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, to be broadcast if it has no more than so many rows; df is a stored table, so the count is cheap."""
    return F.broadcast(df) if df.count() <= rows else df


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): alternating large-star and small-star steps until nothing moves."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if now == mark or not now[0]:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = stored(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def inverted_lists(nodes: DataFrame, k: int, share: float) -> DataFrame:
    """(v, rep, n): each node under those of its retained values, rarest first, of which similar nodes must share one."""
    post = nodes.select("rep", "n", F.explode("sketch").alias("v"))
    df = post.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    must = F.when(F.col("n") <= int(k * share), F.ceil(F.col("n") * share - 1e-9)).otherwise(F.lit(overlap_bound(k, share)))
    take = (F.size("s") - must + 1).cast("int")  # of kept - must + 1 places, values that occur once take kept - size(s): they are the rarest
    own = post.join(df, "v").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("s")).withColumn("take", take).where("take > 0")
    return own.select(F.explode(F.slice("s", 1, F.col("take"))).alias("x"), "rep", "n").select("x.v", "rep", "n")


def _near(na: str, nb: str, num: int, den: int):
    return F.expr(f"{den} * least({na}, {nb}) >= {num} * greatest({na}, {nb})")


def _full(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, s): the full shingle sets of these documents; stored."""
    return stored(docs.join(bounded(ids), F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "text").mapInArrow(_full_sets(width), f"id {id_type(docs)}, s array<long>"))


def _exact(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    full = pairs.join(sets.withColumnsRenamed({"id": "a", "s": "sa"}), "a").join(sets.withColumnsRenamed({"id": "b", "s": "sb"}), "b")
    same = F.size(F.array_intersect("sa", "sb"))
    return stored(full.where(den * same >= num * (F.size("sa") + F.size("sb") - same)).select("a", "b").distinct())


def _starred(listed: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, num: int, den: int, k: int) -> DataFrame:
    """The links (a, b) between each list's smallest node and its other members."""
    pivot = listed.groupBy("v").agg(F.min(F.struct("rep", "n")).alias("p"))
    pairs = listed.join(pivot, "v").where(F.col("rep") > F.col("p.rep")).where(_near("n", "p.n", num, den)).select(F.col("p.rep").alias("a"), F.col("rep").alias("b")).distinct()
    share, sk = num / den, nodes.select("rep", "sketch")
    both = stored(pairs).join(sk.withColumnsRenamed({"rep": "a", "sketch": "sa"}), "a").join(sk.withColumnsRenamed({"rep": "b", "sketch": "sb"}), "b")
    union = F.expr(f"slice(array_sort(array_union(sa, sb)), 1, {k})")
    estimate = F.size(F.array_intersect(union, F.array_intersect("sa", "sb"))) / F.size(union)
    likely = stored(both.where(estimate >= share - 7 * math.sqrt(share * (1 - share) / k)).select("a", "b"))
    return _exact(likely, _full(docs, stored(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()), width), num, den)


def _apart(listed: DataFrame, comp: DataFrame) -> DataFrame:
    """(id, comp): nodes, smallest ones aside, of lists that still hold more than one component; stored."""
    pivot = listed.groupBy("v").agg(F.min("rep").alias("p"))
    rest = listed.join(pivot, "v").where("rep > p").join(comp.withColumnsRenamed({"node": "rep", "component": "comp"}), "rep", "left").select("v", F.col("rep").alias("id"), F.coalesce("comp", "rep").alias("comp"))
    mixed = rest.groupBy("v").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("v")
    return stored(rest.join(mixed, "v", "left_semi").select("id", "comp").distinct())


def _between(apart: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """All links (a, b) between nodes of different components, exactly.

    A shingle helps only if nodes of other components hold it. A node of which too few shingles help has no link, and
    leaves; that is repeated while it thins the nodes out. The others are joined on their rarest helping shingles, so many
    that two linked sets share one of them.
    """
    share = f"{num} * n <= {den}"
    live = stored(apart.join(sets, "id").select("id", "comp", F.size("s").cast("long").alias("n"), F.explode("s").alias("x")))
    before = None
    while True:
        df = live.groupBy("x").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("x", "c")
        helps = live.join(df, "x")
        nodes = helps.groupBy("id", "comp", "n").agg(F.sort_array(F.collect_list(F.struct("c", "x"))).alias("h")).where(f"{share} * size(h)")
        nodes = stored(nodes)
        now = nodes.count()
        if before is not None and now > 0.9 * before or now < 2:
            break
        before = now
        live = stored(nodes.select("id", "comp", "n", F.explode("h.x").alias("x")))
    # of n - ceil(share * n) + 1 places, the shingles that don't help take n - size(h): they come first
    take = F.expr(f"cast(size(h) - ceil({num} * n / {den} - 1e-9) + 1 as int)")
    key = stored(nodes.select("id", "comp", "n", F.size("h").alias("m"), F.posexplode(F.slice("h", F.lit(1), take)).alias("at", "hx")).select("id", "comp", "n", "m", "at", F.col("hx.x").alias("x")))
    other = key.select("x", F.col("id").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"), F.col("m").alias("mb"), F.col("at").alias("ab"))
    need = f"ceil({num} * (n + nb) / {num + den} - 1e-9)"
    # after the first shared shingle only so many can follow in either set
    pairs = key.join(other, "x").where(f"id < b AND comp <> cb AND least(m - at, mb - ab) >= {need}").select(F.col("id").alias("a"), "b").distinct()
    return _exact(stored(pairs), sets, num, den)


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, k: int = 64, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links lead to), kept (doc_id = component_id) for each document.

    Documents are linked if den * |A & B| >= num * |A | B| for their sets of `width`-word shingles. With exact, sketches are
    left aside and all nodes meet by exact bounds on their full sets: no chance of a miss, at the cost of every shingle.
    """
    kind = id_type(docs)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sets = stored(docs.mapInArrow(_sketcher(width, k), f"doc_id {kind}, n long, f1 long, f2 long, sketch array<long>"))
    nodes = stored(sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")))
    if exact:
        alone = nodes.select(F.col("rep").alias("id"), F.col("rep").alias("comp"))
        comp = stored(components(_between(alone, _full(docs, stored(alone.select("id")), width), num, den)))
    else:
        listed = stored(inverted_lists(nodes, k, num / den))
        edges = _starred(listed, nodes, docs, width, num, den, k)
        comp = stored(components(edges))
        apart = _apart(listed, comp)
        if apart.limit(1).count():
            more = _between(apart, _full(docs, apart.select("id").distinct(), width), num, den)
            comp = stored(components(edges.unionByName(more)))
    classes = nodes.join(comp, F.col("rep") == F.col("node"), "left").select("f1", "f2", "n", F.coalesce("component", "rep").alias("c"))
    out = sets.join(classes, ["f1", "f2", "n"], "left")
    comp_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp_id.alias("component_id"), F.coalesce(F.col("doc_id") == comp_id, F.lit(True)).alias("kept"))
