"""Benchmark decontamination over a stored positional inverted index.

The index holds a posting (term, text, position) for every word of the training texts, each segment sorted by term; it
knows nothing of a benchmark and serves any number of them. For each window of consecutive item words the rarest terms
are looked up; where their offset-adjusted postings meet on one alignment of item and text, the alignment is compared word
by word, and text words inside a full window are hits. Items are also sought by proximity: their rarest terms within a
span of words, in any order.

Everything is DataFrame functions. Alignments are compared block by block of the text, a row for each, so that neither a
long text nor a common word gathers an unbounded row. Defined results: null or wordless texts have no words and no hits;
an item without words matches nothing; repeated items count once, a null item_id as an item named by empty text; repeated
document rows each get their result, ids keep their type; further columns are ignored; empty tables give no rows, no hits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored

#: The words of a lower-cased text are runs of letters, digits and all beyond ASCII; what parts them.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Letters beyond ASCII that lower() would change, and code points that it may know and this pattern doesn't.
OTHER_UPPER = r"[[\p{javaUpperCase}\p{javaTitleCase}\p{Cn}]&&[^\x00-\x7F]]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A side of up to so many rows is broadcast; beyond it the join shuffles. IDS are a long or two each.
BROADCAST_ROWS, BROADCAST_IDS = 100_000, 1_000_000
#: Words of a text that one row compares.
BLOCK = 512


def lowered(text: Column) -> Column:
    """A-Z in lower case. Where no other letter has one, lower() does the same, and much faster than translate()."""
    return F.when(text.rlike(OTHER_UPPER), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def parted(text: str) -> Column:
    """An empty string, the words, and an empty string if a gap ends the text."""
    return F.split(lowered(F.concat(F.lit(" "), F.coalesce(F.col(text), F.lit("")))), GAP)


def words(text: str) -> Column:
    return F.array_remove(parted(text), "")


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@dataclass
class Index:
    """texts: (rid, doc_id, text), a row for each document row; postings: (th, term, rid, pos), th a hash of the term, and for each text one of the empty term at -1 with n_words."""

    texts: DataFrame
    postings: DataFrame

    def every(self) -> DataFrame:
        """(rid, n_words) of all texts."""
        return self.postings.where("pos < 0").select("rid", F.col("n_words").cast("long").alias("n_words"))

    def frequencies(self, terms: DataFrame) -> DataFrame:
        """(term, n): how often each of the terms occurs, if at all; stored."""
        return stored(self.found(terms).groupBy("term").agg(F.count("*").alias("n")))

    def found(self, wanted: DataFrame) -> DataFrame:
        """Postings (rid, pos) of the wanted rows' terms, with the rows' other columns."""
        rest = [c for c in wanted.columns if c != "term"]
        w = bounded(stored(wanted.withColumn("th", F.xxhash64("term")))).alias("w")
        return self.postings.where("pos >= 0").alias("p").join(w, (F.col("p.th") == F.col("w.th")) & (F.col("p.term") == F.col("w.term"))).select("p.term", "rid", "pos", *(f"w.{c}" for c in rest))


def build(docs: DataFrame) -> Index:
    """The index of (doc_id, text), stored: every word of every text. Segments are the input's partitions; nothing is shuffled."""
    own = stored(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col("text").cast("string").alias("text")))
    split = own.select("rid", parted("text").alias("ws"))
    n = F.greatest(F.size("ws") - 1 - (F.element_at("ws", -1) == "").cast("int"), F.lit(0))
    out = split.select("rid", n.alias("n"), F.posexplode("ws").alias("p", "term")).where("p = 0 OR term <> ''")
    out = out.select(F.xxhash64("term").alias("th"), "term", "rid", (F.col("p") - 1).alias("pos"), F.when(F.col("p") == 0, F.col("n")).alias("n_words"))
    return Index(own, stored(out.sortWithinPartitions("th")))


def items(bench: DataFrame, window: int) -> DataFrame:
    """(ik, item, w, len, win): distinct items that have words; stored."""
    out = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words("text").alias("w")).where("size(w) > 0").distinct()
    return stored(out.select(F.xxhash64("item", "w").alias("ik"), "item", "w", F.size("w").alias("len"), F.least(F.size("w"), F.lit(window)).alias("win")))


def _offsets(its: DataFrame) -> DataFrame:
    return its.select("ik", "len", "win", F.posexplode("w").alias("off", "term"))


def anchors(its: DataFrame, df: DataFrame, rarest: int) -> DataFrame:
    """(term, ik, off): in each window all of whose terms occur, the positions of its rarest terms. df: (term, n)."""
    at = _offsets(its).join(bounded(df), "term", "left")
    spread = at.select("ik", "off", "term", F.coalesce("n", F.lit(0)).alias("n"), F.explode(F.sequence(F.greatest(F.lit(0), F.expr("off - win + 1")), F.least(F.col("off"), F.expr("len - win")))).alias("s"))
    per = spread.groupBy("ik", "s").agg(F.sort_array(F.collect_list(F.struct("n", "term", "off"))).alias("r")).where("r[0].n > 0")
    return stored(per.select("ik", F.explode(F.slice("r", 1, rarest)).alias("x")).select("x.term", "ik", "x.off").distinct())


def alignments(index: Index, its: DataFrame, df: DataFrame, rarest: int = 2) -> DataFrame:
    """(rid, ik, diag): where the rarest terms of some window stand at their offsets from word diag of the text."""
    found = index.found(anchors(its, df, rarest)).select("rid", "ik", (F.col("pos") - F.col("off")).alias("diag"))
    # one offset of a window can hold for a run of windows; short windows have a single term
    need = F.least(F.lit(rarest), F.col("win"))
    met = found.groupBy("rid", "ik", "diag").agg(F.count("*").alias("c"))
    return met.join(bounded(its.select("ik", "win")), "ik").where(F.col("c") >= need).select("rid", "ik", "diag")


def matches(index: Index, its: DataFrame, df: DataFrame, window: int, rarest: int) -> DataFrame:
    """(rid, item, pos, n): runs of n text words from pos on that whole windows of the item cover; stored. Runs may overlap."""
    near = stored(alignments(index, its, df, rarest))
    ids = stored(near.select("rid").distinct())
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    # the text in blocks that share their last window - 1 words with the next
    split = index.texts.join(ids, "rid", "left_semi").select("rid", words("text").alias("ws"))
    block = split.select("rid", "ws", F.explode(F.sequence(F.lit(0), F.expr(f"greatest(size(ws) - 1, 0) div {BLOCK}"))).alias("blk"))
    block = block.select("rid", F.col("blk").cast("long").alias("blk"), F.slice("ws", (F.col("blk") * BLOCK + 1).cast("int"), F.lit(BLOCK + window - 1)).alias("t"))
    # the blocks in which an alignment's windows begin
    first, last = F.expr(f"greatest(diag, 0) div {BLOCK}"), F.expr(f"greatest(diag + len - win, 0) div {BLOCK}")
    side = bounded(its.select("ik", "item", "w", "len", "win"))
    at = near.join(side, "ik").where("diag + len >= win").select("rid", "item", "win", "diag", "w", "len", F.explode(F.sequence(first, last)).alias("blk"))
    # of the item only what meets the block
    lo = F.expr(f"cast(greatest(blk * {BLOCK} - diag, 0) AS int)")
    part = at.select("rid", "item", "win", "blk", (F.col("diag") + lo).alias("pos"), F.slice("w", lo + 1, F.lit(BLOCK + window - 1)).alias("part"))
    met = part.join(block, ["rid", "blk"])
    # 1 where item and text agree; at block offset o the text has pos - blk * BLOCK + o
    flags = f"array_join(transform(part, (x, o) -> if(pos + o >= 0 AND x <=> get(t, cast(pos - blk * {BLOCK} + o AS int)), '1', '0')), '')"
    met = met.select("rid", "item", "win", "pos", F.expr(flags).alias("f")).where("instr(f, repeat('1', win)) > 0")
    # the runs of equal flags, each with the place where it ends
    runs = """transform(array(regexp_extract_all(f, '0+|1+', 0)), c -> transform(sequence(1, size(c)), i ->
        named_struct('s', c[i - 1], 'e', aggregate(slice(c, 1, i), 0, (a, x) -> a + length(x)))))[0]"""
    found = F.expr(f"filter({runs}, z -> z.s LIKE '1%' AND length(z.s) >= win)")
    return stored(met.select("rid", "item", "pos", F.explode(found).alias("z")).select("rid", "item", (F.col("pos") + F.col("z.e") - F.length("z.s")).alias("pos"), F.length("z.s").alias("n")))


def near_items(index: Index, its: DataFrame, df: DataFrame, terms: int = 4, within: int = 20) -> DataFrame:
    """(rid, item): texts in which the item's `terms` rarest distinct terms stand within `within` words of each other, in any order.

    An item of fewer distinct terms uses all; one with a term that no text holds matches nothing.
    """
    per = _offsets(its).select("ik", "term").distinct().join(bounded(df), "term", "left").groupBy("ik").agg(F.slice(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))), 1, terms).alias("r")).where("r[0].n > 0")
    rare = stored(per.select("ik", F.size("r").alias("k"), F.explode("r.term").alias("term")))
    # a span of `within` words starts in one block of that width and ends in the same or the next; first all terms must be about
    seen = index.found(rare).select("rid", "ik", "k", "pos", "term", F.explode(F.array(F.expr(f"pos div {within}"), F.expr(f"pos div {within} - 1"))).alias("block"))
    met = seen.groupBy("rid", "ik", "k", "block").agg(F.collect_set(F.struct("pos", "term")).alias("p")).where("size(p) >= k")  # two blocks' words at most
    close = F.expr(f"exists(p, a -> size(array_distinct(transform(filter(p, b -> b.pos >= a.pos AND b.pos < a.pos + {within}), b -> b.term))) >= k)")
    return met.where(close).join(bounded(its.select("ik", "item")), "ik").select("rid", "item").distinct()


def decontaminated(docs: DataFrame, bench: DataFrame, window: int = 10, rarest: int = 2, index: Index | None = None, terms: int = 4, within: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: exact phrases; items (array) too; n_near_items, near_items: items by proximity.

    index: that of docs, if it is there already.
    """
    own = None if index else build(docs)
    index = index or own
    its = items(bench, window)
    df = index.frequencies(its.select(F.explode("w").alias("term")).distinct())
    runs = matches(index, its, df, window, rarest)
    words_hit = runs.select("rid", F.explode(F.expr("sequence(pos, pos + n - 1)")).alias("at")).distinct().groupBy("rid").agg(F.count("*").alias("n_hit"))
    named = runs.groupBy("rid").agg(F.sort_array(F.collect_set("item")).alias("items"))
    near = near_items(index, its, df, terms, within).groupBy("rid").agg(F.sort_array(F.collect_set("item")).alias("near_items"))
    none = F.array().cast("array<string>")
    out = index.every().join(index.texts.select("rid", "doc_id"), "rid")
    for side in (words_hit, named, near):
        out = out.join(side, "rid", "left")
    out = out.withColumns({"items": F.coalesce("items", none), "near_items": F.coalesce("near_items", none), "n_hit": F.coalesce("n_hit", F.lit(0)).cast("long")})
    out = out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
        "items",
        "near_items",
    )
    if own is None:
        return out
    out = stored(out)
    dropped(own.texts, own.postings)  # an index that nobody asked to keep
    return out


def proximity(docs: DataFrame, bench: DataFrame, terms: int = 4, within: int = 20, index: Index | None = None) -> DataFrame:
    """doc_id, item: the proximity matches alone."""
    index, its = index or build(docs), items(bench, 1)
    df = index.frequencies(its.select(F.explode("w").alias("term")).distinct())
    return near_items(index, its, df, terms, within).join(index.texts.select("rid", "doc_id"), "rid").select("doc_id", "item").distinct()


ORACLE = r"""
WITH it AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item, win, array_to_string(w[s + 1:s + win], ' ') AS g
  FROM (SELECT item, w, least(len(w), 10) AS win, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS s FROM it WHERE len(w) > 0)),
d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
dw AS (
  SELECT doc_id, win, s, array_to_string(w[s + 1:s + win], ' ') AS g
  FROM (SELECT doc_id, w, win, unnest(range(0, len(w) - win + 1)) AS s FROM d, (SELECT DISTINCT win FROM iw) WHERE len(w) >= win)),
m AS (SELECT doc_id, item, dw.win, s FROM dw JOIN iw ON dw.win = iw.win AND dw.g = iw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + win)) AS p FROM m) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY 1),
tp AS (SELECT doc_id, pos - 1 AS pos, w[pos] AS term FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM d)),
df AS (SELECT term, count(*) AS n FROM tp GROUP BY 1),
rk AS (SELECT item, k0, term, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY item, k0 ORDER BY coalesce(n, 0), term) AS r FROM (SELECT DISTINCT item, array_to_string(w, ' ') AS k0, unnest(w) AS term FROM it) LEFT JOIN df USING (term)),
ra AS (SELECT item, k0, term, count(*) OVER (PARTITION BY item, k0) AS k, min(n) OVER (PARTITION BY item, k0) AS least FROM rk WHERE r <= 4),
oc AS (SELECT doc_id, item, k0, k, pos, term FROM tp JOIN ra USING (term) WHERE least > 0),
nr AS (SELECT doc_id, count(DISTINCT item) AS n_near FROM (SELECT a.doc_id, a.item, a.k0, a.pos, a.k FROM oc a JOIN oc b ON a.doc_id = b.doc_id AND a.item = b.item AND a.k0 = b.k0 AND b.pos >= a.pos AND b.pos < a.pos + 20 GROUP BY ALL HAVING count(DISTINCT b.term) >= a.k) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id) LEFT JOIN nr USING (doc_id)
"""
