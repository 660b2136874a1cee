"""Words, hashes, near duplicates, scores, rules, languages: against plain Python."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from costloom.llm import ctw, langid, neardup, quality, tokens
from costloom.llm.common import Words, shingle_sets, steps

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \t\n ", "a", "A b", "É é\u00a0x y\x0bz", "x " * 300, "word" * 5000, "a\nb\na\n\nb c\n"]


def split(t):
    return (t or "").encode().lower().split()


def test_words_match_split():
    w = Words(pa.array(ODD, pa.string()))
    for i, t in enumerate(ODD):
        rows = range(w.first[i], w.first[i + 1])
        assert [bytes(w.low[w.start[r] : w.end[r]]) for r in rows] == split(t)
    part = pa.RecordBatch.from_arrays([pa.array(ODD, pa.string())], ["text"])
    assert sum(s.num_rows for s in steps(iter([part]))) == len(ODD)


def test_shingle_sets_are_sets_of_word_runs():
    texts = ["a b c a b c", "c a b c a b", "a b", "a b", "b a", None]
    s = shingle_sets(Words(pa.array(texts, pa.string())), 3)
    assert [len(x) for x in s] == [3, 3, 1, 1, 1, 0]
    assert set(s[0]) == set(s[1]) and set(s[2]) == set(s[3]) != set(s[4])


def brute_groups(texts, width, num, den):
    sets = {}
    for i, t in texts.items():
        w = split(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def groups(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("width,num", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, width, num):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert groups(neardup.near_duplicates(docs, width, num, 100)) == brute_groups(texts, width, num, 100)


def test_near_duplicates_of_many_edited_copies(spark):
    """Copies around the threshold: links that do not pass through the smallest document must be found."""
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(150)]
    texts = {}
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocab) + "x"
        texts[i] = " ".join(w)
    for i in range(120, 160):  # a shared passage alone is no link
        texts[i] = " ".join(base[:40] + [rng.choice(vocab) + str(i) for _ in range(110)])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert groups(neardup.near_duplicates(df, 3, 85, 100)) == brute_groups(texts, 3, 85, 100)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(20, "A  B", "x"), (20, "A  B", "x"), (None, "A b", "x")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id string"), 3, 85, 100).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in by[20]] == [4, 4] and not by[20][0].kept
    assert by[0][0].n_shingles == 0 and by[0][0].kept and by[1][0].component_id == 1
    assert by[None][0].component_id is None and by[None][0].kept
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_overlap_bound_is_a_binomial_tail():
    o = neardup.overlap_bound(64, 0.85)
    tail = lambda x: sum(math.comb(64, i) * 0.85**i * 0.15 ** (64 - i) for i in range(x))
    assert tail(o) <= 1e-10 < tail(o + 1)


# Context trees.


def plain_score(train, texts, depth):
    """log10 probabilities of texts by context trees in dicts, one for each choice node."""
    counts, below = {}, {}

    def bits(t):
        data = b"\n" * depth + b"".join(w + b" " for w in split(t)) + b"\n"
        for i in range(depth, len(data)):
            for level in range(8):
                yield (1 << level) | (data[i] >> (8 - level)), data[i - depth : i], data[i] >> (7 - level) & 1

    for t in train:
        for v, path, bit in bits(t):
            for d in range(depth + 1):
                counts.setdefault((v, path[depth - d :]), [0, 0])[bit] += 1

    def kt(c):
        return math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.log(math.pi) - math.lgamma(sum(c) + 1)

    under = {}
    for (v, s), c in sorted(counts.items(), key=lambda x: -len(x[0][1])):
        below[v, s] = kt(c) if len(s) == depth else float(np.logaddexp(kt(c), under[v, s])) - math.log(2)
        if s:
            under[v, s[1:]] = under.get((v, s[1:]), 0.0) + below[v, s]

    def chance(v, path):
        made, left, stop = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            s = path[depth - d :]
            if (v, s) not in counts:
                break
            c = counts[v, s]
            one = (c[1] + 0.5) / (sum(c) + 1)
            stop = made + left * one
            share = math.exp(kt(c) - math.log(2) - below[v, s])
            made, left = made + left * share * one, left * (1 - share)
        return stop

    return [sum(math.log10(p if bit else 1 - p) for p, bit in ((chance(v, path), bit) for v, path, bit in bits(t))) for t in texts]


def test_scores_equal_trees_in_plain_python(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(25).collect()
    texts = [(r.doc_id, r.text) for r in rows] + [(9001, None), (9002, ""), (9003, "zzzz qqqq"), (9004, "\u00e9t\u00e9 " * 300), (None, "A b")]
    train = [t for i, t in texts if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    want = dict(zip([i for i, _ in texts], plain_score(train, [t for _, t in texts], 4)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in ctw.scored(df, ~ctw.held_out(), depth=4).collect()}
    assert got.keys() == want.keys()
    for i, x in want.items():
        assert abs(got[i] - x) < 1e-5 * max(1, abs(x)), i


def test_chunks_do_not_change_scores(monkeypatch):
    """Blocks of many small chunks, merged by parts, give what one chunk gives."""
    texts = [f"a{i % 7} b{i % 5} {i}" for i in range(50)]
    train = np.arange(50) % 3 > 0

    def run(n):
        parts = {}
        for k in range(n):
            chunk = ctw.Chunk(4)
            chunk.add(ctw.Stream(pa.array(texts[k::n]), 4), train[k::n].astype(np.int64))
            for p, k_, v in chunk.blocks(3):
                parts.setdefault(p, []).append((ctw._unpack_sorted(k_), ctw._unpack(v)) if p < 3 else (k_, v))
        grams = {p: ctw._merge(x) for p, x in parts.items() if p < 3}
        above = ctw.top(*(np.concatenate(x) for x in zip(*(ctw.roots(*g, 4) for g in grams.values()))))
        return {p: (g[0].tolist(), ctw.predicted(*g, 4, above).round(12).tolist()) for p, g in grams.items()}

    assert run(1) == run(7)


def test_slots_hold_clashing_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 50, 5000))
    assert (ctw.Places(keys)(keys[::-1]) == np.arange(len(keys))[::-1]).all()


def test_scores_and_base(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(1).alias("score"))
    docs = docs.unionByName(spark.createDataFrame([(9001, None, 1), (9002, "", 1), (9003, "zzzz qqqq", 1), (9003, "zzzz qqqq", 1)], "doc_id long, text string, score int"))
    rows = docs.select("doc_id", "text").collect()
    c = Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            c.update([*split(r.text), b"\n"])
    n, v = sum(c.values()), len(c)
    got = ctw.scored(docs, ~ctw.held_out(), depth=4).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for r in rows:
        w = [*split(r.text), b"\n"]
        g = by[r.doc_id]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert abs(g.base_score - sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) < 1e-6 * len(w)
        assert g.score < 0
    plain = [r for r in got if r.doc_id < 9000]
    assert 1 < np.mean([r.bits_per_byte for r in plain]) < 3.5 < by[9003].bits_per_byte


def test_scores_without_training_rows(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = ctw.scored(df, F.lit(False)).first()
    assert r.train_tokens == 0 and r.n_known == 0 and abs(r.bits_per_byte - 8) < 1e-3
    assert ctw.scored(df.limit(0), F.lit(True)).count() == 0


def test_scores_keep_the_type_of_ids(spark):
    df = spark.createDataFrame([("x1", "a b", 5, "c"), ("x1", "a b", 5, "c"), (None, "a", 5, "c")], "doc_id string, text string, chunk int, part string")
    got = ctw.scored(df, F.lit(True)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["None", "x1", "x1"] and len({r.score for r in got}) == 2


# Quality.


def plain_counts(t):
    t = t or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(hit)


def test_quality_counts_and_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", F.lit(0).alias("kept"))
    docs = docs.unionByName(spark.createDataFrame([(9000 + i, t, None, 0) for i, t in enumerate(ODD)], "doc_id long, text string, lang string, kept int"))
    rows = {r.doc_id: r for r in docs.collect()}
    got = quality.judged(docs).collect()
    assert len(got) == len(rows)
    for g in got:
        want = plain_counts(rows[g.doc_id].text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want, g.doc_id
        assert g.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (g.base_failed and g.kept)
    assert quality.judged(docs.limit(0)).count() == 0


def test_fertility_rejects_junk_and_keeps_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    x = quality.judged(docs).join(labels, "doc_id").where("NOT base_failed")
    r = x.agg(F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))).alias("good"), F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("bad")).first()
    assert r.good > 0.99 and r.bad < 0.5


def test_script():
    assert [quality.script(t) for t in ("", "abc", "абв", "中文字", "12")] == ["none", "latin", "cyrillic", "han", "none"]


# Languages.


def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(1)
    k, trans, start = 3, rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.array([0, 5, 5, 6, 10])
    em = rng.normal(size=(10, 3))
    got = langid.posteriors(em, first, trans, start)
    for a, b in zip(first[:-1], first[1:]):
        want = np.zeros((b - a, k))
        for path in itertools.product(range(k), repeat=b - a):
            s = sum(em[a + t, c] for t, c in enumerate(path)) + (start[path[0]] if path else 0) + sum(trans[x, y] for x, y in zip(path, path[1:]))
            for t, c in enumerate(path):
                want[t, c] += math.exp(s)
        if b > a:
            assert np.allclose(got[a:b], want / want.sum(1, keepdims=True))


def test_posteriors_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    em, first = rng.normal(size=(500, 4)), np.array([0, 3, 130, 500])
    trans, start = rng.normal(size=(4, 4)), rng.normal(size=4)
    a = langid.posteriors(em, first, trans, start)
    monkeypatch.setattr(langid, "BLOCK", 1000)
    assert np.allclose(a, langid.posteriors(em, first, trans, start))


def test_language_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = langid.fitted(docs.where(~langid.held_out()), per_lang=40)
    got = langid.identified(docs, field).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out())
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    odd = spark.createDataFrame([(i, t, "z") for i, t in enumerate([*ODD, "12 34 !!"])], "doc_id long, text string, lang_pred string")
    rows = {r.doc_id: r for r in langid.identified(odd, field).collect()}
    assert [rows[i].lang_pred for i in (0, 1, 2, len(ODD))] == ["und"] * 4 and rows[3].lang_pred in field.langs
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert langid.identified(odd, None).where("lang_pred <> 'und'").count() == 0
    assert langid.fitted(docs.limit(0)) is None


def test_code_switched_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = langid.fitted(docs, per_lang=40)
    by = {r.lang: r.text for r in docs.where("lang IN ('en', 'fr')").groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    mixed = " ".join(by["en"].split()[:40] + by["fr"].split()[:40])
    rows = langid.spans(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), field).collect()
    at = {i: r.lang for r in rows for i in range(r.start, r.end)}
    assert len(at) == 80
    assert sum(at[i] == ("en" if i < 40 else "fr") for i in range(80)) >= 70


# Token counts.


def test_histogram_equals_plain_sums(spark):
    texts = [*ODD, "the cat", "the cat", "Hello wörld"]
    df = spark.createDataFrame([(i, t, "g" if i % 2 else None) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    lengths = tokens.encoded_lengths(df, F.col("n_tokens"))
    got = {(r.doc_id): (r.grp, r.n_tokens) for r in lengths.collect()}
    enc = tokens._encoding(open(tokens.VOCABULARY, "rb").read())
    assert got == {i: ("g" if i % 2 else None, len(enc.encode_ordinary(t or ""))) for i, t in enumerate(texts)}
    hist = tokens.histogram(lengths.drop("doc_id"))
    by = {}
    for g, n in got.values():
        by.setdefault(g, []).append(n)
    rows = hist.collect()
    assert {(r.grp, r.n_tokens) for r in rows} == {(g, n) for g, x in by.items() for n in x}
    for r in rows:
        x = by[r.grp]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.truncated_tokens) == (x.count(r.n_tokens), sum(n >= r.n_tokens for n in x), sum(n for n in x if n >= r.n_tokens), sum(min(n, r.n_tokens) for n in x))
        assert abs(r.docs_share_up_to - sum(n <= r.n_tokens for n in x) / len(x)) < 1e-12
    cut = {(r.grp, r.limit): r.truncated_tokens for r in tokens.truncated_totals(hist, [0, 3, 10**6]).collect()}
    assert cut == {(g, k): sum(min(n, k) for n in x) for g, x in by.items() for k in (0, 3, 10**6)}
    q = {(r.grp, r.share): r.n_tokens for r in tokens.quantiles(hist, [0.5, 1.0]).collect()}
    assert q["g", 1.0] == max(by["g"])
    assert tokens.histogram(lengths.limit(0)).count() == 0
