"""Language of words and texts by a linear-chain conditional random field.

A word's features are itself (lexicon), its prefixes and suffixes, and its byte 2- and 3-grams, hashed into a table of
weights for each language; learned transitions tie neighbouring words together, so words of code-switched text are
labelled in context. Forward-backward gives each word's language probabilities; a text's language is the one with the
largest share of them.

The field is fitted on the driver to a bounded sample: up to `per_lang` whole texts of each language, the ones of smallest
hash, mixed into sequences that switch languages. All words of all texts are
then labelled.

Defined results: text that is null or has no letter is `und` with score 0, so is all text if nothing is labelled; a
word's punctuation belongs to it; a null doc_id is an ordinary row; ids keep their type; repeated rows get the same result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, Words, crc_mod, id_type, steps, stored

#: Texts of each language that the field is fitted to.
PER_LANG = 150
BUCKETS = 1 << 18
#: Words to a block of the chain; blocks are worked on side by side and tied together exactly.
BLOCK = 64
SWITCH, EPOCHS, RATE = 0.05, 6, 0.5


def features(w: Words, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in rows, bucket) of every feature of the words `rows`."""
    hashed = SpanHash(w.low)
    s, e = w.start[rows], w.end[rows]
    size = e - s
    place, bucket = [], []

    def add(at: np.ndarray, a: np.ndarray, b: np.ndarray, kind: int) -> None:
        h = hashed(a, b) + np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64)
        place.append(at)
        bucket.append(((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64))

    every = np.arange(len(rows))
    add(every, s, e, 1)
    for k in (1, 2, 3, 4):
        long = every[size >= k]
        add(long, s[long], s[long] + k, 2)
        add(long, e[long] - k, e[long], 3)
    for k in (2, 3):
        n = np.maximum(size - k + 1, 0)
        at = np.repeat(every, n)
        a = s[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        add(at, a, a + k, 4)
    return np.concatenate(place), np.concatenate(bucket)


def emissions(w: Words, weights: np.ndarray) -> np.ndarray:
    """(words, languages) scores of all words; each different word is looked at once."""
    _, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
    at, bucket = features(w, first)
    order = np.argsort(at, kind="stable")
    total = np.concatenate((np.zeros((1, weights.shape[1])), np.cumsum(weights[bucket[order]], 0, dtype=np.float64)))
    cut = np.searchsorted(at[order], np.arange(len(first) + 1))
    return (total[cut[1:]] - total[cut[:-1]])[back]


def posteriors(em: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Each word's language probabilities. first: where the texts' words begin, and the end. trans, start: log scores."""
    n, k = em.shape
    if not n:
        return em
    size = np.diff(first)
    blocks = -(-size // BLOCK)
    b0 = np.concatenate(([0], np.cumsum(blocks)))
    text = np.repeat(np.arange(len(size)), blocks)
    inner = np.arange(b0[-1]) - b0[text]
    begin = first[text] + inner * BLOCK
    length = np.minimum(first[text] + size[text] - begin, BLOCK)
    e = np.exp(em - em.max(1, keepdims=True))
    a = np.exp(trans - trans.max())
    pi = np.exp(start - start.max())
    opens = inner == 0

    def at(t: int) -> np.ndarray:
        return np.flatnonzero(length > t)

    def step(p: np.ndarray, rows: np.ndarray, t: int) -> np.ndarray:
        out = p @ a
        if t == 0:  # a text's first word comes after nothing
            o = opens[rows]
            out[o] = p[o].sum(-1, keepdims=True) * pi
        out = out * e[begin[rows] + t][:, None, :]
        return out / np.maximum(out.sum((1, 2), keepdims=True), 1e-300)

    # what a whole block does to the probabilities before it
    prod = np.tile(np.eye(k), (len(begin), 1, 1))
    for t in range(BLOCK):
        rows = at(t)
        if not len(rows):
            break
        prod[rows] = step(prod[rows], rows, t)
    fore = np.full((len(begin), k), 1.0 / k)
    back = np.ones((len(begin), k))
    most = int(blocks.max())
    for j in range(1, most):
        rows = b0[:-1][blocks > j] + j
        x = np.einsum("ni,nij->nj", fore[rows - 1], prod[rows - 1])
        fore[rows] = x / x.sum(1, keepdims=True)
    for j in range(most - 2, -1, -1):
        rows = b0[:-1][blocks > j + 1] + j
        x = np.einsum("nij,nj->ni", prod[rows + 1], back[rows + 1])
        back[rows] = x / x.sum(1, keepdims=True)
    out = np.empty((n, k))
    x = fore.copy()
    for t in range(BLOCK):
        rows = at(t)
        if not len(rows):
            break
        x[rows] = step(x[rows][:, None, :], rows, t)[:, 0]
        out[begin[rows] + t] = x[rows]
    x = back.copy()
    for t in range(BLOCK - 1, -1, -1):
        rows = at(t)
        if not len(rows):
            continue
        out[begin[rows] + t] *= x[rows]
        y = (x[rows] * e[begin[rows] + t]) @ a.T
        x[rows] = y / np.maximum(y.sum(1, keepdims=True), 1e-300)
    return out / np.maximum(out.sum(1, keepdims=True), 1e-300)


class Field:
    """The fitted field: languages, weights (BUCKETS, languages), transition and start scores."""

    def __init__(self, langs: list[str], texts: list[tuple[str, str]], seed: int = 7):
        """texts: (language, text). Sequences of BLOCK words are put together from runs of different languages."""
        self.langs, k = langs, len(langs)
        rng = np.random.default_rng(seed)
        w = Words(pa.array([t for _, t in texts], pa.string()))
        self.weights, self.trans, self.start = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k)
        if not len(w.start):
            return
        label = np.array([langs.index(x) for x, _ in texts])[w.doc]
        own = [np.flatnonzero(label == c) for c in range(k)]
        full = [c for c in range(k) if len(own[c])]
        n_seq = max(1, len(w.start) // BLOCK)
        seq = np.empty((n_seq, BLOCK), np.int64)
        for row in seq:
            c, i = None, 0
            for t in range(BLOCK):
                if c is None or rng.random() < SWITCH or i >= len(own[c]):
                    c = full[rng.integers(len(full))]
                    i = int(rng.integers(len(own[c])))
                row[t] = own[c][i]
                i += 1
        gold = label[seq]
        uniq, back = np.unique(seq, return_inverse=True)
        back = back.reshape(seq.shape)
        at, bucket = features(w, uniq)
        order = np.argsort(at, kind="stable")
        bucket, cut = bucket[order], np.searchsorted(at[order], np.arange(len(uniq) + 1))
        hist = [np.zeros_like(x) + 1e-6 for x in (self.weights, self.trans, self.start)]
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(n_seq), max(1, n_seq // 64)):
                self._learn(back[rows], gold[rows], bucket, cut, hist)

    def _learn(self, seq: np.ndarray, gold: np.ndarray, bucket: np.ndarray, cut: np.ndarray, hist: list[np.ndarray]) -> None:
        n, m = seq.shape
        k = len(self.langs)
        flat = seq.ravel()
        size = cut[flat + 1] - cut[flat]
        which = np.repeat(np.arange(len(flat)), size)
        feats = bucket[np.repeat(cut[flat] - (np.cumsum(size) - size), size) + np.arange(len(which))]
        em = np.zeros((n * m, k))
        np.add.at(em, which, self.weights[feats])
        em = em.reshape(n, m, k)
        e, a, pi = np.exp(em - em.max(2, keepdims=True)), np.exp(self.trans), np.exp(self.start)
        fore, back = np.empty((n, m, k)), np.ones((n, m, k))
        x = e[:, 0] * pi
        for t in range(m):
            x = x if t == 0 else (x @ a) * e[:, t]
            x = x / x.sum(1, keepdims=True)
            fore[:, t] = x
        for t in range(m - 2, -1, -1):
            y = (back[:, t + 1] * e[:, t + 1]) @ a.T
            back[:, t] = y / y.sum(1, keepdims=True)
        post = fore * back
        post /= post.sum(2, keepdims=True)
        pair = fore[:, :-1, :, None] * a * (e * back)[:, 1:, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        hot = np.eye(k)[gold]
        g_em = (hot - post).reshape(-1, k)
        g_w = np.zeros_like(self.weights)
        np.add.at(g_w, feats, g_em[which])
        g_t = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:]) - pair.sum((0, 1))
        g_s = (hot[:, 0] - post[:, 0]).sum(0)
        for x, g, h in zip((self.weights, self.trans, self.start), (g_w, g_t, g_s), hist):
            g = g / n
            h += g * g
            x += RATE * g / np.sqrt(h)

    def label(self, col: pa.Array) -> tuple[Words, np.ndarray]:
        """The words of the texts and their language probabilities."""
        w = Words(col)
        return w, posteriors(emissions(w, self.weights), w.first, self.trans, self.start)


def sample(docs: DataFrame, per_lang: int = PER_LANG) -> list[tuple[str, str]]:
    """(lang, text): of each language the up to `per_lang` distinct texts of smallest hash, whole."""
    own = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.xxhash64("text", "lang").alias("h"), F.col("text").cast("string").alias("text"))
    sizes = stored(own.groupBy("lang").agg(F.count("*").alias("n")))
    sizes = F.broadcast(sizes) if sizes.limit(100_001).count() <= 100_000 else sizes
    # far more than enough pass a threshold on the hash, so that few rows meet to be ranked
    unit = F.col("h").cast("double") / 2.0**64 + 0.5
    few = own.join(sizes, "lang").where(unit * F.col("n") <= 2 * per_lang + 50).distinct().groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("h", "text"))), 1, per_lang).alias("x"))
    return sorted((r.lang, t.text) for r in few.collect() for t in r.x)


def fitted(docs: DataFrame, per_lang: int = PER_LANG) -> Field | None:
    got = sample(docs, per_lang)
    langs = sorted({lang for lang, _ in got})
    return Field(langs, got) if langs else None


def _has_letter(t: str | None) -> bool:
    return t is not None and any(map(str.isalpha, t))


def identified(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, lang_pred, score, n_switches (words whose language differs from the word before) for each text."""
    model = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = model.value
        for part in steps(batches):
            n = part.num_rows
            some = np.fromiter(map(_has_letter, part.column(1).to_pylist()), bool, n)
            pred, score, turns = np.full(n, "und", object), np.zeros(n), np.zeros(n, np.int64)
            if f is not None:
                w, post = f.label(part.column(1))
                total = np.concatenate((np.zeros((1, len(f.langs))), np.cumsum(post, 0)))
                share = total[w.first[1:]] - total[w.first[:-1]]
                best = share.argmax(1)
                size = np.maximum(np.diff(w.first), 1)
                pred[some] = np.array(f.langs, object)[best[some]]
                score[some] = np.clip(share.max(1) / size, 0, 1)[some]
                top = post.argmax(1) if len(post) else np.empty(0, np.int64)
                change = np.concatenate(([0], np.cumsum((top[1:] != top[:-1]) & (w.doc[1:] == w.doc[:-1])))) if len(top) else np.zeros(1)
                turns = np.where(np.diff(w.first) > 0, change[np.maximum(w.first[1:] - 1, 0)] - change[np.minimum(w.first[:-1], len(change) - 1)], 0).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(turns)], ["doc_id", "lang_pred", "score", "n_switches"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type(docs)}, lang_pred string, score double, n_switches long")


def spans(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, start, end (words), lang: the runs of one language in each text."""
    model = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = model.value
        for part in steps(batches):
            w, post = f.label(part.column(1))
            if not len(post):
                continue
            top = post.argmax(1)
            head = np.flatnonzero(np.concatenate(([True], (top[1:] != top[:-1]) | (w.doc[1:] != w.doc[:-1]))))
            tail = np.append(head[1:], len(top))
            doc = w.doc[head]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc)), pa.array(head - w.first[doc]), pa.array(tail - w.first[doc]), pa.array(np.array(f.langs, object)[top[head]].tolist(), pa.string())], ["doc_id", "start", "end", "lang"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type(docs)}, start long, end long, lang string")


def held_out(doc_id: str = "doc_id"):
    return crc_mod(F.col(doc_id), 4) == 2
