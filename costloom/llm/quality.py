"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback encodes every whole text, its line feeds as spaces (the vocabulary has no line feed). Letters and digits per token, the share of tokens that
are bare bytes, and the entropy of the text's tokens against the most its length allows are compared with the medians of
the text's language (without one, of its script); entropy, which falls with length, with texts of the same power of two
of tokens. A text outside the bands around them is rejected. Simple counts of words, symbols and repeats come beside them
and reject texts on their own.

Medians are exact to 0.001 and taken over all texts that the counts keep. Defined results: null and empty texts have
counts of 0 and are rejected (under 50 words); a language with a single text is its own median and kept; a null doc_id is
an ordinary row; ids keep their type; repeated rows are judged alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, id_type, mix, steps, stored, vocabulary_file

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
#: A text is rejected if its characters per token are beyond these multiples of the median, its byte share is above the
#: median by more than this, or its entropy ratio below the median by more than this.
CHARS_BAND = (0.8, 1.3)
BYTES_ABOVE = 0.05
ENTROPY_BELOW = 0.12
#: The first code points of scripts, for texts without a language; a text's script is that of most of its letters.
SCRIPTS = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x1100, "hangul"), (0x1E00, "latin"), (0x2E80, "han"), (0x3040, "kana"), (0x3400, "han"), (0xAC00, "hangul"))

#: Bytes that begin a letter, a digit or any character beyond ASCII.
PLAIN = np.array([chr(b).isalnum() if b < 128 else b >= 0xC0 for b in range(256)])

_made: dict = {}


def _processor(model: bytes):
    if "p" not in _made:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        _made["p"] = p, np.array([p.is_byte(i) for i in range(p.get_piece_size())])
    return _made["p"]


def script(text: str) -> str:
    codes = np.frombuffer("".join(c for c in text if c.isalpha()).encode("utf-32-le"), np.uint32)
    if not len(codes):
        return "none"
    names = [name for _, name in SCRIPTS]
    return names[int(np.bincount(np.searchsorted([a for a, _ in SCRIPTS], codes, "right") - 1).argmax())]


def _by_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[off[1:]] - total[off[:-1]]


def counts(part: pa.RecordBatch, text: int) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and characters that are letters or digits, of each text."""
    w = Words(part.column(text), lower=False)
    inside = np.zeros(len(w.raw) + 1, np.int32)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    inside = np.cumsum(inside[:-1]) > 0
    chars = _by_text(inside & ((w.raw & 0xC0) != 0x80), w.offsets)
    symbols = _by_text(np.isin(w.raw, np.frombuffer(SYMBOLS, np.uint8)), w.offsets)
    raw, dup = w.raw.tobytes(), np.zeros(part.num_rows, np.int64)
    for i, (a, b) in enumerate(zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist())):
        lines = [x for x in raw[a:b].split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
        dup[i] = len(lines) - len(set(lines))
    n = len(w.start)
    repeat = np.zeros(n, bool)
    if n >= 3:
        key = w.hash[:-2]
        for k in (1, 2):
            key = mix(key * np.uint64(3) + w.hash[k : n - 2 + k])
        at = np.flatnonzero(w.doc[:-2] == w.doc[2:])
        key = mix(key[at] ^ mix(w.doc[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        hit = at[order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]]
        for k in range(3):
            repeat[hit + k] = True
    return np.diff(w.first), chars, symbols, dup, _by_text(repeat, w.first), _by_text(PLAIN[w.raw], w.offsets)


def measured(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, band, the counts, base_failed, chars_per_token, byte_share, entropy_ratio of each text."""
    model = vocabulary_file(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, byte = _processor(model.value)
        for part in steps(batches):
            n_words, chars, symbols, dup, repeat, plain = counts(part, 2)
            texts = [(t or "").replace("\n", " ") for t in part.column(2).to_pylist()]
            bands = [lang if lang is not None else script(t) for lang, t in zip(part.column(1).to_pylist(), texts)]
            ids = p.encode(texts, num_threads=1)
            size = np.array([len(x) for x in ids], np.int64)
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum()))
            off = np.concatenate(([0], np.cumsum(size)))
            fallback = _by_text(byte[flat], off)
            # entropy from the counts of each (text, token)
            pair = np.repeat(np.arange(len(size)), size) * len(byte) + flat
            pair, c = np.unique(pair, return_counts=True)
            logs = np.bincount(pair // len(byte), c * np.log2(c), len(size)) if len(pair) else np.zeros(len(size))
            n = np.maximum(size, 1)
            entropy = np.log2(n) - logs / n
            ratio = np.where(size > 1, entropy / np.log2(np.maximum(n, 2)), 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(bands, pa.string()), *map(pa.array, (n_words, chars, symbols, dup, repeat)), pa.array((n_words < 50) | (100 * repeat > 50 * n_words)), *map(pa.array, (plain / n, fallback / n, ratio, np.floor(np.log2(n)).astype(np.int64)))],
                ["doc_id", "band", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "chars_per_token", "byte_share", "entropy_ratio", "size_class"],
            )

    kind = f"doc_id {id_type(docs)}, band string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, chars_per_token double, byte_share double, entropy_ratio double, size_class long"
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(run, kind)


def medians(m: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(band, m_chars, m_bytes) and (band, size_class, m_entropy): of the texts that the counts keep; stored."""
    mid = lambda c: F.percentile(F.round(c, 3), F.lit(0.5))  # noqa: E731  a thousandth keeps the state of the exact percentile bounded
    good = m.where("NOT base_failed")
    by_band = good.groupBy("band").agg(mid("chars_per_token").alias("m_chars"), mid("byte_share").alias("m_bytes"))
    return stored(by_band), stored(good.groupBy("band", "size_class").agg(mid("entropy_ratio").alias("m_entropy")))


def _near(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(100_001).count() <= 100_000 else df


def judged(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The measures of each text, `reason` (null, base, chars_per_token, byte_share or entropy) and `kept`."""
    m = stored(measured(docs, vocabulary))
    by_band, by_size = medians(m)
    out = m.join(_near(by_band), "band", "left").join(_near(by_size), ["band", "size_class"], "left")
    low, high = CHARS_BAND
    reason = (
        F.when(F.col("base_failed"), "base")
        .when(~F.col("chars_per_token").between(low * F.col("m_chars"), high * F.col("m_chars")), "chars_per_token")
        .when(F.col("byte_share") > F.col("m_bytes") + BYTES_ABOVE, "byte_share")
        .when(F.col("entropy_ratio") < F.col("m_entropy") - ENTROPY_BELOW, "entropy")
    )
    return out.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull()).drop("m_chars", "m_bytes", "m_entropy")
