"""What the operators share: scratch tables, Arrow text buffers, vectorised words and hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import dropped, shared_dir, stored

__all__ = ["dropped", "shared_dir", "stored"]  # for the operators

#: Bytes of text that one vectorised step holds; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(columns: Sequence[str], *names: str) -> list[str]:
    """Names like these that no column has, whatever its case."""
    have, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def id_type(docs: DataFrame, name: str = "doc_id") -> str:
    """The id column's type as DDL; ids are handed on as they are."""
    return docs.schema[name].dataType.simpleString()


def crc_mod(col, n: int):
    """crc32 of the column as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def steps(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold STEP_BYTES of text, or one row."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        _, off = buffers(col)
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(off, off[row] + STEP_BYTES, "right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and each row's offsets into them; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, off - off[0]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Plans that run inside hand Python workers batches of so many rows, which a worker and its JVM hold at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def released() -> None:
    """Give free memory of this Python worker back to the system; it may wait long for its next task."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_MULT = 0x9E3779B97F4A7C15 | 1
_POW: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        m = max(n, STEP_BYTES + 1)
        _POW[:] = [_cumpower(_MULT, m), _cumpower(pow(_MULT, -1, 1 << 64), m)]
    return _POW[0], _POW[1]


def _cumpower(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[0] = 1
    return np.cumprod(x, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of many texts at once: byte spans in `low` (A-Z lower-cased, if asked), the text each belongs to, and a 64-bit hash."""

    def __init__(self, col: pa.Array, hashes: bool = True, lower: bool = True):
        raw, off = buffers(col)
        self.raw, self.offsets, self.low = raw, off, LOWER[raw] if lower else raw
        n = len(raw)
        if n:
            space = SPACE[raw]
            edge = np.zeros(n + 1, bool)
            edge[off] = True
            before = np.empty(n, bool)
            before[0], before[1:] = True, space[:-1]
            after = np.empty(n, bool)
            after[-1], after[:-1] = True, space[1:]
            self.start = np.flatnonzero(~space & (before | edge[:-1]))
            self.end = np.flatnonzero(~space & (after | edge[1:])) + 1
        else:
            self.start = self.end = np.empty(0, np.int64)
        self.doc = np.searchsorted(off, self.start, "right") - 1
        #: words of text i: first[i] up to first[i + 1]
        self.first = np.searchsorted(self.doc, np.arange(len(off)))
        if hashes:
            self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        return SpanHash(self.low)(self.start, self.end)


class SpanHash:
    """Hashes of spans of a byte string, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _powers(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        span = (self.total[end] - self.total[start]) * self.down[start]
        return mix(span + mix((end - start).astype(np.uint64)))


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """Each text's distinct hashes of `width` consecutive words, sorted; all words as one shingle if there are fewer; empty without words."""
    h, first = words.hash, words.first
    acc = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for k in range(width):
        acc = mix(acc * np.uint64(3) + h[k : len(h) - width + 1 + k]) if len(acc) else acc
    acc = acc.view(np.int64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(acc[a : b - width + 1]))
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for k in range(a, b):
                whole = mix(whole * np.uint64(3) + h[k : k + 1])
            out.append(mix(whole + np.uint64(b - a)).view(np.int64))
        else:
            out.append(np.empty(0, np.int64))
    return out


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    off = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=off[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def vocabulary_file(spark: SparkSession, path: str):
    """The bytes of a vocabulary file as a broadcast; some megabytes, as a vocabulary has a fixed size."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())
