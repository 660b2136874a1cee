"""Context-tree weighting over bytes, trained on a corpus and then held fixed; the tree is a partitioned table.

A text is the stream of its tokens: each word's bytes (A-Z lower-cased) and a space, at last a line feed, the end. A byte
is eight binary choices; each of the 255 choice nodes has its own tree over the bytes before, up to `depth`. A tree
node's counts give a Krichevsky-Trofimov estimate; weighting mixes them over all ways to prune the tree, from the leaves
up, and so fixes every node's share in the prediction. Every context of the training texts is a node, however rare; the
weight of what lies below a context that the training texts lack goes to the deepest one on the path that they have. The
code length of a text is minus its log probability.

How it runs. A byte with the `depth` bytes before it is a gram, a number.

1. Texts are cut into chunks of some megabytes. A chunk hands on its distinct grams and words, with their counts in
   training texts, in one block for each part (a hash of the two latest context bytes, or of the word), and its own texts.
2. Each part merges its blocks and weights its trees down to contexts of two bytes.
3. Those roots, at most 255 for each of the 65,536 contexts of two bytes, are weighted on the driver and broadcast.
4. Each part predicts its grams and answers every chunk's block; a chunk scores its texts by these answers.

What a task holds is bounded by a chunk, or by a part's distinct grams or words; parts grow in number with the input.

Defined results: null and empty texts are an end alone; without training texts all counts are 0 (each bit costs a bit);
a null doc_id counts as empty text for the split; ids keep their type; repeated rows are scored each; further columns,
whatever their names, are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, crc_mod, mix, released, small_batches, steps, stored

DEPTH = 6
#: Contexts of so many bytes are the roots of the parts' trees.
CUT = 2
#: A chunk ends at so many bytes of text, distinct grams or distinct words.
CHUNK_BYTES, CHUNK_GRAMS, CHUNK_WORDS = 24 << 20, 2_500_000, 500_000
#: Keys that wait for being merged.
HELD = 700_000
#: One part for so many bytes of text, up to MOST_PARTS.
PART_BYTES, MOST_PARTS = 32 << 20, 2048
END, GAP = 10, 32
LN2, LN_PI = math.log(2), math.log(math.pi)
#: Kinds of rows in a chunk's answer: predictions of grams, counts of words, texts.
GRAMS, WORDS, TEXTS = 0, 1, 2


# Blocks of numbers and words as bytes.


def _pack(x: np.ndarray) -> bytes:
    """An array as bytes, the like bytes of its numbers side by side and compressed."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T)
    return struct.pack("<q", len(x)) + pa.Codec("zstd", compression_level=1).compress(pa.py_buffer(raw), asbytes=True)


def _unpack(b: bytes, kind=np.int64) -> np.ndarray:
    n, size = struct.unpack_from("<q", b)[0], np.dtype(kind).itemsize
    raw = np.frombuffer(pa.Codec("zstd").decompress(b[8:], n * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).reshape(-1).view(kind)


def _pack_sorted(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=0))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b))


def _pack_bytes(b: bytes) -> bytes:
    return struct.pack("<q", len(b)) + pa.Codec("zstd", compression_level=1).compress(b, asbytes=True)


def _unpack_bytes(b: bytes) -> bytes:
    return pa.Codec("zstd").decompress(b[8:], struct.unpack_from("<q", b)[0], asbytes=True)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys of some sorted lists, and the sums of their numbers; the lists are taken from `parts`."""
    if len(parts) == 1:
        return parts[0]
    every = np.concatenate([k for k, _ in parts])
    every.sort()
    keys = every[_heads(every)]
    del every
    n = np.zeros(len(keys), parts[0][1].dtype)
    while parts:
        k, c = parts.pop()
        n[np.searchsorted(keys, k)] += c
    return keys, n


def _heads(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)


# Texts as streams of bytes.


class Stream:
    """The token streams of many texts, each after `depth` end bytes."""

    def __init__(self, col: pa.Array, depth: int):
        w = Words(col, hashes=False)
        size = w.end - w.start
        before = np.concatenate(([0], np.cumsum(size)))
        at = before[:-1] + np.arange(len(size)) + w.doc * (depth + 1) + depth
        n_docs = len(w.offsets) - 1
        ends = before[w.first[1:]] + w.first[1:] + np.arange(n_docs) * (depth + 1) + depth
        begins = np.concatenate(([0], ends[:-1] + 1)) + depth if n_docs else np.empty(0, np.int64)
        data = np.full(int(before[-1]) + len(size) + n_docs * (depth + 1), GAP, np.uint8)
        step = np.arange(int(before[-1]))
        data[np.repeat(at - before[:-1], size) + step] = w.low[np.repeat(w.start - before[:-1], size) + step]
        data[_pads(begins, depth)], data[ends] = END, END
        #: scored bytes and words of each text, without and with its end
        self.data, self.sizes, self.words = data, ends - begins + 1, np.diff(w.first)


def _begins(sizes: np.ndarray, depth: int) -> np.ndarray:
    """Where each text's scored bytes begin, after the end bytes before them."""
    return np.cumsum(sizes + depth) - sizes


def _pads(begins: np.ndarray, depth: int) -> np.ndarray:
    return (begins[:, None] - 1 - np.arange(depth)).ravel()


def _grams(data: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    """Each scored byte and the `depth` bytes before it as a number, the latest byte highest."""
    back = np.zeros(len(data) + 8, np.uint8)
    back[: len(data)] = data[::-1]
    wide = np.ndarray((len(data),), ">u8", back, strides=(1,)).astype(np.uint64) >> np.uint64(8 * (7 - depth))
    scored = np.ones(len(data), bool)
    scored[_pads(_begins(sizes, depth), depth)] = False
    return wide[::-1][scored].view(np.int64)


# 1. Chunks.


class Chunk:
    """Distinct grams and words of some texts with their counts in training texts."""

    def __init__(self, depth: int):
        self.depth, self.parts, self.held, self.bytes, self.seq = depth, [], 0, 0, 0
        self.learnt, self.other = Counter(), set()

    def add(self, s: Stream, train: np.ndarray) -> None:
        k = (_grams(s.data, s.sizes, self.depth) << 1) | np.repeat(train, s.sizes)
        k.sort()
        head = _heads(k)
        self.parts.append((k[head], np.diff(head, append=len(k)).astype(np.int32)))
        self.held += len(head)
        del k
        if self.held > HELD + len(self.parts[0][0]):
            self.parts = [_merge(self.parts)]
            self.held = len(self.parts[0][0])
        tokens, cut = s.data.tobytes().split(), np.concatenate(([0], np.cumsum(s.words)))
        # runs of texts of one side
        turn = np.flatnonzero(np.concatenate(([True], train[1:] != train[:-1]))) if len(train) else []
        for a, b in zip(turn, [*turn[1:], len(train)]):
            (self.learnt if train[a] else self.other).update(tokens[cut[a] : cut[b]])
        self.learnt[b"\n"] += int(train.sum())
        self.bytes += len(s.data)

    def full(self) -> bool:
        return self.bytes >= CHUNK_BYTES or self.held > CHUNK_GRAMS and len(self.parts) == 1 or len(self.learnt) + len(self.other) > CHUNK_WORDS

    def blocks(self, n_parts: int) -> Iterator[tuple[int, bytes, bytes]]:
        """(part, keys, counts) of grams, then of words."""
        k, n = _merge(self.parts)
        self.parts = []
        n *= (k & 1).astype(np.int32)
        k >>= 1
        head = _heads(k)
        k, n = k[head], np.add.reduceat(n, head, dtype=np.int64)
        part = _part_of(n_parts)[(k >> 8 * (self.depth - CUT)) & 0xFFFF]
        order = np.argsort(part, kind="stable")
        k, n, part = k[order], n[order], part[order]
        head = _heads(part)
        for a, b in zip(head, np.append(head[1:], len(part))):
            yield int(part[a]), _pack_sorted(k[a:b]), _pack(n[a:b])
        del k, n, part, order
        dealt: dict[int, list[bytes]] = {}
        for w in self.learnt.keys() | self.other:
            dealt.setdefault(n_parts + zlib.crc32(w) % n_parts, []).append(w)
        while dealt:
            p, w = dealt.popitem()
            w.sort()
            yield p, _pack_bytes(b" ".join(w)), _pack(np.array([self.learnt[x] for x in w], np.int64))


def _part_of(n_parts: int) -> np.ndarray:
    """The part of grams by their latest two context bytes."""
    return (mix(np.arange(1 << 16)) % np.uint64(n_parts)).astype(np.int16)


def _cutter(depth: int, n_parts: int, id_type: pa.DataType):
    """Rows (chunk, part, seq, keys, vals, sizes, ids): blocks of the parts, and texts as part -1."""

    def row(chunk, part, seq, keys, vals, sizes=None, ids=None) -> pa.RecordBatch:
        ids = pa.nulls(1, pa.list_(id_type)) if ids is None else pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk]), pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([keys], pa.binary()), pa.array([vals], pa.binary()), pa.array([sizes], pa.binary()), ids],
            ["chunk", "part", "seq", "keys", "vals", "sizes", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        chunk = Chunk(depth)
        for part in steps(batches):
            s = Stream(part.column(1), depth)
            chunk.add(s, part.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
            yield row(number, -1, chunk.seq, _pack_bytes(s.data.tobytes()), _pack(s.words), _pack(s.sizes), part.column(0))
            chunk.seq += 1
            if chunk.full():
                yield from (row(number, p, 0, k, v) for p, k, v in chunk.blocks(n_parts))
                number, chunk = number + 1, Chunk(depth)
                released()
        if chunk.seq:
            yield from (row(number, p, 0, k, v) for p, k, v in chunk.blocks(n_parts))
        del chunk
        released()

    return run


# The trees of the choice nodes. A node is a number: the choice node (1 to 255), then the context, the latest byte highest.


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 0.5, by Stirling's series after a shift by 6."""
    shift = np.zeros_like(x)
    for k in range(6):
        shift += np.log(x + k)
    y = x + 6
    r = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - (1 / 360 - r / 1260) * r) / y - shift


_SMALL = np.arange(1 << 12, dtype=np.float64)
_HALF, _ONE = _log_gamma(_SMALL + 0.5), _log_gamma(_SMALL + 1)


def _log_gamma_of(n: np.ndarray, table: np.ndarray, more: float) -> np.ndarray:
    out = table[np.minimum(n, len(table) - 1)]
    big = np.flatnonzero(n >= len(table))
    if len(big):
        out[big] = _log_gamma(n[big] + more)
    return out


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _log_gamma_of(a, _HALF, 0.5) + _log_gamma_of(b, _HALF, 0.5) - LN_PI - _log_gamma_of(a + b, _ONE, 1.0)


def _choices(keys: np.ndarray, n: np.ndarray, depth: int):
    """For each of a byte's eight bits, the last first: nodes in order, their counts of 0 and 1, each gram's node and its bit there."""
    bits = 8 * depth
    mask = (1 << bits) - 1
    node, total, at, byte = keys | (256 << bits), n, np.arange(len(keys)), keys >> bits
    for j in range(8):
        one = (node >> bits) & 1
        up = (node >> (bits + 1) << bits) | (node & mask)
        order = np.argsort(up, kind="stable")
        up, one, part = up[order], one[order], total[order]
        head = _heads(up)
        a, b = np.add.reduceat(part * (1 - one), head), np.add.reduceat(part * one, head)
        group = np.empty(len(up), np.int64)
        group[order] = np.repeat(np.arange(len(head)), np.diff(head, append=len(up)))
        at = group[at]
        node, total = up[head], a + b
        yield node, a, b, at, (byte >> j) & 1


def _weighted(key, a, b, below, steps_up: int) -> list[tuple]:
    """From nodes with ln of their weighted probabilities up: (key, seen, chance of 1, own share, each node's place in the level above), the deepest level first.

    `below` None: the nodes are leaves and weigh by their own estimates alone.
    """
    out = []
    for step in range(steps_up + 1):
        own = None
        if step or below is None:
            own = _log_kt(a, b)
            if step:
                below = np.logaddexp(own, below) - LN2
        share = np.exp(own - LN2 - below) if step else None
        below = own if below is None else below
        level = [key, a + b > 0, (b + 0.5) / (a + b + 1), share, None, a, b, below]
        out.append(level)
        if step < steps_up:
            up = key >> 8
            head = _heads(up)
            level[4] = np.repeat(np.arange(len(head)), np.diff(head, append=len(up)))
            key, a, b, below = up[head], np.add.reduceat(a, head), np.add.reduceat(b, head), np.add.reduceat(below, head)
    return out


def _settled(levels: list[tuple], made, left, stop) -> tuple:
    """Down again from the top level: what a prediction has settled above the deepest level, what is left for that, and the chance of 1 if no node below was seen."""
    for i in range(len(levels) - 1, 0, -1):
        _, seen, chance, share = levels[i][:4]
        stop = np.where(seen, made + left * chance, stop)
        made, left = made + left * share * chance, left * (1 - share)
        at = levels[i - 1][4]
        made, left, stop = made[at], left[at], stop[at]
    return made, left, stop


def roots(keys: np.ndarray, n: np.ndarray, depth: int) -> tuple:
    """Nodes of CUT context bytes of these grams: keys, counts of 0 and 1, ln of the weighted probability of all below."""
    got = [_weighted(node, a, b, None, depth - CUT)[-1] for node, a, b, _, _ in _choices(keys, n, depth)] if len(keys) else []
    return tuple(np.concatenate([g[i] for g in got]) if got else np.empty(0, np.float64 if i == 7 else np.int64) for i in (0, 5, 6, 7))


def top(key: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray) -> tuple:
    """The top of the trees, over the parts' roots: for each root in order what is settled above it, left for it, and the chance of 1 above it."""
    order = np.argsort(key)
    key, a, b, below = key[order], a[order], b[order], below[order]
    if not len(key):
        return key, below, below, below
    levels = _weighted(key, a, b, below, CUT)
    n = len(levels[-1][0])
    return (key, *_settled(levels, np.zeros(n), np.ones(n), np.full(n, 0.5)))


def predicted(keys: np.ndarray, n: np.ndarray, depth: int, above: tuple) -> np.ndarray:
    """log10 probability of each gram's byte after its context."""
    out = np.zeros(len(keys))
    for node, a, b, at, bit in _choices(keys, n, depth) if len(keys) else ():
        levels = _weighted(node, a, b, None, depth - CUT)
        own = np.searchsorted(above[0], levels[-1][0])
        made, left, stop = _settled(levels, *(x[own] for x in above[1:]))
        p = np.where(levels[0][1], made + left * levels[0][2], stop)
        p = np.clip(p, 1e-12, 1 - 1e-12)
        out += np.where(bit == 1, np.log10(p)[at], np.log10(1 - p)[at])
    return out


# 2. Parts.


def _merger(depth: int, n_parts: int):
    """Rows (part, keys, vals, top, n, v): a part's distinct grams with counts and roots, or its words with counts and totals."""

    def row(part, keys, vals, tops=None, n=None, v=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([keys], pa.binary()), pa.array([vals], pa.binary()), pa.array([tops], pa.list_(pa.binary())), pa.array([n], pa.int64()), pa.array([v], pa.int64())],
            ["part", "keys", "vals", "top", "n", "v"],
        )

    def done(part, parts, words) -> pa.RecordBatch:
        if part < n_parts:
            k, n = _merge(parts)
            key, a, b, below = roots(k, n, depth)
            return row(part, _pack_sorted(k), _pack(n), [_pack(key), _pack(a), _pack(b), _pack(below)])
        w = sorted(words)
        n = np.array([words[x] for x in w], np.int64)
        return row(part, _pack_bytes(b" ".join(w)), _pack(n), n=int(n.sum()), v=int((n > 0).sum()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, parts, held, words = None, [], 0, {}
        for batch in batches:
            for p, k, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if p != part:
                    if part is not None:
                        yield done(part, parts, words)
                    part, parts, held, words = p, [], 0, {}
                if p < n_parts:
                    parts.append((_unpack_sorted(k), _unpack(v)))
                    held += len(parts[-1][0])
                    if held > HELD + len(parts[0][0]):
                        parts = [_merge(parts)]
                        held = len(parts[0][0])
                else:
                    for w, n in zip(_unpack_bytes(k).split(b" "), _unpack(v).tolist()):
                        words[w] = words.get(w, 0) + n
        if part is not None:
            yield done(part, parts, words)
        del parts, words
        released()

    return run


def _answerer(depth: int, n_parts: int, above):
    """Rows (chunk, kind, seq, keys, vals): the part's predictions or counts for the keys of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = logs = words = None
        for batch in batches:
            for p, chunk, k, v in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if chunk is None:  # the part's own row comes first
                    keys = logs = words = None
                    if p < n_parts:
                        keys = _unpack_sorted(k)
                        logs = predicted(keys, _unpack(v), depth, above.value).astype(np.float32)
                    else:
                        words = dict(zip(_unpack_bytes(k).split(b" "), _unpack(v).tolist()))
                    continue
                if p < n_parts:
                    vals, kind = _pack(logs[np.searchsorted(keys, _unpack_sorted(k))]), GRAMS
                else:
                    vals, kind = _pack(np.array([words[w] for w in _unpack_bytes(k).split(b" ")], np.int64)), WORDS
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([kind], pa.int32()), pa.array([0], pa.int32()), pa.array([k], pa.binary()), pa.array([vals], pa.binary())], ["chunk", "kind", "seq", "keys", "vals"])

    return run


# 4. Scores.


class Places:
    """Where each of some distinct keys stands: a table of open slots."""

    def __init__(self, keys: np.ndarray):
        self.keys, bits = keys, max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.at = np.full(1 << bits, -1, np.int32)
        open_, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(open_):
            free = self.at[slot] < 0
            self.at[slot[free]] = open_[free]
            lost = self.at[slot] != open_
            open_, slot = open_[lost], (slot[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys that are all there."""
        slot = self._slot(keys)
        out = self.at[slot]
        open_ = np.flatnonzero(self.keys[out] != keys)
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            out[open_] = self.at[slot[open_]]
            open_ = open_[self.keys[out[open_]] != keys[open_]]
        return out


def _scorer(depth: int, n: int, v: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, found, words, places, logs = None, [], {}, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                c, kind, _, k, x = (batch.column(j)[i].as_py() for j in range(5))
                if c != chunk:
                    chunk, found, words, places, logs = c, [], {}, None, None
                    released()
                if kind == GRAMS:
                    found.append((_unpack_sorted(k), _unpack(x, np.float32)))
                    continue
                if kind == WORDS:
                    words.update(zip(_unpack_bytes(k).split(b" "), _unpack(x).tolist()))
                    continue
                if places is None:
                    places, logs, found = Places(np.concatenate([f[0] for f in found])), np.concatenate([f[1] for f in found]), []
                data, n_words, sizes = np.frombuffer(_unpack_bytes(k), np.uint8), _unpack(x), _unpack(batch.column(5)[i].as_py())
                total = np.concatenate(([0.0], np.cumsum(logs[places(_grams(data, sizes, depth))], dtype=np.float64)))
                end = np.cumsum(sizes)
                tokens = data.tobytes().split()
                count = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
                more = np.concatenate(([0.0], np.cumsum(np.log10(count + 1.0))))
                known = np.concatenate(([0], np.cumsum(count > 0)))
                b = np.cumsum(n_words)
                a, ends = b - n_words, words[b"\n"]
                base = more[b] - more[a] + math.log10(ends + 1.0) - (n_words + 1) * math.log10(n + v + 1)
                score = total[end] - total[end - sizes]
                ids = batch.column(6).slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [ids.cast(id_type), pa.array(n_words + 1), pa.array(known[b] - known[a] + (ends > 0)), pa.array(np.full(len(b), n)), pa.array(base), pa.array(score), pa.array(-score / math.log10(2) / sizes)],
                    ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
                )
                del data, total, tokens, count, more, known
        del words, places, logs
        released()

    return run


def scored(docs: DataFrame, train: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte; the tree and the word counts learn from the rows where `train` holds.

    base_score: the sum over tokens of log10((c + 1) / (N + V + 1)), of a token's count c, all N and the distinct V.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    if not CUT <= depth <= 6:
        raise ValueError("a gram is a number of at most seven bytes")
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    id_type, id_ddl = to_arrow_type(kind), kind.simpleString()
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(max(4, -(-size // PART_BYTES)), MOST_PARTS)
    with small_batches(spark):
        chunks = stored(own.mapInArrow(_cutter(depth, parts, id_type), f"chunk long, part int, seq int, keys binary, vals binary, sizes binary, ids array<{id_ddl}>"))
    blocks = chunks.where("part >= 0").select("part", "chunk", "keys", "vals")
    dealt = blocks.select("part", "keys", "vals").repartitionById(2 * parts, F.col("part")).sortWithinPartitions("part")
    merged = stored(dealt.mapInArrow(_merger(depth, parts), "part int, keys binary, vals binary, top array<binary>, n long, v long"))
    n, v = (x or 0 for x in merged.agg(F.sum("n"), F.sum("v")).first())
    tops = [r[0] for r in merged.where("top IS NOT NULL").select("top").toLocalIterator()]
    kinds = (np.int64, np.int64, np.int64, np.float64)
    above = spark.sparkContext.broadcast(top(*(np.concatenate([_unpack(t[i], kinds[i]) for t in tops] or [np.empty(0, kinds[i])]) for i in range(4))))
    asked = merged.select("part", F.lit(None).cast("long").alias("chunk"), "keys", "vals").unionAll(blocks)
    asked = asked.repartitionById(2 * parts, F.col("part")).sortWithinPartitions("part", F.col("chunk").asc_nulls_first())
    answers = asked.mapInArrow(_answerer(depth, parts, above), "chunk long, kind int, seq int, keys binary, vals binary")
    none = F.lit(None)
    texts = chunks.where("part < 0").select("chunk", F.lit(TEXTS).alias("kind"), "seq", "keys", "vals", "sizes", "ids")
    rows = answers.select("*", none.cast("binary").alias("sizes"), none.cast(T.ArrayType(kind)).alias("ids")).unionAll(texts)
    rows = rows.repartition(max(4, -(-2 * size // CHUNK_BYTES)), "chunk").sortWithinPartitions("chunk", "kind", "seq")
    out = f"doc_id {id_ddl}, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return stored(rows.mapInArrow(_scorer(depth, n, v, id_type), out))


def held_out(doc_id: str = "doc_id") -> Column:
    return crc_mod(F.col(doc_id), 7) == 2
