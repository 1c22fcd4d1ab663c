"""Helpers for operators that read texts in Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows per Arrow batch: a few MB of usual texts.
BATCH_ROWS = 1000
# Bytes of text that one numpy step handles; a longer text is a step of its own.
BLOCK_BYTES = 1 << 20
# Ids that may be broadcast (8 bytes each); a larger table is joined by shuffle.
BROADCAST_ROWS = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
# Primes below 2^31 with a base each: a word is a polynomial over both fields, so that products fit 64 bits (fixed values).
_FIELDS = ((2147483647, 1566083941), (2147483629, 1812433253))
_powers: dict[tuple[int, int], np.ndarray] = {}


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def packed(docs: DataFrame) -> DataFrame:
    """Every row as one struct ``row``, so that no column of it can clash with a helper column."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Mark a stored table of ids for broadcast when it is small; a larger one is shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def blocks(batch: pa.RecordBatch, column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def utf8(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of every row; a null counts as empty."""
    a = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    if not len(a) or a.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(a) + 1, np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power(base: int, prime: int, n: int) -> np.ndarray:
    """The first n powers of a base in its field; those of a usual block are kept, in 32 bits each."""
    known = _powers.get((base, prime), np.ones(1, np.uint32))
    while len(known) < n:  # every round doubles the table
        step = np.uint64(pow(base, len(known), prime))
        known = np.concatenate([known, (known[: n - len(known)] * step % np.uint64(prime)).astype(np.uint32)])
    if len(known) <= BLOCK_BYTES + 1:
        _powers[base, prime] = known
    return known[:n]


_LETTER = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD) >> np.uint64(34)
_LETTER[65:91] = _LETTER[97:123]  # A-Z as a-z
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, A-Z lower-cased, and the row of each word.

    The hash is taken in two prime fields: modulo a power of two, words that differ by a Thue-Morse pattern would meet. Words are maximal runs of other bytes than space and \\t \\n \\v \\f \\r.
    """
    word = _WORD[data]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = word[:-1]
    before[inner] = False
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = word[1:]
    after[inner - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    parts = []
    for prime, base in _FIELDS:
        p = np.uint64(prime)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTER[data] * _power(base, prime, len(data)) % p, out=sums[1:])
        back = _power(pow(base, -1, prime), prime, len(data) + 1)[starts]
        parts.append((sums[ends] - sums[starts]) % p * back % p)
    hashes = parts[0] << np.uint64(32) | parts[1]
    return mix(mix(hashes) + (ends - starts).astype(np.uint64)), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(batch: pa.RecordBatch, k: int, column: str = "text") -> Iterator[np.ndarray]:
    """For every row the sorted distinct 64-bit hashes of its k-word shingles.

    A text with fewer words has one shingle, the whole sequence; one without words has none.
    """
    for block in blocks(batch, column):
        data, offsets = utf8(block, column)
        hashes, rows = word_hashes(data, offsets)
        first = np.searchsorted(rows, np.arange(block.num_rows + 1))
        n = max(0, len(hashes) - k + 1)
        rolled = np.zeros(n, np.uint64)
        for i in range(k):
            rolled = mix(rolled * _ODD + hashes[i : i + n] + np.uint64(i + 1))
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                yield np.unique(rolled[a : b - k + 1])
            elif b > a:
                whole = np.full(1, b - a, np.uint64)
                for h in hashes[a:b]:
                    whole = mix(whole * _ODD + h)
                yield whole
            else:
                yield np.zeros(0, np.uint64)
