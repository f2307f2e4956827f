"""Vectorised text helpers that run on Arrow batches inside Spark tasks.

A batch's strings are one contiguous byte buffer plus offsets, so words,
lines and hashes of many documents come out of a few numpy passes.  Hashes
are 64 bits, a function of the bytes only (the same in every task and run).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is handled on its own.
CHUNK_BYTES = 1 << 19

_U = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
#: Range hashes are two polynomials modulo this prime, one per half of the values.
_PRIME = (1 << 31) - 1
_BASES = (0x2545F491, 0x5851F42D)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (SplitMix64's constants)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_TABLE = mix(np.arange(1, 257, dtype=_U) * _U(_GOLDEN))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_TABLE_LOWER = _TABLE[_LOWER]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Word bytes of the two word definitions used: anything but ASCII white space, and letters or digits only.
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    ALNUM[_lo:_hi] = True

_POWERS: dict[int, np.ndarray] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number, equal modulo the prime: below 2^32 after a product, at most the prime + 5 after one fold more."""
    return (x & _U(_PRIME)) + (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.empty(size, _U)
        have[0] = 1
        filled = 1
        while filled < size:  # doubling: p[k + i] = p[k] * p[i]
            have[filled : 2 * filled] = _fold(_fold(have[:filled] * _U(pow(base, filled, _PRIME))))
            filled *= 2
        if size <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


class RangeHash:
    """Hash of any contiguous range of a sequence, from two prefix sums.

    The modulus is prime, so strings built from doubled patterns (Thue-Morse
    sequences) hash apart, which they do not modulo a power of two.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        self._parts = []
        for base, half in zip(_BASES, (values & _U(_PRIME), values >> _U(33)), strict=True):
            sums = np.zeros(n + 1, _U)  # of numbers below 2^32: exact for up to 2^32 values
            powers = _powers(pow(base, -1, _PRIME), n)
            for k in range(0, n, 1 << 14):
                sums[k + 1 : k + 1 + (1 << 14)] = _fold(half[k : k + (1 << 14)] * powers[k : k + (1 << 14)])
            np.cumsum(sums, out=sums)
            self._parts.append((sums, _powers(base, n + 1)))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), _U)
        for k in range(0, len(start), 1 << 14):  # stays in the processor's cache
            a, b = start[k : k + (1 << 14)], end[k : k + (1 << 14)]
            low, high = (self._residue(sums, scale, a, b) for sums, scale in self._parts)
            out[k : k + len(a)] = mix((low | high << _U(32)) + (b - a).astype(_U) * _U(0xD6E8FEB86659FD93))
        return out

    @staticmethod
    def _residue(sums: np.ndarray, scale: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = sums.take(end)
        out -= sums.take(start)
        out = _fold(_fold(out))
        out *= scale.take(start)
        out = _fold(_fold(out))
        return np.where(out >= _U(_PRIME), out - _U(_PRIME), out)


def byte_values(data: np.ndarray, lower: bool = False) -> np.ndarray:
    return (_TABLE_LOWER if lower else _TABLE)[data]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def doc_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Document ranges ``[i, j)`` of at most ``limit`` bytes (or one document)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


class Words:
    """Words of the documents in one chunk: byte ranges, document index, hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = NOT_SPACE, lower: bool = False):
        """``data`` holds the chunk's bytes; ``offsets`` (from 0) its documents."""
        self.data, self.offsets = data, offsets
        inside = word_byte[data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        if len(data):
            before[0] = False
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        if len(data):
            after[-1] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        #: Words of document d are first[d] .. first[d + 1].
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.lower = lower
        self._hash: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = np.empty(len(self), _U)
            for i, j in doc_chunks(np.append(self.start, len(self.data))):  # a range's hash is the same in any block
                at = self.start[i]
                self._hash[i:j] = RangeHash(byte_values(self.data[at : self.end[j - 1]], self.lower))(self.start[i:j] - at, self.end[i:j] - at)
        return self._hash

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``(word index, hash)`` of every run of ``k`` words inside one document."""
        if len(self) < k:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        at = np.flatnonzero(self.doc[: len(self) - k + 1] == self.doc[k - 1 :])
        return at, RangeHash(self.hash)(at, at + k)


def word_chunks(column: pa.Array, word_byte: np.ndarray = NOT_SPACE, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """The batch's documents by chunks: ``(i, j, Words of documents i..j)``."""
    data, offsets = buffers(column)
    for i, j in doc_chunks(offsets, limit):
        yield i, j, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], word_byte, lower)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, done = values, 1
    while done * 2 <= width:
        out = np.minimum(out[: len(out) - done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[: len(out) - (width - done)], out[width - done :])
    return out


def minimizers(keys: np.ndarray, width: int) -> np.ndarray:
    """Positions whose key is the least of some ``width`` consecutive keys.

    Ties are all kept, so whether a position is chosen because of a given run
    depends on that run's keys alone: equal runs choose equal positions.
    """
    if len(keys) < width:
        return np.zeros(0, np.int64)
    least = sliding_min(keys, width)
    pad = np.zeros(width - 1, keys.dtype)
    best = ~sliding_min(~np.concatenate([pad, least, pad]), width)  # largest minimum over the runs that hold it
    return np.flatnonzero(keys == best)


def spread(oid: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """A shuffle key that deals rows evenly, as a signed 64-bit number."""
    return mix(oid.astype(np.int64).view(np.uint64) * _U(_GOLDEN) + pos.astype(np.int64).view(np.uint64)).view(np.int64)


def cover(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Boolean mask of ``size`` positions covered by any of the ranges."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def key_chunks(batches: Iterator[pa.RecordBatch], keys: list[str], max_rows: int) -> Iterator[pa.Table]:
    """Cut a stream sorted by ``keys`` into tables of about ``max_rows`` rows.

    Rows of one key stay together, so a table exceeds ``max_rows`` only by
    the rows of its last key.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < max_rows:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(table.num_rows, bool)
        for key in keys:
            column = table.column(key).to_numpy()
            last &= column == column[-1]
        cut = table.num_rows - int(last.sum())
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)
