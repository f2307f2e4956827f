"""Line dedup: documents probe a sharded minimal perfect hash of the lines.

A line's key is the line without ASCII white space at both ends and with A-Z
lower-cased.  Keys of at least ``MIN_CHARS`` code points found in at least
``MIN_DOCS`` documents lose all their lines except in the largest document id
that holds them.

1. Every distinct (key hash, document) counts once; a key's count and largest
   document come from partial sums in each task, so a line of a third of all
   documents is no hot group.
2. Keys of several documents go into the index (a key of one document can
   never be dropped; the fingerprint tells it apart).  The index is cut into
   shards by hash.  A shard is one row: the level bits of a minimal perfect
   hash, and three arrays in its order: a 64-bit fingerprint, the document
   count, the largest document.  No lines, no pointers: about 20 bytes a key.
3. Documents send each shard the hashes they ask about; the shard's row comes
   first in the sorted partition and answers the stream behind it.  Lines are
   not joined with lines, and one shard is held at a time.
4. The few keys that make up more than 1 / ``HEADS`` of all counts would make
   their shards hot.  There are fewer than ``HEADS`` of them whatever the data,
   so they form one more shard that every task carries; nobody asks for them
   over the network.
5. Each document gets the hashes that it loses and drops their lines.

Keys are compared by 128-bit hashes.  Defined results: null and empty texts
are one empty line and stay as they are; documents are told apart by id, so
rows with one id count once and a key's last id keeps it in all its rows; null
ids count as one document, smaller than any other; equal rows get equal
results; a very long text is handled line by line in one task; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import Store
from strata.llm.suffix_dedup import width
from strata.llm.textops import key_chunks, mix

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys with more than 1 / HEADS of all counts are held by every task: fewer than HEADS keys of 36 bytes.
HEADS = 4096
#: Keys in a shard, and shards for each shuffle partition at least (so that they deal out evenly).
SHARD_KEYS = 1 << 16
SHARDS_A_TASK = 16

_SPACE = b" \t\n\v\f\r"
_LEVEL = 0x9E3779B97F4A7C15
_NO_ID = -(1 << 63)
_SHARD = "levels binary, bits binary, fingerprints binary, counts binary, last binary"


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: every level keeps the keys that are alone on their bit.

    ``index`` of a key of the set is its own place in ``0 .. n - 1``; for any
    other key it is some place or -1.
    """

    def __init__(self, levels: np.ndarray, bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self._first = np.concatenate([[0], np.cumsum(levels)[:-1]]) if len(levels) else levels
        self._rank = np.cumsum(bits) - 1

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        left, levels, parts = np.arange(len(h1)), [], []
        while len(left):
            size = max(64, 2 * len(left))
            at = cls._slot(h1[left], h2[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(size)
            parts.append(alone)
            left = left[~alone[at]]
        return cls(np.array(levels, np.int64), np.concatenate(parts) if parts else np.zeros(0, bool))

    @staticmethod
    def _slot(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64(level * _LEVEL & 0xFFFFFFFFFFFFFFFF)
        return (mix(h1 ^ mix(h2 + salt)) % np.uint64(size)).astype(np.int64)

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out, left = np.full(len(h1), -1), np.arange(len(h1))
        for level, (first, size) in enumerate(zip(self._first.tolist(), self.levels.tolist(), strict=True)):
            if not len(left):
                break
            at = first + self._slot(h1[left], h2[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self._rank[at[hit]]
            left = left[~hit]
        return out


class LineShard:
    """Fingerprints, document counts and largest documents of keys, in the order of their perfect hash."""

    def __init__(self, hashed: PerfectHash, fingerprints: np.ndarray, counts: np.ndarray, last: np.ndarray):
        self.hashed, self.fingerprints, self.counts, self.last = hashed, fingerprints, counts, last

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, n: np.ndarray, last: np.ndarray) -> LineShard:
        hashed = PerfectHash.build(h1, h2)
        order = np.argsort(hashed.index(h1, h2))
        return cls(hashed, h2[order], np.minimum(n[order], (1 << 32) - 1).astype(np.uint32), last[order].astype(np.int64))

    def arrays(self) -> list[bytes]:
        bits = np.packbits(self.hashed.bits)
        return [x.tobytes() for x in (self.hashed.levels, bits, self.fingerprints, self.counts, self.last)]

    @classmethod
    def load(cls, levels: bytes, bits: bytes, fingerprints: bytes, counts: bytes, last: bytes) -> LineShard:
        sizes = np.frombuffer(levels, np.int64)
        flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sizes.sum())).astype(bool)
        return cls(PerfectHash(sizes, flags), np.frombuffer(fingerprints, np.uint64), np.frombuffer(counts, np.uint32), np.frombuffer(last, np.int64))

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(count, largest document)`` of every key; count 0 for keys that the shard does not hold."""
        if not len(self.last):
            return np.zeros(len(h1), np.uint32), np.zeros(len(h1), np.int64)
        at = self.hashed.index(h1, h2)
        mine = (at >= 0) & (self.fingerprints[at] == h2)
        return np.where(mine, self.counts[at], 0).astype(np.uint32), self.last[at]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, None for keys that are too short."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column("text").cast(pa.large_binary()):
        yield value.as_py()


def _keys(min_chars: int):
    """Distinct keys of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for row, text in enumerate(_texts(batch)):
                mine = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
                found += mine
                owner += [row] * len(mine)
            h1, h2 = _halves(found)
            oid = batch.column("oid").to_numpy()[np.array(owner, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(oid)], ["h1", "h2", "oid"])

    return work


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["levels", "bits", "fingerprints", "counts", "last"]
    for table in key_chunks(batches, ["shard"], SHARD_KEYS):
        shard, h1, h2, n, last = (table.column(c).to_numpy() for c in ("shard", "h1", "h2", "n", "last"))
        ends = np.flatnonzero(np.diff(shard, append=-1)) + 1
        for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
            built = LineShard.build(h1[a:b].view(np.uint64), h2[a:b].view(np.uint64), n[a:b], last[a:b])
            arrays = [pa.array([x], pa.binary()) for x in built.arrays()]
            yield pa.RecordBatch.from_arrays([pa.array(shard[a : a + 1]), *arrays], ["shard", *names])


class LineIndex:
    """The stored shards, and the shard of the commonest keys that travels with the tasks."""

    def __init__(self, shards: DataFrame, n_shards: int, heads: LineShard):
        self.shards, self.n_shards, self.heads = shards, n_shards, heads


def _prepared(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("oid"), text.alias("text"))


def line_index(docs: DataFrame, store: Store, min_chars: int = MIN_CHARS, heads: int = HEADS) -> LineIndex:
    """Index the keys that several documents hold, with document counts and largest documents."""
    n = width(docs.sparkSession)
    found = _prepared(docs).select("oid", "text").mapInArrow(_keys(min_chars), "h1 long, h2 long, oid long").distinct()
    counts = store(found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("oid").alias("last")).filter("n > 1"), "line_counts")
    keys, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    common = F.col("n") * heads > F.lit(total)  # fewer than `heads` keys can hold so much each
    top = counts.filter(common).toArrow()
    h1, h2, docs_, last = (top.column(c).to_numpy() for c in ("h1", "h2", "n", "last"))
    n_shards = max(SHARDS_A_TASK * n, -(-keys // SHARD_KEYS))
    rest = counts.filter(~common).withColumn("shard", F.pmod("h1", F.lit(n_shards)))
    shards = rest.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(_shards, f"shard long, {_SHARD}")
    return LineIndex(store(shards, "line_shards"), n_shards, LineShard.build(h1.view(np.uint64), h2.view(np.uint64), docs_, last))


def _asks(index_size: int, heads: LineShard, min_chars: int):
    """What every document asks of which shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for row, text in enumerate(_texts(batch)):
                mine = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
                found += mine
                owner += [row] * len(mine)
            h1, h2 = _halves(found)
            ask = np.flatnonzero(heads.probe(h1, h2)[0] == 0)
            h1, h2, row = h1[ask].view(np.int64), h2[ask].view(np.int64), pa.array(np.array(owner, np.int64)[ask])
            oid, name = batch.column("oid").take(row), batch.column("name").take(row)
            yield pa.RecordBatch.from_arrays([pa.array(np.mod(h1, index_size)), pa.array(h1), pa.array(h2), oid, name], ["shard", "h1", "h2", "oid", "name"])

    return work


def _answers(min_docs: int):
    """The asked hashes that their documents lose; a shard's row precedes its questions."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = None, None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            asked = batch.column("question").to_numpy(zero_copy_only=False)
            new = np.ones(len(shard), bool)
            new[1:] = (shard[1:] != shard[:-1]) | ~asked[1:] | ~asked[:-1]
            starts = np.flatnonzero(new)
            for a, b in zip(starts.tolist(), np.append(starts[1:], len(shard)).tolist(), strict=True):
                if not asked[a]:
                    index = LineShard.load(*(batch.column(c)[a].as_py() for c in ("levels", "bits", "fingerprints", "counts", "last")))
                    held = shard[a]
                elif held == shard[a]:
                    part = batch.slice(a, b - a)
                    h1, h2, oid = (part.column(c).to_numpy() for c in ("h1", "h2", "oid"))
                    n, last = index.probe(h1.view(np.uint64), h2.view(np.uint64))
                    gone = np.flatnonzero((n >= min_docs) & (last != oid))
                    if len(gone):
                        keys = np.stack([h1[gone], h2[gone]], axis=1).tobytes()
                        keys = pa.array([keys[k : k + 16] for k in range(0, len(keys), 16)], pa.binary())
                        yield pa.RecordBatch.from_arrays([part.column("oid").take(gone), part.column("name").take(gone), keys], ["oid", "name", "key"])

    return work


def _cleaned(heads: LineShard, min_chars: int, min_docs: int, with_text: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            answers, oids = batch.column("keys"), batch.column("oid").to_pylist()
            for row, text in enumerate(_texts(batch)):
                lines = text.split(b"\n")
                keys = [line_key(line, min_chars) for line in lines]
                gone = set(answers[row].as_py() or ())
                mine = list(set(keys) - {None} - gone)
                if mine and len(heads.last):
                    n, last = heads.probe(*_halves(mine))
                    gone.update(mine[k] for k in np.flatnonzero((n >= min_docs) & (last != oids[row])))
                kept = [line for line, key in zip(lines, keys, strict=True) if key not in gone] if gone else lines
                data = b"\n".join(kept)
                rows.append((len(lines), len(lines) - len(kept), hashlib.sha256(data).hexdigest(), data if with_text else None))
            n_lines, dropped, digest, data = zip(*rows, strict=True) if rows else ((), (), (), ())
            arrays = [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(data, pa.binary()).cast(pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return work


def drop_common_lines(
    docs: DataFrame, store: Store, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, heads: int = HEADS, with_text: bool = False
) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, kept_sha256`` and, on demand, ``kept_text``."""
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2: keys of one document are not indexed")
    n = width(docs.sparkSession)
    index = line_index(docs, store, min_chars, heads)
    rows = _prepared(docs).withColumn("name", F.unhex(F.md5("text")))  # tells texts under one id apart
    asks = rows.select("oid", "name", "text").mapInArrow(_asks(index.n_shards, index.heads, min_chars), "shard long, h1 long, h2 long, oid long, name binary")
    both = asks.withColumn("question", F.lit(True)).unionByName(index.shards.withColumn("question", F.lit(False)), allowMissingColumns=True)
    lost = both.repartition(n, "shard").sortWithinPartitions("shard", "question").mapInArrow(_answers(min_docs), "oid long, name binary, key binary")
    lost = lost.groupBy("oid", "name").agg(F.collect_set("key").alias("keys")).withColumnsRenamed({"oid": "l_oid", "name": "l_name"})
    joined = rows.join(lost, (F.col("oid") == F.col("l_oid")) & (F.col("name") == F.col("l_name")), "left").select("doc_id", "oid", "text", "keys")
    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return joined.mapInArrow(_cleaned(index.heads, min_chars, min_docs, with_text), schema)
