"""Repeated byte strings across documents, by a column-wise collection transform.

Goal: remove every byte covered by a ``LENGTH``-byte string that also starts
earlier (smaller document, or earlier in the same one).

*Anchors.*  A position is an anchor if its ``SEED``-byte hash is the least in
some run of ``LENGTH - SEED + 1`` positions.  Every ``LENGTH``-byte string
holds an anchor, and equal strings hold it at the same place, so two equal
strings always meet under one seed.  Anchors whose seed occurs once prove
their strings unique; only the others go on, with a piece of text that spans
all strings around the anchor.  Equal pieces are told by a 64-bit hash: all but
the first are covered whole, and only the first one's text is fetched.

*Column-wise construction.*  The distinct pieces of a shard of seeds are the
documents of a collection.  From the last column to the first, each round
inserts one symbol before every piece's suffix: the symbols in suffix order
are that round's part of the Burrows-Wheeler transform, a stable distribution
by symbol gives the new order, and the common prefixes follow from range
minima of the old ones.  Columns are read from an external file, in sequence;
transform and prefixes of every round can be written to others.  As equal
strings sit in the same column, only suffixes of one column are ranked
together.  Runs whose common prefix reaches ``LENGTH`` are equal strings: all
but the earliest are covered.

*Scale.*  Text is shuffled once (by document), anchors once (by seed), and
pieces once.  Anchors are the most, but few of them go on: with a ``store``
these are stored first, so that the anchors' shuffle can go before the others
come; text is then shuffled twice, never both on disk.
Copies that meet within a block of a map task are settled there,
so a hot seed is thinned before the shuffle.  Nothing is collected.  A seed with more than ``HOT`` occurrences
is cut by longer contexts of which any string shares one, so no hot group
stays in one task unless its strings are equal, and those are dropped above.

Defined results: null text is empty; rows shorter than ``LENGTH`` lose
nothing; of equal rows (same id and text) the first is judged and the others
lose everything if long enough; rows that share an id are ordered by a hash of
their text; null ids come last; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.components import Store
from strata.llm.textops import RangeHash, buffers, byte_values, cover, key_chunks, minimizers, mix, spread

LENGTH = 100
SEED = 24
#: Occurrences above which a seed's strings are dealt by longer contexts.
HOT = 50_000
#: Pieces of one construction (a shard is cut between seeds).
SHARD_PIECES = 100_000
#: Pieces that a task cuts or turns into spans at once.
PART_PIECES = 1 << 14
_LAST_ID = (1 << 63) - 1
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id, oid, tie, text``: (oid, tie) names a document, in order.

    Null ids share one ``oid``, so their rows are told apart by 64 bits of the
    text's hash; the few rows of one real id by 32 bits.

    With ``carry``, ``rest`` holds all other columns, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("oid"),
        F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(F.shiftright(F.xxhash64(text), 32)).alias("tie"),
        text.alias("text"),
        *([F.struct(*(docs[f"`{c}`"] for c in docs.columns if c != text_col)).alias("rest")] if carry else []),
    )


def width(session) -> int:
    """Shuffle partitions of the session: the initial width of AQE's, or the plain setting."""
    return int(session.conf.get("spark.sql.shuffle.partitions"))


def _anchors(length: int, seed: int, block: int = 1 << 18):
    run = length - seed + 1
    margin = 3 * length

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            oid, tie = batch.column("oid").to_numpy(), batch.column("tie").to_numpy()
            for start in range(0, len(data), block):
                stop = min(len(data), start + block)
                lo, hi = max(0, start - margin), min(len(data), stop + margin)
                if hi - lo < length:
                    continue
                hashes = RangeHash(byte_values(data[lo:hi]))
                every = np.arange(hi - lo - seed + 1)
                key = hashes(every, every + seed)
                at = minimizers(key, run)
                at = at[(at >= start - lo) & (at < stop - lo)]
                doc = np.searchsorted(offsets, at + lo, "right") - 1
                inside = (at + lo + seed <= offsets[doc + 1]) & (offsets[doc + 1] - offsets[doc] >= length)
                at, doc = at[inside], doc[inside]
                if not len(at):
                    continue
                left = np.maximum(at - (length - seed), offsets[doc] - lo)
                right = np.minimum(at + length, offsets[doc + 1] - lo)
                columns = [key[at].view(np.int64), aligned(hashes(left, right), at - left), oid[doc], tie[doc], at + lo - offsets[doc]]
                order = np.lexsort(columns[::-1])
                columns = [c[order] for c in columns]
                once = _changes(*columns)  # equal rows count once
                columns = [c[once] for c in columns]
                settled = ~_changes(*columns[:2])  # an equal piece starts earlier in this very block
                columns[0] = np.where(settled, spread(columns[2], columns[4]), columns[0])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, settled)], ["seed", "piece", "oid", "tie", "pos", "settled"])

    return work


def aligned(piece: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Name of a piece and the place of its anchor: a short text around two anchors is two pieces."""
    return (piece ^ mix(before.astype(np.uint64) + np.uint64(1))).view(np.int64)


def _changes(*columns: np.ndarray) -> np.ndarray:
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _resolve(hot: int, rows: int = 1 << 18):
    """Of anchors sorted by seed: which are covered whole, and whose text is needed.

    ``kind`` 0: an equal piece starts earlier.  1: the first of its piece,
    under a seed with other pieces.  2: the same under a hot seed.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_chunks(batches, ["seed"], rows):
            settled = table.column("settled").to_numpy()
            if settled.any():
                done = table.filter(pa.array(settled)).select(["oid", "tie", "pos"]).combine_chunks().to_batches()[0]
                kind, none = pa.array(np.zeros(done.num_rows, np.int8)), pa.array(np.zeros(done.num_rows, np.int64))
                yield pa.RecordBatch.from_arrays([done.column(0), done.column(1), done.column(2), kind, none], ["oid", "tie", "pos", "kind", "seed"])
                table = table.filter(pa.array(~settled))
            seed, piece, oid, tie, pos = (table.column(c).to_numpy() for c in ("seed", "piece", "oid", "tie", "pos"))
            _, inverse, count = np.unique(seed, return_inverse=True, return_counts=True)
            some = np.flatnonzero(count[inverse] > 1)
            if not len(some):
                continue
            order = some[np.lexsort((pos[some], tie[some], oid[some], piece[some], seed[some]))]
            order = order[_changes(seed[order], piece[order], oid[order], tie[order], pos[order])]  # equal rows count once
            seed, piece, oid, tie, pos = (x[order] for x in (seed, piece, oid, tie, pos))
            new_seed, new_piece = _changes(seed), _changes(seed, piece)
            group = np.cumsum(new_seed) - 1
            pieces = np.bincount(group, new_piece)[group]
            total = np.bincount(group)[group]
            kind = np.where(new_piece, np.where(total > hot, 2, 1), 0).astype(np.int8)
            seed = np.where(new_piece, seed, 0)  # nobody asks for it where no text is needed
            keep = ~new_piece | (pieces > 1)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (oid, tie, pos, kind, seed)], ["oid", "tie", "pos", "kind", "seed"])

    return work


def slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges of a buffer as a binary column."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[index])]).cast(pa.binary())


def _range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """Hashes of the byte ranges ``start .. end`` (sorted by start), in blocks: numbers of 64 bits a byte are held for one only."""
    out, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        j = int(np.searchsorted(start, start[i] + block, "right"))
        lo, hi = start[i], end[i:j].max()
        out[i:j] = RangeHash(byte_values(data[lo:hi]))(start[i:j] - lo, end[i:j] - lo)
        i = j
    return out


def _pieces(length: int, seed: int):
    """Text around the anchors that need it, as ``key, low, high, text``: strings starting low..high bytes before the anchor."""
    reach = length - seed
    near = max(1, reach // 9)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            found = batch.column("found")
            fields = found.flatten()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            pos, kind, key = (fields.field(n).to_numpy() for n in range(3))
            need = np.flatnonzero(kind > 0)
            need = need[np.argsort(offsets[doc[need]] + pos[need], kind="stable")]
            oid, tie = batch.column("oid").to_numpy(), batch.column("tie").to_numpy()
            for k in range(0, len(need), PART_PIECES):
                part = need[k : k + PART_PIECES]
                yield from cut(data, offsets, oid, tie, doc[part], pos[part], kind[part], key[part])

    def cut(data, offsets, oid, tie, doc, pos, kind, key) -> Iterator[pa.RecordBatch]:
        at = offsets[doc] + pos
        left, right = np.maximum(at - reach, offsets[doc]), np.minimum(at + length, offsets[doc + 1])
        parts = [(np.flatnonzero(kind == 1), None, 0, reach)]
        if (kind == 2).any():
            # strings that start low..high before the anchor all hold the bytes from low before it to length - high after it
            for low, high in ((0, near), (near + 1, reach - near - 1), (reach - near, reach)):
                fits = np.flatnonzero((kind == 2) & (at - low >= left) & (at + length - high <= right))
                parts.append((fits, _range_hashes(data, at[fits] - low, at[fits] + length - high), low, high))
        for take, context, low, high in parts:
            if len(take):
                n = len(take)
                own = key[take] if context is None else (key[take].view(np.uint64) ^ context).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(oid[doc[take]]), pa.array(tie[doc[take]]), pa.array(pos[take]), pa.array((at - left)[take].astype(np.int16)), pa.array(np.full(n, low, np.int16)), pa.array(np.full(n, high, np.int16)), slices(data, left[take], right[take])],
                    ["key", "oid", "tie", "pos", "before", "low", "high", "text"],
                )

    return work


class ColumnTransform:
    """Column-wise transform of equally aligned pieces with an external column file.

    ``rounds()`` yields ``(column, order, prefix)`` from the last column to
    the first: the pieces in the order of their suffixes from that column, and
    the common prefix of each with the one before.  ``sink`` (two binary
    files) receives every round's transform symbols and prefixes.
    """

    def __init__(self, text: pa.Array, before: np.ndarray, reach: int, columns: int, strip: int = 20_000, sink=None):
        self.n, self.columns, self.sink = len(text), columns, sink
        self.file = tempfile.TemporaryFile()
        self.strips: list[tuple[int, int]] = []
        data, offsets = _binary(text)
        for first in range(0, self.n, strip):
            last = min(self.n, first + strip)
            block = np.zeros((last - first, columns), np.uint8)
            size = np.diff(offsets[first : last + 1])
            row = np.repeat(np.arange(last - first), size)
            column = np.arange(len(row)) - np.repeat(offsets[first:last] - offsets[first] - (reach - before[first:last]), size)
            block[row, column] = data[offsets[first] : offsets[last]]
            self.strips.append((self.file.tell(), last - first))
            np.ascontiguousarray(block.T).tofile(self.file)

    def column(self, c: int) -> np.ndarray:
        parts = []
        for start, n in self.strips:
            self.file.seek(start + c * n)
            parts.append(np.frombuffer(self.file.read(n), np.uint8))
        return np.concatenate(parts) if len(parts) != 1 else parts[0]

    def rounds(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        order = np.arange(self.n, dtype=np.int32)
        prefix = np.zeros(self.n, np.uint16 if self.columns > 255 else np.uint8)
        for c in range(self.columns - 1, -1, -1):
            symbols = self.column(c)[order]  # this round's transform: the symbol before each suffix
            put = np.argsort(symbols, kind="stable")
            longer = _range_min(prefix, put[:-1] + 1, put[1:]) if c < self.columns - 1 else np.zeros(max(self.n - 1, 0), prefix.dtype)
            same = symbols[put][1:] == symbols[put][:-1]
            prefix = np.concatenate([np.zeros(1, prefix.dtype), np.where(same, longer + 1, 0).astype(prefix.dtype)])
            order = order[put]
            if self.sink:
                self.sink[0].write(symbols.tobytes())
                self.sink[1].write(prefix.tobytes())
            yield c, order, prefix
        self.file.close()


def _binary(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([x.cast(pa.large_binary()) for x in column.chunks])
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of ``values[lo..hi]`` (inclusive; empty where hi < lo: not asked)."""
    gap = np.maximum(hi - lo + 1, 1)
    level = np.zeros(len(gap), np.int8)
    top = int(gap.max(initial=1)).bit_length() - 1
    out = np.empty(len(gap), values.dtype)
    table = values
    for k in range(top + 1):
        level = (gap >> k) == 1
        if level.any():
            a, b = lo[level], hi[level]
            out[level] = np.minimum(table[np.minimum(a, len(table) - 1)], table[np.clip(b - (1 << k) + 1, 0, len(table) - 1)])
        if k < top:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
    return out


def covered_columns(table: pa.Table, length: int, seed: int) -> np.ndarray:
    """``[piece, column]``: does the string from that column also start earlier?"""
    reach = length - seed
    before = table.column("before").to_numpy().astype(np.int64)
    text = table.column("text")
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    oid, tie, pos = (table.column(c).to_numpy() for c in ("oid", "tie", "pos"))
    n = table.num_rows
    rank = np.empty(n, np.int64)
    rank[np.lexsort((pos, tie, oid))] = np.arange(n)
    work = ColumnTransform(text, before, reach, reach + length)
    after = np.diff(_binary(text)[1]) - before
    out = np.zeros((n, reach + 1), bool)
    for c, order, prefix in work.rounds():
        if c > reach:
            continue
        back = reach - c  # the string starts this far before the anchor
        valid = (before >= back) & (after >= length - back) & (low <= back) & (back <= high)
        runs = np.flatnonzero(prefix < length)
        ranks = np.where(valid[order], rank[order], n)
        first = np.minimum.reduceat(ranks, runs)
        again = ranks > np.repeat(first, np.diff(np.append(runs, n)))
        out[order, c] = again & valid[order]
    return out


def _intervals(length: int, seed: int):
    reach = length - seed

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_chunks(batches, ["key"], SHARD_PIECES):
            hit = covered_columns(table, length, seed)
            oid, tie, pos = (table.column(c).to_numpy() for c in ("oid", "tie", "pos"))
            for k in range(0, len(hit), PART_PIECES):
                edge = np.diff(np.pad(hit[k : k + PART_PIECES], ((0, 0), (1, 1))).astype(np.int8), axis=1)
                row, first = np.nonzero(edge == 1)
                _, stop = np.nonzero(edge == -1)
                if len(row):
                    row += k
                    at = pos[row] - reach
                    yield pa.RecordBatch.from_arrays([pa.array(oid[row]), pa.array(tie[row]), pa.array(at + first), pa.array(at + stop - 1 + length)], ["oid", "tie", "start", "stop"])

    return work


def _cut(length: int, seed: int, with_text: bool, carry: bool):
    reach = length - seed

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            found, spans = batch.column("found"), batch.column("spans")
            bounds, cuts = found.offsets.to_numpy(), spans.offsets.to_numpy()
            pos, kind, _ = (found.values.field(n).to_numpy() for n in range(3))
            start, stop = (spans.values.field(n).to_numpy() for n in range(2))
            out = []
            for d in range(batch.num_rows):
                text = data[offsets[d] : offsets[d + 1]]
                whole = pos[bounds[d] : bounds[d + 1]][kind[bounds[d] : bounds[d + 1]] == 0]
                lo = np.concatenate([np.maximum(whole - reach, 0), start[cuts[d] : cuts[d + 1]]])
                hi = np.concatenate([np.minimum(whole + length, len(text)), stop[cuts[d] : cuts[d + 1]]])
                if len(lo):
                    gone = cover(lo, hi, len(text))
                    kept = text[~gone].tobytes()
                    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                else:
                    kept, runs = text.tobytes(), 0
                out.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), *([kept] if with_text else [])))
            columns = [pa.array(x) for x in zip(*out, strict=True)] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if with_text else []))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("oid"), batch.column("tie"), *columns, *([batch.column("rest")] if carry else [])],
                ["doc_id", "oid", "tie", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else []), *(["rest"] if carry else [])],
            )

    return work


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, hot: int = HOT, with_text: bool = False, carry: bool = False, store: Store | None = None) -> DataFrame:
    """Per document row: sizes and digest of what is left.

    ``with_text`` adds the bytes left, ``kept``; ``carry`` adds the row's
    other columns, ``rest``.  With ``store`` the documents are read twice, and
    what the anchors need of the disk is free before the other shuffles;
    without, this is one lazy plan.
    """
    n = width(docs.sparkSession)
    # every branch below takes all columns of ``texts``, so that Spark shuffles it once and reads the shuffle again
    texts = keyed(docs, carry=carry).repartition(n, "oid", "tie")
    source = texts if store is None else keyed(docs).select("oid", "tie", "text").repartition(n, "oid", "tie")
    anchors = source.mapInArrow(_anchors(length, seed), "seed long, piece long, oid long, tie long, pos long, settled boolean")
    found = anchors.repartition(n, "seed").sortWithinPartitions("seed").mapInArrow(_resolve(hot), "oid long, tie long, pos long, kind byte, seed long")
    if store is not None:
        found = store(found, "repeats_found")
    per_doc = found.groupBy("oid", "tie").agg(F.collect_list(F.struct("pos", "kind", "seed")).alias("found"))
    pieces = texts.join(per_doc.hint("shuffle_hash"), ["oid", "tie"]).mapInArrow(
        _pieces(length, seed), "key long, oid long, tie long, pos long, before short, low short, high short, text binary"
    )
    spans = pieces.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_intervals(length, seed), "oid long, tie long, start long, stop long")
    per_span = spans.groupBy("oid", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    none = {"found": "array<struct<pos:bigint,kind:tinyint,seed:bigint>>", "spans": "array<struct<start:bigint,stop:bigint>>"}
    joined = texts.join(per_doc.hint("shuffle_hash"), ["oid", "tie"], "left").join(per_span.hint("shuffle_hash"), ["oid", "tie"], "left")
    joined = joined.select(*texts.columns, *(F.coalesce(c, F.array().cast(t)).alias(c) for c, t in none.items()))
    schema = "doc_id long, oid long, tie long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    result = StructType.fromDDL(schema)
    if carry:
        result = StructType([*result.fields, texts.schema["rest"]])
    cut = joined.mapInArrow(_cut(length, seed, with_text, carry), result)
    # further rows with the same id and text repeat the first one's strings
    copy = F.row_number().over(Window.partitionBy("oid", "tie").orderBy("doc_id")) > 1
    again = cut.withColumn("again", copy & (F.col("n_bytes") >= length))
    out = again.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("again"), F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(F.col("again"), F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(F.col("again"), F.lit(_EMPTY_SHA)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        *([F.when(F.col("again"), F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if with_text else []),
        *(["rest"] if carry else []),
    )
    return out


def drop_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, store: Store | None = None) -> DataFrame:
    """The rows with the repeated bytes taken out of ``text``, other columns unchanged (``n_chars`` follows the text).

    A character of which only some bytes are left goes as well.
    """
    cut = remove_repeats(docs, length, seed, with_text=True, carry=True, store=store)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [x.as_py().decode(errors="ignore") for x in batch.column("kept")]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(text, pa.string())], ["rest", "text"])

    out = cut.select("rest", "kept").mapInArrow(decode, StructType([cut.schema["rest"], *StructType.fromDDL("text string").fields]))
    chars = F.length("text").cast("long")
    return out.select(*(F.col("text") if c == "text" else (chars if c == "n_chars" else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))
