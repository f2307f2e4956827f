"""Repeated word runs across documents, by FM-indexes over wavelet matrices.

Goal: remove every word covered by ``LENGTH`` consecutive words that also
start anywhere else, the same document included.

*Seeds.*  A word position is an anchor if the hash of its ``SEED`` words is the
least in some run of ``LENGTH - SEED + 1`` positions; every window of
``LENGTH`` words holds one, and equal windows hold it at the same place.
Pieces (all windows around an anchor) that occur twice as a whole are settled
by their hash.  A piece of its own goes to the shard of its seed if other
pieces share the seed, along with one copy of each of those.

*Index.*  Per shard, the pieces' words form one text whose Burrows-Wheeler
transform is held in a wavelet matrix: log2(alphabet) bit vectors with rank
counts.  The word at the anchor is replaced by a symbol of its seed, so that
only pieces of one seed match, and never a stretch of text with itself.

*Matching statistics.*  Documents' pieces are streamed through backward
search, many at once: from an end position the search extends to the left as
long as a second occurrence is left.  The left reach grows with the end
position, so ends between two with equal reach need no search of their own.
Reaches of at least ``LENGTH`` words are reported as word intervals.

*Scale.*  Text is shuffled once (by document), anchors once (by seed), pieces
once.  Copies that meet within a chunk of a map task are settled there, so a
hot seed is thinned before the shuffle.  Shards hold about ``SHARD_PIECES`` pieces, and no more than one key's beyond
that; words are hashed in blocks of bytes, a shard takes about a dozen 32-bit numbers a word.  Nothing is collected.  Seeds
with over ``HOT`` occurrences are dealt by contexts of nearly a window's length, each with just the text of its windows.

Defined results: null text has no words; rows under ``LENGTH`` words lose
nothing; equal rows repeat one another's windows and so lose them; an empty
table gives no rows; extra columns are ignored; ids may repeat or be null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.suffix_dedup import _binary, _changes, aligned, keyed, slices, width
from strata.llm.textops import RangeHash, Words, cover, doc_chunks, key_chunks, minimizers, mix, spread, word_chunks

LENGTH = 35
SEED = 8
HOT = 50_000
SHARD_PIECES = 10_000
#: Pieces searched at once.
ASK_PIECES = 1 << 14


def _anchors(length: int, seed: int):
    run = length - seed + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            oid, tie = batch.column("oid").to_numpy(), batch.column("tie").to_numpy()
            for i, _, words in word_chunks(batch.column("text")):
                if len(words) < length:
                    continue
                hashes = RangeHash(words.hash)
                every = np.arange(len(words) - seed + 1)
                key = hashes(every, every + seed)
                at = minimizers(key, run)
                doc = words.doc[at]
                first, stop = words.first[doc], words.first[doc + 1]
                fits = (at + seed <= stop) & (stop - first >= length)
                at, doc, first, stop = at[fits], doc[fits], first[fits], stop[fits]
                if len(at):
                    left = np.maximum(at - (length - seed), first)
                    piece = aligned(hashes(left, np.minimum(at + length, stop)), at - left)
                    columns = [key[at].view(np.int64), piece, oid[i + doc], tie[i + doc], at - first]
                    order = np.lexsort(columns[::-1])
                    columns = [c[order] for c in columns]
                    new = _changes(*columns[:2])
                    copied = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1
                    # 0: seen once in this chunk; 1: the first of several, to represent them; 2: settled here
                    state = np.where(new, copied, 2).astype(np.int8)
                    columns[0] = np.where(new, columns[0], spread(columns[2], columns[4]))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, state)], ["seed", "piece", "oid", "tie", "pos", "state"])

    return work


def _resolve(hot: int, rows: int = 1 << 18):
    """Of anchors sorted by seed: what is settled, and whose text is needed.

    ``kind`` bit 0: the whole piece occurs elsewhere.  Bit 1: its text joins
    the seed's shard.  Bit 2: the seed is hot.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_chunks(batches, ["seed"], rows):
            settled = table.column("state").to_numpy() == 2
            if settled.any():
                done = table.filter(pa.array(settled)).select(["oid", "tie", "pos", "seed"]).combine_chunks().to_batches()[0]
                kind = pa.array(np.ones(done.num_rows, np.int8))
                yield pa.RecordBatch.from_arrays([done.column(0), done.column(1), done.column(2), kind, done.column(3)], ["oid", "tie", "pos", "kind", "seed"])
                table = table.filter(pa.array(~settled))
            seed, piece, oid, tie, pos, state = (table.column(c).to_numpy() for c in ("seed", "piece", "oid", "tie", "pos", "state"))
            _, inverse, count = np.unique(seed, return_inverse=True, return_counts=True)
            some = np.flatnonzero((count[inverse] > 1) | (state == 1))
            if not len(some):
                continue
            order = some[np.lexsort((pos[some], tie[some], oid[some], piece[some], seed[some]))]
            seed, piece, oid, tie, pos, state = (x[order] for x in (seed, piece, oid, tie, pos, state))
            new_seed, new_piece = _changes(seed), _changes(seed, piece)
            group, kin = np.cumsum(new_seed) - 1, np.cumsum(new_piece) - 1
            copied = np.bincount(kin, 1 + state)[kin] > 1
            open_seed = np.bincount(group, ~copied)[group] > 0
            many = np.bincount(group, new_piece)[group] > 1
            shard = new_piece & open_seed & many
            kind = (copied * 1 + shard * 2 + (np.bincount(group)[group] > hot) * 4).astype(np.int8)
            keep = copied | shard
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (oid, tie, pos, kind, seed)], ["oid", "tie", "pos", "kind", "seed"])

    return work


def _pieces(length: int, seed: int):
    reach = length - seed
    wide = max(1, reach // 9) + 1
    # of a hot seed, windows that start low..high words before the anchor: all hold the words from low before it to length - high after it
    bands = [(low, min(low + wide - 1, reach)) for low in range(0, reach + 1, wide)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found")
            fields, bounds = found.values, found.offsets.to_numpy()
            pos, kind, key = (fields.field(n).to_numpy() for n in range(3))
            oid, tie = batch.column("oid").to_numpy(), batch.column("tie").to_numpy()
            for i, j, words in word_chunks(batch.column("text")):
                part = slice(bounds[i], bounds[j])
                doc = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))
                need = (kind[part] & 2) > 0
                doc, p, k, s = doc[need], pos[part][need], kind[part][need], key[part][need]
                if not len(doc):
                    continue
                at = words.first[doc] + p
                left, right = np.maximum(at - reach, words.first[doc]), np.minimum(at + length, words.first[doc + 1])
                plain = np.flatnonzero(k < 4)
                groups = [(plain, s[plain], 0, reach)]
                if len(plain) < len(k):
                    hashes = RangeHash(words.hash)
                    for low, high in bands:
                        take = np.flatnonzero((k >= 4) & (at - low >= left) & (at + length - high <= right))
                        context = hashes(at[take] - low, at[take] + length - high)
                        groups.append((take, (s[take].view(np.uint64) ^ context).view(np.int64), low, high))
                for take, own, low, high in groups:
                    n = len(take)
                    if n:
                        here = at[take]
                        first, stop = np.maximum(left[take], here - high), np.minimum(right[take], here + length - low)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own), pa.array(oid[i + doc[take]]), pa.array(tie[i + doc[take]]), pa.array(p[take]), pa.array((k[take] & 1) == 0), pa.array((here - first).astype(np.int16)), pa.array(np.full(n, low, np.int16)), pa.array(np.full(n, high, np.int16)), slices(words.data, words.start[first], words.end[stop - 1])],
                            ["key", "oid", "tie", "pos", "asks", "before", "low", "high", "text"],
                        )

    return work


class WaveletMatrix:
    """Rank over a sequence of symbols: one packed bit vector per symbol bit."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            packed = np.packbits(np.pad(ones.astype(np.uint8), (0, -len(ones) % 64 + 64)), bitorder="little").view(np.uint64)
            ahead = np.zeros(len(packed), np.int32)
            np.cumsum(np.bitwise_count(packed[:-1]), out=ahead[1:])
            zeros = len(ones) - int(ones.sum())
            self.levels.append((packed, ahead, zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])
        self.base = self._walk(np.arange(1 << self.bits), np.zeros(1 << self.bits, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (packed, ahead, zeros) in enumerate(self.levels):
            word = at >> 6
            ones = ahead[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where((symbol >> (self.bits - 1 - level)) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._walk(symbol, at) - self.base[symbol]


class FMIndex:
    """Backward search over a text of symbols 0..size-1 (patterns up to ``depth - 1`` symbols)."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        n = self.n = len(text)
        rank, span, order = text.astype(np.int32), 1, None  # 32 bits but for the sorted keys: a shard's memory is a few numbers a word
        while span < depth:  # prefix doubling, as deep as patterns go
            pair = rank.astype(np.int64)
            pair *= int(rank.max()) + 1
            turn = span if span < n else 0
            pair[: n - turn] += rank[turn:]
            pair[n - turn :] += rank[:turn]
            order = np.argsort(pair, kind="stable").astype(np.int32)
            pair = pair[order]
            rank[order] = np.cumsum(_changes(pair), dtype=np.int32) - 1
            span *= 2
            if int(rank.max()) == n - 1:
                break
        del rank, pair
        self.matrix = WaveletMatrix(text[order - 1].astype(np.int32), size)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.matrix.bits))])

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges after putting ``symbol`` in front."""
        both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) + np.tile(self.before[symbol], 2)
        return both[: len(lo)], both[len(lo) :]

    def reach(self, text: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Least start such that ``text[start:end]`` occurs at least twice; starts stop at ``first``."""
        at, out = end.copy(), end.copy()
        lo, hi = np.zeros(len(end), np.int64), np.full(len(end), self.n, np.int64)
        live = np.arange(len(end))
        while len(live):
            live = live[at[live] > first[live]]
            lo2, hi2 = self.extend(text[at[live] - 1], lo[live], hi[live])
            go = hi2 - lo2 >= 2
            live = live[go]
            lo[live], hi[live] = lo2[go], hi2[go]
            at[live] -= 1
            out[live] = at[live]
        return out


def matched_starts(words: np.ndarray, first: np.ndarray, before: np.ndarray, seed: np.ndarray, asks: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, seed_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matching statistics of pieces against one another.

    ``words``: hashes of all pieces' words; piece k is ``first[k]:first[k+1]``,
    its anchor ``before[k]`` words in.  Returns (piece, first start, end of
    starts) of runs of windows that occur elsewhere.
    """
    n = len(first) - 1
    anchor = first[:-1] + before
    named = words.copy()
    named[anchor] = mix(seed.view(np.uint64) + np.uint64(0x5EED))
    names = np.unique(named)
    size = len(names) + 1
    inside = np.ones(len(words) + n, bool)
    inside[first[1:] + np.arange(n)] = False
    text = np.zeros(len(words) + n, np.int32)  # 0 ends a piece
    text[inside] = np.searchsorted(names, named) + 1
    del named, names, inside
    start = first[:-1] + np.arange(n)
    stop = first[1:] + np.arange(n)
    index = FMIndex(text, size, 2 * length)

    at = start + before
    # ends of windows that hold the anchor and start low..high words before it
    ends_lo = np.maximum(np.maximum(start + length, at + seed_words), at - high + length)
    ends_hi = np.minimum(stop, at - low + length)
    asking = np.flatnonzero(asks & (ends_lo <= ends_hi))
    hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def search(who: np.ndarray, end: np.ndarray) -> np.ndarray:
        left = index.reach(text, start[who], end)
        good = end - left >= length
        from_ = np.maximum(left[good], ends_lo[who[good]] - length)
        hits.append((who[good], from_ - start[who[good]], end[good] - length + 1 - start[who[good]]))
        return left

    for k in range(0, max(1, len(asking)), ASK_PIECES):
        ask = asking[k : k + ASK_PIECES]
        e0, e1 = ends_lo[ask], ends_hi[ask]
        s0, s1 = search(ask, e0), search(ask, e1)
        while len(ask):
            # ends strictly between: reaches lie in s0..s1; windows start at or after the reach
            more = (s0 < s1) & (e1 - e0 > 1) & (e1 - 1 - length >= s0)
            ask, e0, e1, s0, s1 = ask[more], e0[more], e1[more], s0[more], s1[more]
            if not len(ask):
                break
            middle = (e0 + e1) // 2
            s = search(ask, middle)
            ask, e0, e1, s0, s1 = np.tile(ask, 2), np.concatenate([e0, middle]), np.concatenate([middle, e1]), np.concatenate([s0, s]), np.concatenate([s, s1])
    who, lo, hi = (np.concatenate(x) for x in zip(*hits, strict=True))
    return who, lo, hi


def _hashed(text: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all pieces, piece k's from ``first[k]`` on; the bytes are looked at in blocks."""
    hashes, sizes = [], [np.zeros(1, np.int64)]
    for chunk in text.chunks:
        data, offsets = _binary(chunk)
        for i, j in doc_chunks(offsets):
            words = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            hashes.append(words.hash)
            sizes.append(np.diff(words.first))
    return np.concatenate(hashes), np.cumsum(np.concatenate(sizes))


def _intervals(length: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_chunks(batches, ["key"], SHARD_PIECES):
            once = _changes(*(table.column(c).to_numpy() for c in ("key", "oid", "tie", "pos")))
            if not once.all():
                table = table.filter(pa.array(once))  # equal rows bring the same piece again
            words, first = _hashed(table.column("text"))
            key, oid, tie, pos, asks, before, low, high = (table.column(c).to_numpy() for c in ("key", "oid", "tie", "pos", "asks", "before", "low", "high"))
            before = before.astype(np.int64)
            who, lo, hi = matched_starts(words, first, before, key, asks, low.astype(np.int64), high.astype(np.int64), length, seed)
            if len(who):
                base = pos[who] - before[who]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(oid[who]), pa.array(tie[who]), pa.array(base + lo), pa.array(base + hi - 1 + length)], ["oid", "tie", "start", "stop"]
                )

    return work


def _cut(length: int, seed: int, with_text: bool):
    reach = length - seed

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, spans = batch.column("found"), batch.column("spans")
            bounds, cuts = found.offsets.to_numpy(), spans.offsets.to_numpy()
            pos, kind, _ = (found.values.field(n).to_numpy() for n in range(3))
            start, stop = (spans.values.field(n).to_numpy() for n in range(2))
            for i, j, words in word_chunks(batch.column("text")):
                out = []
                raw = words.data.tobytes()
                for d in range(j - i):
                    n = int(words.first[d + 1] - words.first[d])
                    every = raw[words.offsets[d] : words.offsets[d + 1]].split()
                    mine = slice(bounds[i + d], bounds[i + d + 1])
                    whole = pos[mine][(kind[mine] & 1) > 0]
                    own = slice(cuts[i + d], cuts[i + d + 1])
                    lo = np.concatenate([np.maximum(whole - reach, 0), start[own]])
                    if len(lo):
                        gone = cover(lo, np.concatenate([np.minimum(whole + length, n), stop[own]]), n)
                        every = [every[k] for k in np.flatnonzero(~gone)]
                    kept = b" ".join(every)
                    out.append((n, n - len(every), hashlib.sha256(kept).hexdigest(), *([kept.decode(errors="replace")] if with_text else [])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), *(pa.array(x) for x in zip(*out, strict=True))],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if with_text else [])],
                )

    return work


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """Per document row: word counts and digest of what is left (and the words, ``kept``, with ``with_text``)."""
    n = width(docs.sparkSession)
    texts = keyed(docs).repartition(n, "oid", "tie")
    anchors = texts.mapInArrow(_anchors(length, seed), "seed long, piece long, oid long, tie long, pos long, state byte")
    found = anchors.repartition(n, "seed").sortWithinPartitions("seed").mapInArrow(_resolve(hot), "oid long, tie long, pos long, kind byte, seed long")
    # sets: equal rows of one id find the same, once for all of them
    per_doc = found.groupBy("oid", "tie").agg(F.collect_set(F.struct("pos", "kind", "seed")).alias("found"))
    pieces = texts.join(per_doc.hint("shuffle_hash"), ["oid", "tie"]).mapInArrow(
        _pieces(length, seed), "key long, oid long, tie long, pos long, asks boolean, before short, low short, high short, text binary"
    )
    shards = pieces.repartition(n, "key").sortWithinPartitions("key", "oid", "tie", "pos")
    spans = shards.mapInArrow(_intervals(length, seed), "oid long, tie long, start long, stop long")
    per_span = spans.groupBy("oid", "tie").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    none = {"found": "array<struct<pos:bigint,kind:tinyint,seed:bigint>>", "spans": "array<struct<start:bigint,stop:bigint>>"}
    joined = texts.join(per_doc.hint("shuffle_hash"), ["oid", "tie"], "left").join(per_span.hint("shuffle_hash"), ["oid", "tie"], "left")
    joined = joined.select("doc_id", "text", *(F.coalesce(c, F.array().cast(t)).alias(c) for c, t in none.items()))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return joined.mapInArrow(_cut(length, seed, with_text), schema)
