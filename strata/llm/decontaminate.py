"""Benchmark decontamination: BM25 retrieval with block-max WAND, then overlap checks.

The test items form inverted indexes by length class (up to 8, 16, 32, ...
words): BM25 impacts, scaled so that an item scores 1 against its own words,
with the largest impact of each term in every block of items.  Every passage of
every document (windows of twice the class's length, moved by that length, so
that any copy of an item lies inside one) queries the index of the class for
all items above ``THRESHOLD``.  Bounds of all (passage, block) pairs come from
a vectorised pass over the stored (term, block) entries; blocks whose bound
reaches the threshold are searched by WAND.  A retrieved item counts as leaked
if the passage holds enough of the question's and of the answer's word n-grams
(the answer is the item's last line, else its last sentence, else its last
quarter).  As a passage's length follows from the item alone, other items bear
on its verdict through the term statistics only, which cover all items.

The index goes to the tasks in slices of about ``SLICE_BYTES`` of item text; a
larger benchmark takes several passes.  Long documents are searched whole.

Defined results: null or wordless texts and items match nothing; rows are
judged one by one (repeated rows repeat their result); equal items are reported
under each id; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.textops import ALNUM, Words, word_chunks
from strata.session import scratch_path

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach.
THRESHOLD = 0.6
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.6, 0.5
GRAM = 3
BLOCK_ITEMS = 4
SLICE_BYTES = 4 << 20
#: (passage, block) bounds summed at once.
BOUNDS = 1 << 20

LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _words(text: str) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return Words(data, np.array([0, len(data)]), ALNUM, lower=True).hash


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    size = max(1, min(size, len(hashes)))
    out = hashes[: len(hashes) - size + 1].copy()
    for k in range(1, size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - size + 1 + k]
    return np.unique(out)


def split_item(text: str) -> tuple[str, str]:
    """``(question, answer)`` of an item's text."""
    text = (text or "").strip()
    for pattern in (r"\n", r"(?<=[.!?])\s+"):
        parts = [p for p in re.split(pattern, text) if p.strip()]
        if len(parts) > 1:
            return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = max(1, len(words) * 3 // 4)
    return " ".join(words[:cut]), " ".join(words[cut:])


def passage_step(n_words: int) -> int:
    """Length class of an item: the power of two (8 or more) that holds its words."""
    return 1 << max(3, (n_words - 1).bit_length())


class Index:
    """Impact-ordered postings of one class's items, with block maxima."""

    def __init__(self, items: list[tuple[int, str]], idf: dict[int, float], mean_length: float):
        bags = [(i, t, w) for i, t in items if len(w := _words(t))]
        self.ids = [x[0] for x in bags]
        self.step = passage_step(max((len(x[2]) for x in bags), default=1))
        self.blocks = -(-len(bags) // BLOCK_ITEMS)
        self.checks, parts = [], []
        for n, (_, text, words) in enumerate(bags):
            terms, counts = np.unique(words, return_counts=True)
            weight = np.array([idf[int(t)] for t in terms])
            impact = weight * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(words) / mean_length))
            parts.append((terms, np.full(len(terms), n), impact / impact.sum()))
            question, answer = (_words(x) for x in split_item(text))
            self.checks.append(tuple((min(GRAM, len(x)), _grams(x, GRAM)) if len(x) else None for x in (question, answer)))
        terms, item, impact = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))
        self.terms, term = np.unique(terms, return_inverse=True)
        order = np.lexsort((item, term))
        term, self.item, self.impact = term[order], item[order], impact[order]
        # entries (term, block) in order; the postings of entry e are first[e] .. first[e + 1]
        key = term * max(self.blocks, 1) + self.item // BLOCK_ITEMS
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.entry = key[cut]
        self.first = np.append(cut, len(key))
        self.bound = np.maximum.reduceat(self.impact, cut) if len(key) else self.impact
        self.of_term = np.searchsorted(self.entry, np.arange(len(self.terms) + 1) * max(self.blocks, 1))

    def postings(self, entry: int) -> list[tuple[int, float]]:
        at = slice(self.first[entry], self.first[entry + 1])
        return list(zip(self.item[at].tolist(), self.impact[at].tolist(), strict=True))

    def search(self, terms: np.ndarray, block: int) -> list[tuple[int, float]]:
        """WAND over one block: all its items scoring at least the threshold."""
        want = np.asarray(terms, np.int64) * self.blocks + block
        at = np.minimum(np.searchsorted(self.entry, want), len(self.entry) - 1)
        lists = [[self.postings(e), 0, float(self.bound[e])] for e in at[self.entry[at] == want].tolist()]
        found, need = [], THRESHOLD - 1e-6
        while lists:
            lists.sort(key=lambda x: x[0][x[1]][0])
            total, pivot = 0.0, None
            for k, x in enumerate(lists):
                total += x[2]
                if total >= need:
                    pivot = x[0][x[1]][0]
                    break
            if pivot is None:
                break
            if lists[0][0][lists[0][1]][0] == pivot:
                score = 0.0
                for x in lists:
                    if x[0][x[1]][0] == pivot:
                        score += x[0][x[1]][1]
                        x[1] += 1
                if score >= need:
                    found.append((pivot, score))
            else:
                for x in lists[: k + 1]:
                    while x[1] < len(x[0]) and x[0][x[1]][0] < pivot:
                        x[1] += 1
            lists = [x for x in lists if x[1] < len(x[0])]
        return found

    def overlaps(self, item: int, words: np.ndarray) -> tuple[float, float]:
        out = []
        for check in self.checks[item]:
            if check is None or len(words) < check[0]:
                out.append(1.0 if check is None else 0.0)
            else:
                out.append(float(np.isin(check[1], _grams(words, check[0])).mean()))
        return out[0], out[1]

    def candidates(self, passage: np.ndarray, term: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
        """``(passage, its terms, block)`` wherever the block's bound reaches the threshold; input sorted by passage."""
        cut = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        size = (self.of_term[1:] - self.of_term[:-1])[term]
        before = np.concatenate([[0], np.cumsum(size)])  # entries before each (passage, term)
        ends = np.append(cut, len(term))
        done = 0
        while done < len(cut):
            upto = max(done + 1, int(np.searchsorted(before[ends], before[ends[done]] + BOUNDS, "right")) - 1)
            lo, hi = ends[done], ends[upto]
            mine = size[lo:hi]
            entries = np.arange(mine.sum()) + np.repeat(self.of_term[term[lo:hi]] - (before[lo:hi] - before[lo]), mine)
            number = np.repeat(np.repeat(np.arange(upto - done), np.diff(ends[done : upto + 1])), mine)
            bounds = np.bincount(number * self.blocks + self.entry[entries] % self.blocks, self.bound[entries], (upto - done) * self.blocks)
            for at in np.flatnonzero(bounds >= THRESHOLD - 1e-4).tolist():
                p, block = divmod(at, self.blocks)
                yield int(passage[cut[done + p]]), term[ends[done + p] : ends[done + p + 1]], block
            done = upto

    def leaks(self, words: Words, known: np.ndarray, term: np.ndarray) -> list[tuple[int, int, float, float, float]]:
        """``(document, item id, score, question overlap, answer overlap)`` of the chunk, whose words ``known`` are these terms."""
        if not len(known):
            return []
        # passages [k * step, k * step + 2 * step) of each document: a word lies in up to two
        step = self.step
        last = (known - words.first[words.doc[known]]) // step
        starts = np.cumsum(np.concatenate([[0], np.maximum(1, -(-np.diff(words.first) // step))]))
        own = starts[words.doc[known]] + last
        twice = last > 0
        pairs = np.unique(np.concatenate([own, own[twice] - 1]) * len(self.terms) + np.concatenate([term, term[twice]]))
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for number, terms, block in self.candidates(*np.divmod(pairs, len(self.terms))):
            doc = int(np.searchsorted(starts, number, "right")) - 1
            w0 = words.first[doc] + (number - starts[doc]) * step
            w1 = min(w0 + 2 * step, words.first[doc + 1])
            for item, score in self.search(terms, block):
                q, a = self.overlaps(item, words.hash[w0:w1])
                if q >= QUESTION_OVERLAP and a >= ANSWER_OVERLAP:
                    best[doc, item] = max(best.get((doc, item), (0.0, 0.0, 0.0)), (score, q, a))
        return [(doc, self.ids[item], *x) for (doc, item), x in sorted(best.items())]


class Slice:
    """The indexes of one slice of items, one per length class."""

    def __init__(self, items: list[tuple[int, str]], idf: dict[int, float], mean_length: float):
        classes: dict[int, list[tuple[int, str]]] = {}
        for item in items:
            if n := len(_words(item[1])):
                classes.setdefault(passage_step(n), []).append(item)
        self.indexes = [Index(classes[step], idf, mean_length) for step in sorted(classes)]
        self.terms = np.unique(np.concatenate([x.terms for x in self.indexes])) if classes else np.zeros(0, np.uint64)
        #: Number of each term within each index, -1 where it has none.
        self.local = np.full((len(self.indexes), len(self.terms)), -1, np.int64)
        for own, index in zip(self.local, self.indexes, strict=True):
            own[np.searchsorted(self.terms, index.terms)] = np.arange(len(index.terms))

    def leaks(self, words: Words) -> list[tuple[int, int, float, float, float]]:
        if not len(words) or not len(self.terms):
            return []
        at = np.minimum(np.searchsorted(self.terms, words.hash), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == words.hash)
        out = []
        for own, index in zip(self.local, self.indexes, strict=True):
            term = own[at[known]]
            out += index.leaks(words, known[term >= 0], term[term >= 0])
        return sorted(out)


def item_table(benchmark: DataFrame) -> DataFrame:
    return benchmark.selectExpr("cast(item_id as long) as item_id", "coalesce(text, '') as text")


def term_statistics(items: DataFrame) -> tuple[DataFrame, int, float]:
    """Document frequency of every term over all items, their number and mean length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in word_chunks(batch.column(0), ALNUM, lower=True):
                for d in range(j - i):
                    mine = words.hash[words.first[d] : words.first[d + 1]]
                    terms = np.unique(mine).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(np.full(len(terms), len(mine)))], ["term", "length"])

    terms = items.select("text").mapInArrow(run, "term long, length long")
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    counted = items.select(F.expr("size(regexp_extract_all(text, '[0-9A-Za-z\\\\x{80}-\\\\x{10ffff}]+', 0))").alias("n"))
    total, mean = counted.agg(F.count("*"), F.avg("n")).first()
    return df, int(total), float(mean or 1.0)


def index_slices(benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Indexes of bounded size that together hold every item.

    Items and term statistics of a benchmark of several slices are stored once.
    """
    spark = benchmark.sparkSession
    items = item_table(benchmark)
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-int(volume) // slice_bytes))
    df, total, mean = term_statistics(items)
    placed = items.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)))
    if slices > 1:
        at = scratch_path(spark, "benchmark")
        df.write.parquet(f"{at}/terms")
        placed.repartition("slice").write.partitionBy("slice").parquet(f"{at}/items")
        df = spark.read.schema(df.schema).parquet(f"{at}/terms")
        placed = spark.read.schema(placed.schema).parquet(f"{at}/items")
    for n in range(slices):
        mine = placed.filter(F.col("slice") == n).drop("slice")
        held = _slice_terms(mine).join(df, "term")
        idf = {t % (1 << 64): float(np.log(1 + (total - c + 0.5) / (c + 0.5))) for t, c in held.collect()}
        rows = [(r.item_id, r.text) for r in mine.orderBy("item_id", "text").collect()]
        yield Slice(rows, idf, mean)


def _slice_terms(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in word_chunks(batch.column(0), ALNUM, lower=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(words.hash).view(np.int64))], ["term"])

    return items.select("text").mapInArrow(run, "term long").distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and leaked item."""
    spark = docs.sparkSession
    chosen = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    out = None
    for index in index_slices(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column(0)
                for i, _, words in word_chunks(batch.column(1), ALNUM, lower=True):
                    rows = index.leaks(words)
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array([i + r[0] for r in rows])),
                                pa.array([r[1] for r in rows], pa.int64()),
                                *(pa.array([round(float(r[k]), 6) for r in rows], pa.float64()) for k in (2, 3, 4)),
                            ],
                            ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                        )

        part = chosen.mapInArrow(run, LEAKS)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows (all columns) without any leaked item; no shuffle."""
    spark = docs.sparkSession
    at = docs.columns.index(text_col)
    for index in index_slices(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for i, _, words in word_chunks(batch.column(at), ALNUM, lower=True):
                    for row in index.leaks(words):
                        clean[i + row[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
