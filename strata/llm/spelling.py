"""Group spelling variants: words one edit apart, by asymmetric q-chunks.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased.  An
occurrence whose crc32 of ``<doc_id>:<run>`` is divisible by ``EVERY`` loses
the code point at place crc32 mod length (a reproducible misspelling).  Words
with at least ``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences take part.

Two words are near if one inserted, deleted or replaced code point makes one
of the other.  The shorter word (either one of two equally long) contributes
two disjoint chunks, its halves; the other one positional grams of the halves'
lengths.  One edit lies in one half, so the other half is a gram of the other
word at the same place or shifted by one; grams elsewhere cannot meet a chunk
within that shift and are not sent.  Words that share (length, place, chunk)
meet in a join, which verifies the distance before a pair leaves it.

A chunk of more than ``GROUP`` words is not joined.  Its words are dealt again
by longer keys: the half in which the edit lies is cut into halves, and the
intact one of these joins the key.  At the end a key holds all but one code
point, so what shares it is near; no group of chance meetings stays large,
whatever the words, and no pair is lost.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least ``RATIO`` times its own; roots follow forms by
pointer doubling (counts grow by ``RATIO`` a step, so chains are short).

Every join is a merge join by hint.  All tables here grow with the corpus, and
Spark sizes them by their compressed files, an exploded one even without the
explosion: it would broadcast the chunks of millions of words.

Defined results: null texts have no words; a null id is the empty text in the
crc; repeated rows count again; very long runs are words like others; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import Store

EVERY = 31
MIN_CHARS = 7
MIN_COUNT = 2
RATIO = 10
#: Words that share a chunk beyond which longer keys deal them.
GROUP = 200
#: Distinct words that a task counts before it sends them on.
HELD = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _occurrences(every: int, min_chars: int):
    """Partial word counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run in _RUN.findall(text.as_py().lower().decode("utf-8", "replace")):  # bytes: only A-Z change
                    if len(run) < min_chars:
                        continue
                    h = zlib.crc32(run.encode(), start)
                    if h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < min_chars:
                            continue
                    held[run] = held.get(run, 0) + 1
                if len(held) > HELD:
                    yield emit()
        if held:
            yield emit()

    return work


def word_counts(docs: DataFrame, every: int = EVERY, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: the words that take part, over all documents."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = rows.mapInArrow(_occurrences(every, min_chars), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _segment(kind: str, gram: bool, size: Column, low: Column, high: Column) -> Column:
    """The edit lies in code points ``low .. high`` of the shorter word, which has ``size``; ``gram``: seen from the other word."""
    return F.struct(F.lit(kind).alias("kind"), F.lit(gram).alias("gram"), size.alias("size"), low.alias("low"), high.alias("high"))


def _halves(kind: str, gram: bool, size: Column, low: Column, high: Column) -> list[Column]:
    middle = low + F.floor((high - low) / 2).cast("int")
    return [_segment(kind, gram, size, low, middle), _segment(kind, gram, size, middle, high)]


def _keyed(rows: DataFrame) -> DataFrame:
    """Add the key of a row: what the edit leaves intact of the word, and where.

    Keys are 64-bit hashes; words that meet by an equal hash alone are not near.
    """
    before = F.expr("substring(word, 1, low)")
    after = F.expr("substring(word, high + 1 + if(gram and kind = 'insert', 1, 0), length(word))")
    return rows.withColumn("key", F.xxhash64("kind", "size", "low", "high", before, after))


def _first_cut(words: DataFrame) -> DataFrame:
    """Chunks and grams of every word: ``word, n, kind, gram, size, low, high``."""
    size, zero = F.length("word"), F.lit(0)
    parts = [
        *_halves("replace", False, size, zero, size),
        *_halves("replace", True, size, zero, size),
        *_halves("insert", False, size, zero, size),
        *_halves("insert", True, size - 1, zero, size - 1),
    ]
    return words.select("word", "n", F.explode(F.array(*parts)).alias("s")).select("word", "n", "s.*")


def _cut_again(rows: DataFrame) -> DataFrame:
    low, middle, high = F.col("low"), F.col("low") + F.floor((F.col("high") - F.col("low")) / 2).cast("int"), F.col("high")
    ends = F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high")))
    return rows.withColumn("e", F.explode(ends)).select("word", "n", "kind", "gram", "size", "e.low", "e.high")


def _meet(rows: DataFrame) -> DataFrame:
    """Verified pairs of the words that share a key."""
    chunk = rows.filter(~F.col("gram")).select("key", "kind", F.col("word").alias("a"), F.col("n").alias("a_n"))
    gram = rows.filter("gram").select(F.col("key").alias("g_key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    once = (F.col("kind") == "insert") | (F.col("a") < F.col("b"))
    near = (F.col("key") == F.col("g_key")) & once & (F.levenshtein("a", "b", 1) == 1)
    return chunk.join(gram.hint("merge"), near).select("a", "a_n", "b", "b_n")


def near_words(words: DataFrame, store: Store, group: int = GROUP) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words one edit apart, once.  ``words`` is read more than once: store it."""
    rows, found = _keyed(_first_cut(words)), []
    while True:
        # a segment of one code point cannot be cut: what shares its key is near, or nearly so
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.bool_or("gram").alias("grams"), F.bool_and("gram").alias("no_chunk"))
        sizes = sizes.filter("grams and not no_chunk").select(F.col("key").alias("s_key"), "rows")
        dealt = rows.join(sizes.hint("merge"), F.col("key") == F.col("s_key")).drop("s_key")
        again = (F.col("rows") > 2 * group) & (F.col("high") - F.col("low") > 1)
        found.append(store(_meet(dealt.filter(~again)), "near_words"))
        rest = store(_keyed(_cut_again(dealt.filter(again))), "large_chunks")
        if rest.isEmpty():
            break
        rows = rest
    return reduce(DataFrame.unionByName, found).dropDuplicates(["a", "b"])


def _roots(forms: DataFrame, store: Store) -> DataFrame:
    """``word, root`` of the words that have a form."""
    steps = store(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        up = steps.select(F.col("word").alias("u_word"), F.col("root").alias("up"))
        jumped = steps.join(up.hint("merge"), F.col("root") == F.col("u_word"), "left")
        steps = store(jumped.select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "spelling_roots")
        if steps.filter("moved").isEmpty():
            return steps.select("word", "root")


def group_variants(docs: DataFrame, store: Store, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """Per word: ``word, n, n_near, form, form_n, root``."""
    words = store(word_counts(docs), "spelling_words")
    pairs = near_words(words, store, group)
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    near = pairs.select(F.explode(ends).alias("e")).select("e.*")
    best = near.groupBy(F.col("word").alias("b_word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    )
    joined = words.join(best.hint("merge"), F.col("word") == F.col("b_word"), "left")
    has_form = -F.col("best.minus") >= ratio * F.col("n")
    formed = store(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form"),
            F.when(has_form, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling_forms",
    )
    roots = _roots(formed.filter("form is not null"), store).withColumnRenamed("word", "r_word")
    out = formed.join(roots.hint("merge"), F.col("word") == F.col("r_word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
