"""Byte-string and word-window dedup against plain versions."""

import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, docs_frame, out, stored  # noqa: F401

from strata.llm import queries, substring_fm, suffix_dedup, textops

BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def fixture(seed, n=80):
    rnd = random.Random(seed)

    def prose(k):
        return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 8))) for _ in range(k))

    shared, rows = [prose(60) for _ in range(4)], []
    for i in range(n):
        text = prose(rnd.randint(0, 50))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared)
            if rnd.random() < 0.5:
                p = p[rnd.randint(0, 60) :]
            if rnd.random() < 0.5:
                k = rnd.randint(0, len(p))
                p = p[:k] + "X" + p[k:]
            text += p + prose(rnd.randint(0, 20))
        rows.append((i, text))
    rows += [(200, rows[3][1]), (201, None), (202, ""), (203, "a" * 300), (204, "ab cd " * 100), (205, "\x00" * 250), (None, rows[7][1])]
    rows += [(400 + k, "é" + "b" * (120 + 7 * k) + "c d " * k) for k in range(12)] + [(450 + k, "u v " * (20 + k)) for k in range(6)]
    rows += [(300, rows[9][1]), (300, rows[9][1]), (301, prose(3000) + shared[0])]  # repeated rows, a long text
    return rows


@pytest.mark.parametrize("hot", [50_000, 3])
def test_byte_strings(spark, hot):
    rows = fixture(5)
    got = suffix_dedup.remove_repeats(docs_frame(spark, rows, extra=True), hot=hot, with_text=True)
    assert out(got, *BYTES) == brute.suffix_dedup(rows)
    assert all(brute.sha(bytes(r.kept)) == r.kept_sha256 for r in got.select("kept", "kept_sha256").collect())


@pytest.mark.parametrize("hot", [50_000, 3])
def test_word_windows(spark, hot):
    rows = fixture(6)
    assert out(substring_fm.remove_repeats(docs_frame(spark, rows, extra=True), hot=hot), *WORDS) == brute.word_windows(rows)


def test_empty_tables(spark):
    empty = docs_frame(spark, [])
    assert suffix_dedup.remove_repeats(empty).collect() == [] and substring_fm.remove_repeats(empty).collect() == []


def test_text_is_shuffled_once(spark):
    plan = suffix_dedup.remove_repeats(spark.read.parquet(f"{SF}/documents.parquet"))
    plan.collect()
    assert plan._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2


def test_dropping_repeats_keeps_other_columns(spark):
    rows = [(1, "é" + "b" * 150), (2, "c" + "b" * 150 + "é")]
    df = docs_frame(spark, rows, extra=True).selectExpr("*", "0L as n_chars")
    got = {r.doc_id: r for r in suffix_dedup.drop_repeats(df).collect()}
    assert got[1].text == "éb"
    assert got[2].source == "s" and got[2].n_chars == len(got[2].text) and list(got[2].asDict()) == df.columns


def test_column_transform_against_sorted_suffixes():
    rnd = np.random.default_rng(1)
    text = [bytes(rnd.integers(97, 99, 12).astype(np.uint8)) for _ in range(40)]
    work = suffix_dedup.ColumnTransform(pa.array(text, pa.binary()), np.zeros(40, np.int64), 0, 12, strip=7)
    for column, order, prefix in work.rounds():
        tails = [text[k][column:] for k in order]
        assert tails == sorted(tails)
        for a, b, n in zip(tails, tails[1:], prefix[1:], strict=False):
            assert a[:n] == b[:n] and (n == len(a) or a[n] != b[n])


def test_fm_index_counts_and_reaches():
    rnd = np.random.default_rng(2)
    text = np.append(rnd.integers(1, 4, 200), 0)
    index = substring_fm.FMIndex(text, 4, 64)
    for _ in range(50):
        at, k = rnd.integers(0, 190), rnd.integers(1, 8)
        lo, hi = np.zeros(1, np.int64), np.full(1, len(text))
        for symbol in text[at : at + k][::-1]:
            lo, hi = index.extend(np.array([symbol]), lo, hi)
        assert hi[0] - lo[0] == sum((text[i : i + k] == text[at : at + k]).all() for i in range(len(text) - k + 1))
        left = index.reach(text, np.zeros(1, np.int64), np.array([at + k]))[0]
        alone = [s for s in range(at + k) if sum((text[i : i + at + k - s] == text[s : at + k]).all() for i in range(len(text) - (at + k - s) + 1)) >= 2]
        assert left == min(alone)


def test_words_hash_the_same_in_blocks():
    rnd = np.random.default_rng(4)
    data = rnd.choice(np.frombuffer(b"abcABC\xc3\xa9  \n", np.uint8), 2 * textops.CHUNK_BYTES + 77)
    data[1000 : 1200 + textops.CHUNK_BYTES] = 120  # a word longer than a block
    for lower in (False, True):
        words = textops.Words(data, np.array([0, 300, 300, len(data)]), lower=lower)
        assert (words.hash == textops.RangeHash(textops.byte_values(data, lower))(words.start, words.end)).all()
    assert len(textops.Words(data[:0], np.array([0, 0])).hash) == 0


def test_a_large_shard_takes_little_memory():
    rnd, n = np.random.default_rng(5), 12_000
    seed = b" seed of eight words that all pieces share "
    text = [" ".join(f"w{k}" for k in rnd.integers(0, 9000, 27)).encode() + seed + " ".join(f"w{k}" for k in rnd.integers(0, 9000, 27)).encode() for _ in range(n)]
    text[7] = text[9] = b"x" + text[5][1:]  # a changed first word, then copies
    numbers = [np.full(n, 1), np.arange(n), np.arange(n), np.full(n, 30), np.ones(n, bool)] + [np.full(n, k, np.int16) for k in (27, 0, 27)]
    table = pa.RecordBatch.from_arrays([*(pa.array(x) for x in numbers), pa.array(text, pa.binary())], ["key", "oid", "tie", "pos", "asks", "before", "low", "high", "text"])
    batches = [table.slice(k, 4000) for k in range(0, n, 4000)]
    tracemalloc.start()
    got = pa.Table.from_batches(substring_fm._intervals(35, 8)(iter(batches))).to_pydict()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    spans = {}
    for oid, start, stop in zip(got["oid"], got["start"], got["stop"], strict=True):
        spans.setdefault(oid, set()).update(range(start, stop))
    assert spans == {5: set(range(4, 65)), 7: set(range(3, 65)), 9: set(range(3, 65))}
    assert peak < 20 * sum(map(len, text))


def test_a_hot_phrase_is_dealt_by_contexts_near_a_window():
    n, phrase = 300, [f"p{k}" for k in range(30)]
    rows = [(k, [f"a{k}x{j}" for j in range(30)] + phrase + [f"b{k}x{j}" for j in range(30)]) for k in range(n)]
    rows += [(n + k, [f"c{k}x{j}" for j in range(30)] + ["q1", "q2", "q3", *phrase, "q4", "q5"] + [f"d{k}x{j}" for j in range(30)]) for k in range(2)]
    at = pa.array([[{"pos": 41 if k < n else 44, "kind": 6, "seed": 1}] for k, _ in rows], pa.list_(pa.struct([("pos", pa.int64()), ("kind", pa.int8()), ("seed", pa.int64())])))
    ids, text = pa.array([k for k, _ in rows]), pa.array([" ".join(w) for _, w in rows])
    batch = pa.RecordBatch.from_arrays([ids, ids, text, at], ["oid", "tie", "text", "found"])
    pieces = pa.Table.from_batches(substring_fm._pieces(35, 8)(iter([batch])))
    _, count = np.unique(pieces.column("key").to_numpy(), return_counts=True)
    assert count.max() == 2  # the two whose whole window recurs, not all 302
    assert {b - a for a, b in set(zip(pieces.column("low").to_pylist(), pieces.column("high").to_pylist(), strict=True))} == {3}
    met = pieces.sort_by("key").combine_chunks().to_batches()
    got = pa.Table.from_batches(substring_fm._intervals(35, 8)(iter(met))).to_pydict()
    assert {(o, a, b) for o, a, b in zip(got["oid"], got["start"], got["stop"], strict=True)} == {(n, 30, 65), (n + 1, 30, 65)}


def test_hot_pieces_take_little_memory():
    """Contexts of hot anchors are hashed in blocks, with the hashes of the whole text, and pieces are cut in parts."""
    rnd = np.random.default_rng(7)
    data, size, n = rnd.integers(97, 123, 8 << 20).astype(np.uint8), 1 << 13, 1 << 10
    offsets = np.arange(0, len(data) + 1, size, dtype=np.int32)
    text = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    at = [[{"pos": int(k), "kind": 2, "seed": 1} for k in (300, 100, size - 100, size - 24)] for _ in range(n)]
    found = pa.array(at, pa.list_(pa.struct([("pos", pa.int64()), ("kind", pa.int8()), ("seed", pa.int64())])))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.arange(n)), text, found], ["oid", "tie", "text", "found"])
    hashes = textops.RangeHash(textops.byte_values(data))
    tracemalloc.start()
    got = pa.Table.from_batches(suffix_dedup._pieces(100, 24)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(data)
    place = got.column("oid").to_numpy() * size + got.column("pos").to_numpy()
    low, high = (got.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
    assert (got.column("key").to_numpy().view(np.uint64) == hashes(place - low, place + 100 - high) ^ np.uint64(1)).all()
    assert got.num_rows == n * (3 + 3 + 3 + 1)  # the last one is too near the end for strings that start at or just before it


def test_spans_of_a_large_shard_in_parts(monkeypatch):
    rnd, n = np.random.default_rng(8), 300
    text = [bytes(rnd.integers(97, 123, 76).astype(np.uint8)) + b"s" * 24 + bytes(rnd.integers(97, 123, 76).astype(np.uint8)) for _ in range(n)]
    text[200] = b"x" * 30 + text[5][30:]
    columns = [np.full(n, 1), np.arange(n), np.arange(n), np.full(n, 500)] + [np.full(n, k, np.int16) for k in (76, 0, 76)]
    batch = pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns), pa.array(text, pa.binary())], ["key", "oid", "tie", "pos", "before", "low", "high", "text"])
    monkeypatch.setattr(suffix_dedup, "PART_PIECES", 64)
    got = pa.Table.from_batches(suffix_dedup._intervals(100, 24)(iter([batch]))).to_pylist()
    assert got == [{"oid": 200, "tie": 200, "start": 500 - 76 + 30, "stop": 600}]


@pytest.mark.parametrize("hot", [50_000, 3])
def test_byte_strings_with_stored_anchors(spark, stored, hot):
    rows, names = fixture(5), []
    got = suffix_dedup.remove_repeats(docs_frame(spark, rows, extra=True), hot=hot, with_text=True, store=lambda df, name: names.append(name) or stored(df, name))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert names == ["repeats_found"] and "hashpartitioning(seed" not in plan  # the anchors' shuffle is no part of it
    assert out(got, *BYTES) == brute.suffix_dedup(rows)


def test_shuffle_files_of_a_plan_stored_alone_are_gone(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle")}

    before = files()
    op1 = queries.op1_suffix_dedup(spark, SF)
    assert files() <= before
    kept = queries.store(spark, op1, "kept")
    assert files() - before and kept.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert spark.conf.get(queries.FREE_SHUFFLES) == "false"
