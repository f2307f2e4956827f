"""Rows without ids: texts whose short hashes collide stay apart, copies cost no more than themselves; links contract."""

import random

import brute
import numpy as np
import pytest
from helpers import docs_frame, out, stored  # noqa: F401
from pyspark.sql import functions as F

from strata.llm import line_rules, ngram_join, substring_fm, suffix_dedup, textops


@pytest.fixture(scope="module")
def colliding(spark):
    """Two texts of 40 random words whose 64-bit hashes agree in the upper 32 bits."""
    text = F.concat_ws(" ", *[F.md5(F.concat_ws("-", "id", F.lit(k))) for k in range(40)])
    rows = spark.range(0, 250_000, 1, 8).select("id", F.shiftright(F.xxhash64(text), 32).alias("h"))
    pair = rows.groupBy("h").agg(F.collect_list("id").alias("ids")).filter("size(ids) > 1").first()["ids"][:2]
    return [r[0] for r in spark.createDataFrame([(i,) for i in pair], "id long").select(text).collect()]


def test_colliding_texts_under_null_ids(spark, stored, colliding):
    a, b = colliding
    rows = [(None, a), (None, b), (1, a)]
    docs = docs_frame(spark, rows)
    bytes_ = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert out(suffix_dedup.remove_repeats(docs), *bytes_) == brute.suffix_dedup(rows)
    assert out(substring_fm.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.word_windows(rows)
    assert out(ngram_join.near_duplicates(docs, stored), "doc_id", "n_shingles", "component_id") == brute.near_duplicates(rows)
    kept = ngram_join.keep_one(docs_frame(spark, [(None, a), (None, b)]), stored)
    assert sorted(r.text for r in kept.collect()) == sorted([a, b])


def test_many_rows_without_ids(spark, stored):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abcdefghijklmnop") * 3 + str(rnd.randint(0, 99)) for _ in range(60)) for _ in range(60)]
    rows = [(None, t) for t in texts] * 3 + [(None, t + " one more word") for t in texts[:20]] + [(7, texts[0])]
    docs = docs_frame(spark, rows)
    assert out(ngram_join.near_duplicates(docs, stored), "doc_id", "n_shingles", "component_id") == brute.near_duplicates(rows)
    assert out(substring_fm.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.word_windows(rows)
    nodes = stored(suffix_dedup.keyed(docs).mapInArrow(ngram_join._nodes, "doc_id long, oid long, tie long, node long, n long"), "nodes")
    lists, sets = ngram_join.short_lists(docs, nodes, stored)
    assert sets.count() == 40  # the 20 texts with a longer version, and those: only they share short lists


def test_doubled_patterns_hash_apart(spark, stored):
    """Thue-Morse words over a and b and their complements: equal modulo 2^64 under any odd base."""
    word = "".join("ab"[bin(k).count("1") & 1] for k in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    assert line_rules.line_quality(docs_frame(spark, [(1, f"{word}\n{other}")])).first()["n_dup_lines"] == 0
    rows = [(1, word), (2, other), (3, word)]
    assert out(ngram_join.near_duplicates(docs_frame(spark, rows), stored), "component_id") == [(1,), (1,), (2,)]
    around = " ".join(f"word{k}" for k in range(34))
    rows = [(1, f"{around} {word}"), (2, f"{around} {other}")]
    assert out(substring_fm.remove_repeats(docs_frame(spark, rows)), "doc_id", "n_removed") == [(1, 0), (2, 0)]
    assert out(suffix_dedup.remove_repeats(docs_frame(spark, [(1, word), (2, other)])), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffix_dedup([(1, word), (2, other)])


def test_range_hash_against_whole_numbers():
    values = textops.mix(np.arange(1, 40_001, dtype=np.uint64))
    hashes, prime = textops.RangeHash(values), textops._PRIME
    for start, end in ((0, 0), (0, 7), (16_380, 16_390), (39_900, 40_000), (9, 30_009)):
        mine = values[start:end].tolist()
        low = sum((v & prime) * pow(textops._BASES[0], -k, prime) for k, v in enumerate(mine)) % prime
        high = sum((v >> 33) * pow(textops._BASES[1], -k, prime) for k, v in enumerate(mine)) % prime
        whole = (low | high << 32) + len(mine) * 0xD6E8FEB86659FD93
        assert hashes(np.array([start]), np.array([end]))[0] == textops.mix(np.array([whole % (1 << 64)], np.uint64))[0]


@pytest.mark.parametrize("same", [True, False])
def test_contracted_links_are_a_spanning_forest(same):
    rnd = random.Random(9)
    base = [rnd.sample(range(1 << 30), 100) for _ in range(4)]
    sets = []
    for k in range(120):
        mine = list(base[k % 4])
        for _ in range(rnd.randint(0, 9)):
            mine[rnd.randrange(100)] = rnd.randrange(1 << 30)
        sets.append(np.unique(np.array(mine, np.uint64)))
    label = np.arange(len(sets)) // 3 * 3  # some are joined already
    index, ask = (sets, sets) if same else (sets[:70], sets[70:])
    index_label, ask_label = (label, label) if same else (label[:70], label[70:])
    first = 0 if same else 70

    def groups(pairs):
        root = label.copy()
        for a, b in pairs:
            root[root == root[b + first]] = root[a]
        return {tuple(np.flatnonzero(root == r)) for r in set(root.tolist())}

    every = ngram_join.divide_skip(index, index_label, ask, ask_label, same)
    forest = [p for a, b in ngram_join.divide_skip_parts(index, index_label, ask, ask_label, same, True) for p in zip(a.tolist(), b.tolist(), strict=True)]
    assert groups(forest) == groups(every) and len(forest) == len(set(label.tolist())) - len(groups(every)) < len(every)
