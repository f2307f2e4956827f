"""N-gram join, line rules, mixing, token counts, licenses and decontamination."""

import random
import textwrap

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import duck, frame_digest
from helpers import SF, docs_frame, out, stored  # noqa: F401

from strata.llm import decontaminate, licenses, line_rules, mixing, ngram_join, token_counts
from strata.llm.oracle import ORACLE_SQL
from strata.llm.queries import QUERIES


def near_copies(seed):
    rnd = random.Random(seed)
    vocabulary, rows = [f"w{i}" for i in range(300)], []
    for _ in range(40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 4, 5, 6, 8, 12, 25, 60, 150]))]
        for _ in range(rnd.choice([1, 1, 2, 5, 30])):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(w + [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 2))])))
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    rows += [(1000 + k, " ".join(passage + [rnd.choice(vocabulary) for _ in range(rnd.randint(3, 30))])) for k in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (None, rows[0][1]), (None, "zz yy"), (5, rows[9][1]), (2003, rows[4][1].upper()), (2003, rows[4][1].upper())]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("dense", [32, 2])
def test_near_duplicates(spark, stored, monkeypatch, dense):
    monkeypatch.setattr(ngram_join, "DENSE", dense)
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", 500)
    rows = near_copies(3)
    got = ngram_join.near_duplicates(docs_frame(spark, rows, extra=True), stored)
    assert out(got, "doc_id", "n_shingles", "component_id") == brute.near_duplicates(rows)


@pytest.mark.parametrize("dense", [32, 2])
def test_links_are_all_counted(spark, stored, monkeypatch, dense):
    monkeypatch.setattr(ngram_join, "DENSE", dense)
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", 500)
    monkeypatch.setattr(ngram_join, "PART_PAIRS", 7)
    rows = near_copies(5)
    base = [f"v{k}" for k in range(200)]
    rows += [(3000 + k, " ".join([*base, f"only{k}"])) for k in range(60)]  # all link with each other
    sets = {s for s in (brute.shingles(t) for _, t in rows) if s}
    links = {s: sum(100 * len(s & o) >= 80 * len(s | o) for o in sets if o != s) for s in sets}
    got = ngram_join.near_duplicates(docs_frame(spark, rows, extra=True), stored).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.n_links) for r in got) == sorted((str(d), len(s), links.get(s, 0)) for d, s in ((d, brute.shingles(t)) for d, t in rows))
    assert {r.component_links for r in got if r.doc_id is not None and r.doc_id >= 3000} == {60 * 59 // 2}
    assert all(r.n_links <= r.component_links for r in got)


def test_meetings_count_once_a_pair():
    """Pairs that meet in ``SHARED`` sparse lists are candidates, whatever third documents stand in the lists."""
    rnd = random.Random(11)
    for _ in range(200):
        lists = [rnd.sample(range(12), rnd.randint(2, 6)) for _ in range(14)] + [[4, 7], [4, 7], [1, 4, 7]]
        kin = [k if k in (1, 4, 7) else rnd.choice([k, 0]) for k in range(12)]
        flat = [(t, k) for t, held in enumerate(lists) for k in sorted(held)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in flat]), pa.array([k for _, k in flat]), pa.array([100] * len(flat), pa.int32()), pa.array([kin[k] for _, k in flat])], ["token", "node", "n", "label"]
        )
        asked = pa.Table.from_batches(ngram_join._lists_by_node([batch])).sort_by("query")
        got = {tuple(sorted((a, b))) for part in ngram_join._merge(asked.to_batches()) for a, b in zip(part["a"].to_pylist(), part["b"].to_pylist(), strict=True)}
        met = {(a, b): sum(a in held and b in held for held in lists) for a in range(12) for b in range(a + 1, 12) if kin[a] != kin[b]}
        assert got == {pair for pair, times in met.items() if times >= ngram_join.SHARED}


def test_keep_one_of_each_group(spark, stored):
    rows = [(3, "a b c d e f g"), (1, "A B C D E F G"), (1, "A B C D E F G"), (2, "p q r s t"), (4, None)]
    df = docs_frame(spark, rows, extra=True)
    kept = ngram_join.keep_one(df, stored)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert ngram_join.near_duplicates(docs_frame(spark, []), stored).collect() == []


def test_divide_skip_against_all_pairs():
    rnd = np.random.default_rng(4)
    base = np.unique(rnd.integers(0, 1 << 60, 80).astype(np.uint64))
    sets = [np.unique(np.concatenate([rnd.choice(base, rnd.integers(40, len(base)), replace=False), rnd.integers(0, 1 << 60, rnd.integers(0, 12)).astype(np.uint64)])) for _ in range(60)]
    label = np.arange(60)
    got = {tuple(sorted(p)) for p in ngram_join.divide_skip(sets, label, sets, label, True)}
    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert got == want and want


def test_line_rules_counts_and_verdict(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    good = "One plain sentence stands here in the text.\n" + "\n".join(f"Another{k} sentence{k} has its{k} own words{k} here{k}." for k in range(6))
    odd = [(900001, None), (900002, ""), (900003, "\x85\xa0 a\x1cb\n\n x"), (900004, good), (900005, good + "\nHome | About | Contact\nCookie policy applies here."), (900006, "\n".join(f"Home{k} | About | Contact" for k in range(20)))]
    got = {r.doc_id: r for r in line_rules.line_quality(docs_frame(spark, docs + odd, extra=True), with_text=True).collect()}
    for doc, text in docs + odd:
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(text), doc
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert got[900004].kept and got[900004].cleaned_text == good
    assert got[900005].kept and "Home" not in got[900005].cleaned_text and "Cookie" not in got[900005].cleaned_text
    assert not got[900006].kept and not got[900001].kept
    kept = line_rules.keep_quality(docs_frame(spark, docs + odd, extra=True))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, r in got.items() if r.kept)


def test_mixing_edge_rows(spark, stored):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "q " * 50, None), (None, "w w", "y"), (4, "", "z"), (5, "d e f g", "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as key", "3 as target")
    got = mixing.documents_mix(spark, df, stored)
    con = duckdb.connect()
    documents = df.select("doc_id", "text", "source").toArrow()  # noqa: F841  read by name below
    cur = con.execute(ORACLE_SQL["op10_mixing"])
    assert frame_digest(got.columns, [tuple(r) for r in got.collect()]) == frame_digest([d[0] for d in cur.description], cur.fetchall())
    per = {}
    for r in got.collect():
        assert 0 <= r.taken <= 3 * r.size
        per.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(taken - target) < 1 for taken, target in per.values())
    assert mixing.documents_mix(spark, df.limit(0), stored).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_twins(spark, name):
    df = QUERIES[name](spark, SF)
    cols, rows = duck(SF, ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(cols)
    assert frame_digest(df.columns, [tuple(r) for r in df.collect()]) == frame_digest(cols, rows)


def test_license_segments(spark):
    rows = [(1, "Some text. Licensed under CC BY-NC 4.0. More text follows here."), (2, "RELEASED under the (MIT) license"), (3, None), (4, "license"), (2, "Released under the MIT License."), (5, "We like the music and the license plate of a car.")]
    assert out(licenses.scan(docs_frame(spark, rows, extra=True)), "doc_id", "license", "n_segments") == [(1, "CC-BY-NC-4.0", 1), (2, "MIT", 1), (2, "MIT", 1)]
    assert licenses.scan(docs_frame(spark, [])).collect() == []


def test_wrapped_notices_and_whole_licenses(spark):
    texts = dict(licenses.WHOLE_TEXTS[-10:])
    header = licenses.WHOLE_TEXTS[1][1]
    assert header.startswith("This program is free software: you") and set(texts) >= {"MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0"}
    wrapped = lambda text, width: "\n".join(f" * {line}" for line in textwrap.wrap(text, width))
    rows = [
        (1, "Words before.\nThis work is licensed under the GNU General\nPublic License, version 3.\nWords after."),
        (2, "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + texts["MIT"]),
        (3, "Copyright (c) 2020, Some Body\nAll rights reserved.\n\n" + texts["BSD-3-Clause"]),
        (4, "Copyright 2020\n" + wrapped(texts["BSD-2-Clause"], 50)),
        (5, texts["Apache-2.0"]),
        (6, "/*\n" + wrapped(header, 60) + "\n */\nint main() { return 0; }\n"),
        (7, texts["GPL-3.0"]),
        (8, "This work is licensed under the GNU General Public License,\nversion 3."),
        (9, "Released under the\nMIT License.\n\nSome other words stand here.\n\nLicensed under\nCC BY 4.0."),
        (10, " ".join(texts["MIT"].split())),
        (11, "The license of the software is the permission that the author of the work gives to any person.\n" * 30),
    ]
    got = {}
    for r in licenses.scan(docs_frame(spark, rows, extra=True)).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.dice, r.n_segments)
    want = {1: "GPL-3.0", 2: "MIT", 3: "BSD-3-Clause", 4: "BSD-2-Clause", 5: "Apache-2.0", 6: "GPL-3.0", 7: "GPL-3.0", 8: "GPL-3.0", 10: "MIT"}
    assert {d: list(found) for d, found in got.items() if d != 9} == {d: [name] for d, name in want.items()}
    assert all(dice >= 0.95 and n == 1 for d in want for dice, n in got[d].values()), got
    assert got[9] == {"MIT": (1.0, 1), "CC-BY-4.0": (1.0, 1)}


def test_token_counts_round_trip(spark, stored):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(token_counts.VOCABULARY, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(7, None), (8, ""), (8, ""), (9, "<|endoftext|> is text"), (10, "long " * 5000), (None, "x")]
    for block in (1 << 16, 100):  # documents inside blocks, and over many of them
        files = stored(token_counts.encode_documents(docs_frame(spark, rows, extra=True), block_tokens=block), "files")
        counts = token_counts.separator_scan(files.filter("block is not null"), block_tokens=block)
        names = {(r.file, r.ordinal + k): d for r in files.filter("block is null").collect() for k, d in enumerate(r.doc_ids)}
        got = sorted(((names[r.file, r.ordinal], r.n_tokens) for r in counts.collect()), key=str)
        assert got == sorted(((d, len(encoding.encode_ordinary(t or ""))) for d, t in rows), key=str)
    assert out(token_counts.token_counts(stored(token_counts.encode_documents(docs_frame(spark, rows)), "files")), "doc_id", "n_tokens") == got
    streams = {}
    for r in files.filter("block is not null").orderBy("file", "block").collect():
        streams.setdefault(r.file, []).extend(np.frombuffer(r.tokens, token_counts.TOKEN).tolist())
    texts = [encoding.decode(part) for s in streams.values() for part in _split(s, token_counts.END_OF_DOCUMENT)]
    assert sorted(texts) == sorted(t or "" for _, t in rows)


def _split(stream, end):
    part = []
    for token in stream:
        if token == end:
            yield part
            part = []
        else:
            part.append(token)


def test_wand_finds_what_exhaustive_scoring_finds():
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(150)]
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 25)))) for k in range(30)]
    bags = [decontaminate._words(t) for _, t in items]
    df = {}
    for bag in bags:
        for t in set(bag.tolist()):
            df[t] = df.get(t, 0) + 1
    index = decontaminate.Index(items, {t: float(np.log(1 + (30 - c + 0.5) / (c + 0.5))) for t, c in df.items()}, float(np.mean([len(b) for b in bags])))
    for _ in range(60):
        query = rnd.choice(items)[1].split()
        rnd.shuffle(query)
        query = query[: rnd.randint(3, len(query))] + [rnd.choice(vocabulary) for _ in range(10)]
        terms = sorted({int(np.searchsorted(index.terms, h)) for h in decontaminate._words(" ".join(query)) if h in index.terms})
        scores = {}
        for t in terms:
            for entry in range(index.of_term[t], index.of_term[t + 1]):
                for item, x in index.postings(entry):
                    scores[item] = scores.get(item, 0.0) + x
        want = {k for k, s in scores.items() if s >= decontaminate.THRESHOLD}
        got = {k for block in range(index.blocks) for k, _ in index.search(terms, block)}
        assert got == want
        bounded = {block for _, _, block in index.candidates(np.zeros(len(terms), np.int64), np.array(terms))}
        assert {k // decontaminate.BLOCK_ITEMS for k in want} <= bounded


def test_leaks_and_clean_documents(spark):
    rnd = random.Random(10)
    text = lambda k: " ".join(f"t{rnd.randrange(5000)}" for _ in range(k))
    items = [(k, f"{text(12)}?\n{text(4)}.") for k in range(20)] + [(50, None), (51, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, f"{text(200)} {items[k][1] if k < 10 else text(16)} {text(rnd.randint(0, 300))}") for k in range(20)]
    rows += [(100, None), (101, ""), (102, items[3][1].split("\n")[0]), (103, items[4][1].upper().replace("\n", " ")), (5, rows[5][1])]
    docs = docs_frame(spark, rows, extra=True)
    got = out(decontaminate.find_leaks(docs, bench), "doc_id", "item_id")
    assert got == sorted([(k, k) for k in range(10)] + [(103, 4), (5, 5)], key=str)
    leaked = {d for d, _ in got}
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()) == sorted(d for d, _ in rows if d not in leaked)
    assert decontaminate.find_leaks(docs, bench.limit(0)).collect() == [] and decontaminate.find_leaks(docs.limit(0), bench).collect() == []


def test_benchmark_in_slices(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = out(decontaminate.find_leaks(docs, bench), "doc_id", "item_id", "score")
    monkeypatch.setattr(decontaminate.index_slices, "__defaults__", (2000,))
    assert out(decontaminate.find_leaks(docs, bench), "doc_id", "item_id", "score") == whole and whole


@pytest.mark.parametrize("bounds", [decontaminate.BOUNDS, 1])
def test_a_long_item_changes_no_other_verdict(spark, monkeypatch, bounds):
    rnd = random.Random(11)
    text = lambda k, of=5000: " ".join(f"t{rnd.randrange(of)}" for _ in range(k))
    question, answer, long_item = text(12), "t77777", text(5000, 50_000)
    short = [(1, f"{question}?\n{answer}"), *((k, f"{text(12)}?\n{text(2)}") for k in range(2, 9))]
    rows = [(1, f"{text(50)} {question} {text(400)} {answer} {text(50)}"), (2, f"{text(30)} {short[3][1]}"), (3, f"{text(700)} {long_item} {text(9)}")]
    monkeypatch.setattr(decontaminate, "BOUNDS", bounds)
    index = lambda items: decontaminate.find_leaks(docs_frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert out(index(short), "doc_id", "item_id") == [(2, 4)]
    assert out(index([*short, (50, long_item)]), "doc_id", "item_id") == [(2, 4), (3, 50)]
