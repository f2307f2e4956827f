"""Classifiers by held-out accuracy; the pipeline against the plain versions of its stages."""

import re

import brute
import numpy as np
import pytest
from helpers import SF, docs_frame, out, stored  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import line_rules, mixing, quality_knn, toxicity
from strata.llm.labelled import fold, sample

LARGER = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_knn.score_quality(docs, quality_knn.fit(docs, labels)).join(labels, "doc_id").filter("held_out")
    rows = scored.collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def toxic_examples(n, seed):
    rnd = np.random.default_rng(seed)
    plain = ["".join(rnd.choice(list("abdeginorst"), rnd.integers(2, 9))) for _ in range(400)]
    bad = ["idiot", "moron", "stupid", "scumbag"]
    out = []
    for k in range(n):
        w = list(rnd.choice(plain, 60))
        if k % 3 == 0:
            for _ in range(2):
                w[rnd.integers(60)] = bad[rnd.integers(4)]
        out.append((" ".join(w[:30]) + ". " + " ".join(w[30:]), int(k % 3 == 0)))
    return out


def by_sentence(examples):
    return [(re.split(r"(?<=[.!?])\s+", t), y) for t, y in examples]


def scoring(model):
    scorer = toxicity.Scorer(model)
    return lambda text: float(model.probability(scorer.margins([text]))[0])


def test_toxicity_held_out_and_disguised():
    model = toxicity.train(by_sentence(toxic_examples(600, 1)))
    score = scoring(model)

    test = toxic_examples(200, 2)
    assert np.mean([(score(t) >= 0.5) == y for t, y in toxic_examples(600, 1)]) >= 0.98
    assert np.mean([score(t) >= 0.5 for t, y in test if y]) >= 0.98
    for word in ("idiot", "id-iot", "stu*pid", "m o r o n", "scuumbag", "sstupid", "IDIOT!", "id iot", "mo ron", "scum bag"):
        assert score(f"you are a {word} here") >= 0.5, word
    for text in ("you are a friend here", "stop it", "an idea for a station", "he did. Iotas are small", "a bad id. Iot is a word"):
        assert score(text) < 0.5, text
    assert toxicity.train([(["a b c"], 0)]) is None
    assert toxicity.train([]) is None and toxicity.train([([""], 1), ([], 0)]) is None


def test_insults_of_two_harmless_words():
    rnd = np.random.default_rng(6)
    plain = ["".join(rnd.choice(list("abdeginorst"), rnd.integers(2, 9))) for _ in range(400)]
    examples = []
    for k in range(900):
        w = list(rnd.choice(plain, 40))
        if k % 3 == 0:
            w[7:9] = ["brain", "dead"]
        else:  # both words, never side by side
            w[3], w[30] = "brain", "dead"
        examples.append((" ".join(w), int(k % 3 == 0)))
    score = scoring(toxicity.train(by_sentence(examples)))
    assert score("you are brain dead today") >= 0.5
    for text in ("a brain is here", "the dead sea", "dead brain", "use your brain. Dead ends follow"):
        assert score(text) < 0.5, text


def test_training_sentences_are_bounded(spark):
    rows = [(1, "One here. Two! Three? four 3.5 e.g.x"), (2, "y" * 1200), (3, None), (4, " ".join(f"No {k}." for k in range(500)))]
    got = {r.doc_id: r.s for r in docs_frame(spark, rows).select("doc_id", toxicity.sentences(F.col("text")).alias("s")).collect()}
    assert got[1] == ["One here.", "Two!", "Three?", "four 3.5 e.g.x"]
    assert [len(s) for s in got[2]] == [512, 512, 176] and got[3] == [""]
    assert len(set(got[4])) == toxicity.SENTENCES and set(got[4]) <= {f"No {k}." for k in range(500)}
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)], "doc_id long, toxic int")
    many = docs_frame(spark, [(7, f"text {k}") for k in range(50)] + [(6, "a"), (6, "a"), (6, None)])
    kept = sample(many, labels, "toxic", F.lit(False), (5, 5)).collect()
    assert sorted(r.doc_id for r in kept) == [6, 7]  # an id trains once, however many rows it has


def test_scores_of_odd_rows(spark):
    docs = docs_frame(spark, [(1, None), (2, ""), (3, " \n"), (None, "plain words here"), (4, "idiot you are"), (4, "idiot you are"), (5, "x" * 30_000)], extra=True)
    labels = spark.createDataFrame([(1, None, None), (2, 0, 1), (2, 1, 1), (None, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    for module, fit, score in ((quality_knn, quality_knn.fit, quality_knn.score_quality), (toxicity, toxicity.fit, toxicity.score_toxicity)):
        rows = score(docs, fit(docs, labels)).collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
        assert all(r.score == 0 and r.predicted == 0 for r in rows if r.doc_id in (1, 2, 3))
        assert score(docs.limit(0), fit(docs.limit(0), labels)).collect() == []


def test_held_out_rows_never_train(spark):
    import zlib

    docs = docs_frame(spark, [(k, f"text {k}") for k in range(300)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, quality int")
    rows = sample(docs, labels, "quality", fold(F.col("doc_id"), 3) == 1, (50, 40)).collect()
    assert len(rows) == 90 and all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in rows)


def plain_pipeline(spark, sf):
    """The five stages without the operators' methods (the line verdict is the operator's own, tested elsewhere)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in line_rules.line_quality(docs).filter("kept").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in kept]
    groups = brute.near_duplicates([(d, t) for d, t, _ in rows])
    alone = {d for d, _, c in groups if d == c}
    rows = sorted(r for r in rows if r[0] in alone)
    seen, cut = set(), []
    for doc, text, source in rows:
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                gone[p : p + 100] = b"\1" * 100
            else:
                seen.add(s)
        cut.append((doc, bytes(c for c, g in zip(data, gone, strict=True) if not g).decode(errors="ignore"), source))
    items = [i.text for i in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    return [r for r in cut if not any(i in r[1] for i in items)]


def test_pipeline_against_plain_stages(spark, stored):
    rows = plain_pipeline(spark, SF)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cols = ("doc_id", "size", "source_size", "target", "taken")
    assert out(corpus_pipeline.run(spark, SF), *cols) == out(mixing.documents_mix(spark, frame, stored), *cols)


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_the_columns_of_documents(spark, k):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.selectExpr("*", "1 as oid", "2 as node", "3 as row", "4 as kept").limit(30)
    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, odd, SF).columns == odd.columns
    assert stage(spark, docs.limit(0), SF).collect() == []
