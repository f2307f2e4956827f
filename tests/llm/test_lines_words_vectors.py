"""Line index, spelling variants and whitening against plain versions."""

import random
from fractions import Fraction

import brute
import numpy as np
import pyarrow as pa
import pytest
from helpers import docs_frame, out, stored  # noqa: F401

from strata.llm import line_index, spelling, whitening

LINES = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
WORDS = ("word", "form", "root", "n", "n_near", "form_n")


# ------------------------------------------------------------------ lines
def line_rows(seed):
    rnd = random.Random(seed)
    common = [f"{chr(97 + k) * 3} a line that many documents hold, number {k}" for k in range(12)]
    edge = ["x" * 39, "x" * 40, "é" * 39, "é" * 40, "É" * 40]
    rows = []
    for i in range(120):
        lines = [rnd.choice(common) for _ in range(rnd.randint(0, 6))] + [f"own line {i} {rnd.random()} " + "z" * 30]
        lines += rnd.sample(edge, 2) + ["", "  "]
        lines = [rnd.choice(["", " ", "\t", "\r"]) + (x.upper() if rnd.random() < 0.3 else x) + rnd.choice(["", "\x0b\x0c", " "]) for x in lines]
        rnd.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, common[0] + "\n" + common[0]), (204, " " + common[1] + " ")]
    rows += [(205, rows[3][1]), (206, rows[3][1]), (None, common[2]), (None, common[2] + "\n" + common[3]), (50, common[4]), (50, common[4])]
    rows += [(300, "\n".join([common[5]] * 3000 + [f"{k} and so on and on and on and on and on" for k in range(3000)]))]
    return rows + [(400 + k, "only four documents hold this line of more than forty") for k in range(4)]


@pytest.mark.parametrize("heads", [line_index.HEADS, 4])
def test_lines(spark, stored, heads):
    rows = line_rows(1)
    got = line_index.drop_common_lines(docs_frame(spark, rows, extra=True), stored, heads=heads, with_text=True)
    assert out(got, *LINES) == brute.line_dedup(rows)
    assert all(brute.sha(r.kept_text.encode()) == r.kept_sha256 for r in got.collect())


def test_lines_of_null_ids_only(spark, stored):
    rows = [(None, "the same line of over forty code points, always")] * 9
    assert out(line_index.drop_common_lines(docs_frame(spark, rows), stored), *LINES) == brute.line_dedup(rows)


def test_lines_empty_table(spark, stored):
    assert line_index.drop_common_lines(docs_frame(spark, []), stored).collect() == []
    with pytest.raises(ValueError):
        line_index.drop_common_lines(docs_frame(spark, []), stored, min_docs=1)


@pytest.mark.parametrize("n", [0, 1, 63, 5000])
def test_perfect_hash_is_minimal_and_round_trips(n):
    rng = np.random.default_rng(n)
    h1, h2 = rng.integers(0, 1 << 63, (2, n)).astype(np.uint64)
    h1[: n // 2] = 7  # halves may repeat, keys do not
    counts, last = np.arange(n) + (1 << 33) * (np.arange(n) == 3), -np.arange(n)
    shard = line_index.LineShard.load(*line_index.LineShard.build(h1, h2, counts, last).arrays())
    assert sorted(shard.hashed.index(h1, h2).tolist()) == list(range(n))
    got, got_last = shard.probe(h1, h2)
    assert (got == np.minimum(counts, (1 << 32) - 1)).all() and (got_last == last).all()
    strangers = rng.integers(1 << 63, 1 << 64, (2, 1000), dtype=np.uint64)
    assert not shard.probe(*strangers)[0].any()


def test_common_keys_stay_out_of_the_shards(spark, stored):
    rows = [(k, "one line in every document of this whole table\n" + f"{k // 2} a line that two documents share among them") for k in range(60)]
    index = line_index.line_index(docs_frame(spark, rows), stored, heads=20)
    assert len(index.heads.last) == 1 and index.heads.counts[0] == 60
    held = sum(len(r.last) // 8 for r in index.shards.collect())
    assert held == 30


# ------------------------------------------------------------------ words
def word_rows(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(7, 14))) for _ in range(30)]
    base += ["aaaaaaaa", "aaaaaaaaa", "aaaaaaab", "baaaaaaa", "Straße", "ÀÉÎÖÿ×÷ß", "x" * 4000, "x" * 4001]

    def typo(w):
        at, c = rnd.randrange(len(w)), rnd.choice("abcdéÿ")
        return rnd.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]])

    rows = []
    for i in range(150):
        words = [rnd.choice(base[:12]) if rnd.random() < 0.6 else rnd.choice(base) for _ in range(60)]
        words = [typo(w) if rnd.random() < 0.15 else w for w in words]
        words = [w.upper() if rnd.random() < 0.1 else w for w in words]
        rows.append((i, rnd.choice([" ", "\n", "-", "ß1"]).join(words)))
    return rows + [(200, None), (201, ""), (None, "abcdefgh abcdefgh"), (7, rows[7][1]), (7, rows[7][1]), (None, "abcdefgi " * 30)]


@pytest.mark.parametrize("group", [spelling.GROUP, 1])
def test_words(spark, stored, group):
    rows = word_rows(2)
    assert out(spelling.group_variants(docs_frame(spark, rows, extra=True), stored, group=group), *WORDS) == brute.spelling(rows)


def test_a_chunk_of_many_words_is_cut(spark, stored):
    """A third of the words share a half: keys grow until groups are small; the links are those of brute force."""
    rnd = random.Random(3)
    tails = {"".join(rnd.choice("abcdef") for _ in range(8)) for _ in range(400)}
    rows = [(1, " ".join("prefixes" + t for t in sorted(tails))), (2, " ".join("prefixes" + t for t in sorted(tails)))]
    assert out(spelling.group_variants(docs_frame(spark, rows), stored, group=10), *WORDS) == brute.spelling(rows)


def test_chains_of_forms(spark, stored):
    rows = [(0, "wordword " * 4000 + "wordworda " * 400 + "wordwordab " * 40 + "wordwordabc " * 4)]
    found = {r.word: (r.form, r.root) for r in spelling.group_variants(docs_frame(spark, rows), stored).collect()}
    assert found["wordwordabc"] == ("wordwordab", "wordword") and found["wordword"] == (None, "wordword")
    assert spelling.group_variants(docs_frame(spark, []), stored).collect() == []


def test_no_table_of_words_is_broadcast(spark, stored):
    """Spark would by its estimate: the files are small, but an explosion makes eight rows of each word."""
    plans = []

    def planned(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    out = spelling.group_variants(docs_frame(spark, [(k, "alphabet alphabex beautiful beautifus") for k in range(40)]), planned, group=1)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


# ---------------------------------------------------------------- vectors
def plain_whitening(vectors, d):
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] + [1_000_000] * (d - len(v)) for v in vectors]
    n = len(x)
    s = [sum(row[i] for row in x) for i in range(d)]
    centred = [[n * row[i] - s[i] for i in range(d)] for row in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)])
    return n, s, centred, v


def vector_rows(seed, n=70, d=6):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(mixed)]
    bad = [(100, None), (101, [1.0, None] + [0.0] * 4), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (104, [float("-inf")] * 6)]
    return rows + [(None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (105, []), (106, [1.5, -2.0])], bad


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as n", "2 as component", "'x' as v", "3 as place")


def test_whitening(spark):
    good, bad = vector_rows(1)
    got = whitening.whiten(vectors_frame(spark, good + bad), components=5).collect()
    n, s, centred, v = plain_whitening([r[1] for r in good], 6)
    assert len(got) == 5 * n and {r.n for r in got} == {n}
    e, axes = np.linalg.eigh(v)
    ids = [r[0] for r in good]
    for c in range(5):
        mine = [r for r in got if r.component == c + 1]
        unit, value = axes[:, -1 - c], e[-1 - c]
        expect = sorted((str(i), sum(t * t for t in row), float(np.array(row) @ unit) / n / value**0.5) for i, row in zip(ids, centred, strict=True))
        found = sorted((str(r.vec_id), r.deviation, r.whitened) for r in mine)
        sign = np.sign(expect[0][2] * found[0][2])
        assert [f[:2] for f in found] == [x[:2] for x in expect]
        assert np.allclose(sorted(sign * f[2] for f in found), sorted(x[2] for x in expect), atol=1e-9)
        assert all(abs(r.explained - value / np.trace(v)) < 1e-12 and r.identity_error < 1e-9 for r in mine)


def test_polarisation_is_exact():
    rng = np.random.default_rng(5)
    x = rng.integers(-(1 << 40), 1 << 40, (50, 4)) + 1_000_000
    n, sums = len(x), [int(c) for c in x.astype(object).sum(0)]
    centre = np.array([s // n for s in sums])
    v = whitening.covariance(n, sums, whitening.pair_sums(x - centre))
    centred = n * x.astype(object) - np.array(sums, object)
    expect = [[float(Fraction(int((centred[:, i] * centred[:, j]).sum()), n**3)) for j in range(4)] for i in range(4)]
    assert (v == np.array(expect)).all()


def test_whitening_without_variance(spark):
    same = [(k, [1.0, 2.0, 3.0]) for k in range(4)]
    got = whitening.whiten(vectors_frame(spark, same)).collect()
    assert len(got) == 12 and {(r.whitened, r.deviation, r.explained, r.identity_error) for r in got} == {(None, 0, 0.0, 0.0)}
    part = [(k, [float(k), 2.0]) for k in range(5)]  # one dimension varies
    got = whitening.whiten(vectors_frame(spark, part)).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in got)
    assert whitening.whiten(vectors_frame(spark, [])).collect() == []
    assert whitening.whiten(vectors_frame(spark, [(1, None), (2, [])])).collect() == []


def test_whitening_of_extreme_values(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 2.0])]
    got = whitening.whiten(vectors_frame(spark, rows)).collect()
    assert len(got) == 6 and all(r.deviation is None and int(r.deviation_exact) > 1 << 63 for r in got if r.vec_id == 0)


def test_blocks_of_sliced_vectors():
    column = pa.array([[1.0], [2.0, 3.0], [], [4.0, 5.0]], pa.list_(pa.float64())).slice(1)
    ((at, x),) = whitening.integers(column, 2)
    assert at == 0 and (x - whitening.SHIFT).tolist() == [[128, 192], [0, 0], [256, 320]]
