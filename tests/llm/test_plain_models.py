"""Scores and verdicts against plain versions: cosines and votes, gapped kernels, line rules."""

import re
from itertools import combinations

import brute
import numpy as np
from helpers import SF, docs_frame
from pyspark.sql import functions as F
from test_models_pipeline import by_sentence, toxic_examples

from strata.llm import line_rules, quality_knn, toxicity
from strata.llm.labelled import fold, sample

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def plain_shares(text):
    data = (text or "").encode()
    out = [0.0] * quality_knn.TERMS
    for a, b, c in zip(data, data[1:], data[2:]):  # noqa: B905
        code = (a * 0x9E3779B1 ^ b * 0x85EBCA6B ^ c * 0xC2B2AE35) % 2**32 * 0x27D4EB2F % 2**32
        out[(code >> 16) % quality_knn.BUCKETS] += 1 / max(len(data) - 2, 1)
    words = WORD.findall(data)
    seen = set()
    for k, word in enumerate(words):
        again = tuple(words[k : k + 4])
        last = word[-1]
        flags = (
            k > 0 and words[k - 1] == word,
            len(again) == 4 and again in seen,
            65 <= word[0] <= 90 or word[0] == 0xC3,
            last < 128 and last not in b".," and not chr(last).isalpha(),
        )
        if len(again) == 4:
            seen.add(again)
        for n, flag in enumerate(flags):
            out[quality_knn.BUCKETS + n] += flag / len(words)
    return np.sqrt(out)


def test_quality_votes_against_plain_cosines(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_knn.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    shares = {d: plain_shares(t) for d, t in texts.items()}
    df = np.sum([s > 0 for s in shares.values()], axis=0)
    idf = np.log((1 + len(texts)) / (1 + df)) + 1
    np.testing.assert_allclose(model.idf, idf, rtol=1e-5)

    train = sorted((r.doc_id, r.y) for r in sample(docs, labels, "quality", fold(F.col("doc_id"), 3) == 1, quality_knn.PER_CLASS).collect())
    x = np.stack([shares[d] * idf for d, _ in train])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    axes = model.axes.astype(float)
    np.testing.assert_allclose(axes.T @ axes, np.eye(axes.shape[1]), atol=1e-4)
    values = np.linalg.eigvalsh(x @ x.T)[::-1][: axes.shape[1]]  # as large as the scatter's own
    np.testing.assert_allclose(np.diag(axes.T @ x.T @ x @ axes)[: len(values)], values, atol=1e-3)

    def unit(v):
        return v / max(np.linalg.norm(v), 1e-9)

    known = [(unit(row @ axes), y) for row, (_, y) in zip(x, train, strict=True)]
    for r in quality_knn.score_quality(docs, model).collect():
        if not (texts[r.doc_id] or "").split():
            assert r.score == 0
            continue
        mine = unit((shares[r.doc_id] * idf) @ axes)
        near = sorted(((float(mine @ v), y) for v, y in known), reverse=True)
        edge = near[min(quality_knn.NEIGHBOURS, len(near)) - 1][0]
        sure = [(s, y) for s, y in near if s > edge + 1e-5]
        tied = [(s, y) for s, y in near if abs(s - edge) <= 1e-5]
        left = min(quality_knn.NEIGHBOURS, len(near)) - len(sure)

        def vote(chosen):
            weight = [max(s, 0) ** quality_knn.SHARPNESS + 1e-9 for s, _ in chosen]
            return sum(w * y for w, (_, y) in zip(weight, chosen, strict=True)) / sum(weight)

        low, high = (vote(sure + sorted(tied, key=lambda t: t[1] * sign)[:left]) for sign in (1, -1))  # ties may go either way
        assert low - 1e-3 <= r.score <= high + 1e-3, r.doc_id


def plain_kernel(a, b):
    def triples(word):
        word = f"^{word.strip(toxicity._EDGE)}$"
        places = list(combinations(range(len(word)), 3))
        norm = sum(toxicity.DECAY ** (2 * (k - i - 2)) for i, _, k in places) ** 0.5
        out = {}
        for i, j, k in places:
            key = word[i] + word[j] + word[k]
            out[key] = out.get(key, 0.0) + toxicity.DECAY ** (k - i - 2) / norm
        return out

    one, two = triples(a), triples(b)
    return sum(w * two[t] for t, w in one.items() if t in two)


def test_kernel_and_margins_against_plain_sums():
    rnd = np.random.default_rng(4)
    word = lambda: "".join(rnd.choice(list("abcdeéßx"), rnd.integers(2, 12)))
    landmarks, words = [word() for _ in range(9)], [word() for _ in range(60)] + ["zzz", "a-b.c", "idiot"]
    kernel = toxicity.Kernel(landmarks)
    want = np.array([[plain_kernel(w, m) for m in landmarks] for w in words])
    np.testing.assert_allclose(kernel.values(words), want, atol=1e-5)
    weights = rnd.normal(size=len(landmarks))
    model = kernel.model(weights, 0.25, landmarks)
    np.testing.assert_allclose(model.margins(words), want @ weights + 0.25, atol=1e-4)
    wide = toxicity.Kernel([*landmarks, *("".join(map(chr, range(k, k + 9))) for k in range(0x4E00, 0x4F00, 9)), "\U0001f600\U0001f601x"])
    assert wide.row.dense is None  # the same values by search, and characters of any plane
    np.testing.assert_allclose(wide.values(words)[:, : len(landmarks)], want, atol=1e-5)
    emoji = "\U0001f600\U0001f601x"
    np.testing.assert_allclose(wide.values([emoji])[0, -1], plain_kernel(emoji, emoji), atol=1e-5)


def test_toxic_scores_against_plain_maxima(spark):
    model = toxicity.train(by_sentence(toxic_examples(300, 3)))
    rows = [(k, t) for k, (t, _) in enumerate(toxic_examples(60, 5))] + [(90, "m o r o n"), (91, " "), (92, None), (93, "an (id iot) here"), (94, "an id. Iot")]
    size = model.alphabet.size
    chars = {n: chr(c) for c, n in enumerate(model.alphabet.table.tolist()) if n}
    joint = {chars.get(c // size**2, "") + chars.get(c // size % size, "") + chars.get(c % size, "") for c in model.joint.used.tolist()}

    def strings(text):
        words = text.lower().split()
        yield from ((w, 0.0) for w in words)
        yield from ((re.sub(r"[ .*_-]", "", run), 0.0) for run in toxicity._SPELLED.findall(text.lower()))
        for a, b in zip(words, words[1:]):  # noqa: B905
            end, a, b = a[-1] in ".!?", a.strip(toxicity._EDGE), b.strip(toxicity._EDGE)
            if not end and a and b and f"^{a}"[-2:] + b[0] in joint and a[-1] + f"{b}$"[:2] in joint:
                yield a + b, model.across

    scored = toxicity.score_toxicity(docs_frame(spark, rows, extra=True), model).collect()
    for r, (_, text) in zip(sorted(scored), rows, strict=True):
        want = max((float(model.probability(model.margins([t]) - less)[0]) for t, less in strings(text or "")), default=0.0)
        assert abs(r.score - want) < 1e-5 and r.predicted == (r.score >= 0.5)


def plain_verdict(text):
    """``(kept, lost share, cleaned text)`` by one loop over the lines."""
    text = text or ""
    ends = tuple(line_rules.END_ASCII.decode()) + line_rules.END_UTF8
    n_words, word_chars, _, _, n_repeat = brute.base_counts(text)
    lost, passed = 0, []
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        if not words:
            continue
        chars = sum(map(len, words))
        bangs = line.count("!")
        failed = (
            not words[-1].endswith(ends)
            or line.count("|") + line.count(">") >= line_rules.NAV_SEPARATORS
            or sum(map(line.count, "#*$%&|<>")) > line_rules.MAX_SYMBOL_SHARE * chars
            or (bangs > 1 and bangs > line_rules.MAX_BANG_PER_WORD * len(words))
            or any(p in line.encode().lower() for p in line_rules.BOILERPLATE)
        )
        if failed:
            lost += chars
        else:
            passed.append(line)
    share = lost / word_chars if word_chars else 1.0
    base_failed = n_words < 20 or 100 * n_repeat > 30 * n_words
    return not base_failed and share <= line_rules.MAX_LOST, share, "".join(passed)


def test_line_verdicts_against_a_plain_loop(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    long_line = " ".join(f"word{k}" for k in range(40))
    odd = ["", None, "\n\n", long_line, long_line + "…", long_line + " 终于。", f"{long_line}.\nHi!! no!!\n a | b > c.", f"{long_line}?\nSkip to\ncontent.\nSKIP TO CONTENT now.\n#1 $5."]
    rows += [(700_000 + k, t) for k, t in enumerate(odd)]
    got = {r.doc_id: r for r in line_rules.line_quality(docs_frame(spark, rows), with_text=True).collect()}
    for doc, text in rows:
        kept, share, cleaned = plain_verdict(text)
        assert (got[doc].kept, got[doc].cleaned_text) == (kept, cleaned), doc
        assert abs(got[doc].lost_share - share) < 1e-9, doc
