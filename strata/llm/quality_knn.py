"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Texts become tf-idf vectors over hashed byte trigrams plus a few structural
terms (words equal to the one before, words in repeated runs, capitals).
Inverse document frequencies come from all documents.  A truncated SVD of a
bounded, balanced sample of labelled documents gives the latent space; the
sample's unit vectors are broadcast (``sum(PER_CLASS) * RANK`` floats), and
every document is compared with all of them in exact blocked cosine products.
Its ``NEIGHBOURS`` nearest vote with weights that grow with similarity.

Defined results: null, empty and wordless texts score 0; equal texts score
alike; ties among neighbours change no vote by more than rounding; an empty
table gives no rows; without labels of both classes every score is 0.5 (0 for
wordless texts).  Extra columns are ignored; labels, lang, source and id are
never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import fold, sample
from strata.llm.textops import SPACE, Words, word_chunks

#: Bound of the fit: at most this many labelled documents of class 0 and class 1.
PER_CLASS = (1500, 1500)
BUCKETS = 2048
RANK = 64
NEIGHBOURS = 25
#: Votes weigh similarity to this power.
SHARPNESS = 4
STRUCTURAL = 4
TERMS = BUCKETS + STRUCTURAL
FOLDS, HELD_OUT = 3, 1
BLOCK_DOCS = 1024


def term_shares(words: Words) -> np.ndarray:
    """Square roots of each document's term shares, one row per document."""
    data, offsets = words.data.astype(np.uint32), words.offsets
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), np.float32)
    size = np.diff(offsets)
    if len(data) > 2:
        code = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
        bucket = (code >> np.uint32(16)) % np.uint32(BUCKETS)
        doc = np.repeat(np.arange(n), size)
        inside = doc[:-2] == doc[2:]
        counts = np.bincount(doc[:-2][inside] * BUCKETS + bucket[inside], minlength=n * BUCKETS).reshape(n, BUCKETS)
        out[:, :BUCKETS] = np.sqrt(counts / np.maximum(size - 2, 1)[:, None])
    if len(words):
        per_doc = np.maximum(np.diff(words.first), 1)

        def share(flags: np.ndarray, doc: np.ndarray) -> np.ndarray:
            return np.bincount(doc, flags, minlength=n) / per_doc

        same = np.zeros(len(words), bool)
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
        out[:, BUCKETS] = np.sqrt(share(same, words.doc))
        at, run = words.windows(4)
        _, first = np.unique(run ^ (words.doc[at].astype(np.uint64) << np.uint64(40)), return_index=True)
        again = np.ones(len(at), bool)
        again[first] = False
        out[:, BUCKETS + 1] = np.sqrt(share(again, words.doc[at]))
        head = words.data[words.start]
        capital = ((head >= 65) & (head <= 90)) | (head == 0xC3)
        out[:, BUCKETS + 2] = np.sqrt(share(capital, words.doc))
        mark = words.data[words.end - 1]
        out[:, BUCKETS + 3] = np.sqrt(share((mark < 128) & ~SPACE[mark] & ~np.isin(mark, list(b".,")) & ((mark | 32) - 97 > 25), words.doc))
    return out


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        for i, j, words in word_chunks(batch.column(0)):
            total += np.count_nonzero(term_shares(words), axis=0)
            rows += j - i
    yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(TERMS), -1)), pa.array(np.append(total, rows))], ["term", "df"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in word_chunks(batch.column(1)):
            rows = [v.tobytes() for v in term_shares(words)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(rows, pa.binary()), batch.column(2).slice(i, j - i)], ["doc_id", "vector", "y"])


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    known: np.ndarray
    votes: np.ndarray

    def latent(self, shares: np.ndarray) -> np.ndarray:
        z = (shares * self.idf) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, shares: np.ndarray) -> np.ndarray:
        if len(np.unique(self.votes)) < 2:
            return np.full(len(shares), 0.5)
        similar = self.latent(shares) @ self.known.T
        k = min(NEIGHBOURS, similar.shape[1])
        near = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(similar, near, axis=1), 0) ** SHARPNESS + 1e-9
        return (weight * self.votes[near]).sum(axis=1) / weight.sum(axis=1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: tuple[int, int] = PER_CLASS) -> Model:
    counts = docs.select("text").mapInArrow(_document_frequency, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r.term: r.df for r in counts.collect()}  # TERMS + 1 rows
    total = max(df.get(-1, 0), 1)
    idf = np.array([np.log((1 + total) / (1 + df.get(t, 0))) + 1 for t in range(TERMS)], np.float32)
    train = sample(docs, labels, label, fold(F.col("doc_id"), FOLDS) == HELD_OUT, per_class)
    rows = sorted(train.mapInArrow(_vectors, "doc_id long, vector binary, y int").collect())
    if not rows:
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    x = np.stack([np.frombuffer(r.vector, np.float32) for r in rows]) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = np.ascontiguousarray(axes[:, ::-1][:, :RANK]).astype(np.float32)
    z = x @ axes
    return Model(idf, axes, z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9), np.array([r.y for r in rows], float))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for i, j, words in word_chunks(batch.column(1)):
                shares = term_shares(words)
                score = np.concatenate([model.score(shares[k : k + BLOCK_DOCS]) for k in range(0, len(shares), BLOCK_DOCS)])
                score[np.diff(words.first) == 0] = 0.0
                score = np.round(np.clip(score, 0, 1), 6)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
