"""Document token counts from flat, unindexed token files.

A token file is one stream of little-endian 16-bit ids in which every document
is followed by an end-of-document id; nothing says where documents begin.  The
stream is held in blocks of ``BLOCK_TOKENS`` ids (a Parquet row each, so Spark
reads blocks in any task).  ``separator_scan`` finds the separators of each
block in one vectorised search and keeps the counts of documents that lie
inside; running sums and maxima over a file's blocks then stitch the documents
that cross block borders.

Defined results: null and empty texts are documents of 0 tokens; the
separator's own string inside a text is ordinary text and never separates;
repeated rows are separate documents; an empty table gives none; a stream
that does not end in a separator has its tail counted as a last document.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokenisation pattern published with this vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
END_OF_DOCUMENT = 50256
BLOCK_TOKENS = 1 << 16
TOKEN = np.dtype("<u2")

FILES = "file int, block int, tokens binary, ordinal long, doc_ids array<long>"


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows of token files, one file per input partition.

    ``block`` rows hold the stream; rows without a block list which document
    is which in the order of the file (the files themselves do not say).
    """
    with open(vocabulary, "rb") as f:  # bounded: a public vocabulary of about 1 MB
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.value.splitlines())}
        encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        file, block, ordinal = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        size = 0

        def rows(**columns):
            schema = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("tokens", pa.binary()), ("ordinal", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])
            return pa.RecordBatch.from_pylist([dict.fromkeys(schema.names) | {"file": file} | columns], schema)

        for batch in batches:
            yield rows(ordinal=ordinal, doc_ids=batch.column(0).to_pylist())
            ordinal += batch.num_rows
            for text in batch.column(1):
                held.append(np.array([*encode(text.as_py() or ""), end], TOKEN))
                size += len(held[-1])
                if size >= block_tokens:
                    stream = np.concatenate(held)
                    while len(stream) >= block_tokens:
                        yield rows(block=block, tokens=stream[:block_tokens].tobytes())
                        block, stream = block + 1, stream[block_tokens:]
                    held, size = [stream], len(stream)
        if size:
            yield rows(block=block, tokens=np.concatenate(held).tobytes())

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, FILES)


def separator_scan(blocks: DataFrame, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, block, tokens`` rows -> ``file, ordinal, n_tokens`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids = np.frombuffer(raw.as_buffer(), TOKEN)
                at = np.flatnonzero(ids == end) + block * block_tokens
                some = len(at) > 0
                out.append(
                    {
                        "file": file,
                        "block": block,
                        "first": int(at[0]) if some else None,
                        "last": int(at[-1]) if some else None,
                        "stop": block * block_tokens + len(ids),
                        "inner": (np.diff(at) - 1).tolist(),
                        "n": len(at),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("stop", pa.int64()), ("inner", pa.list_(pa.int64())), ("n", pa.int64())]))

    found = blocks.select("file", "block", "tokens").mapInArrow(run, "file int, block int, first long, last long, stop long, inner array<long>, n long")
    # prefix scan over a file's blocks: documents begun, and the last separator, before each block
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    stitched = found.select(
        "file",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"),
        F.coalesce(F.max("last").over(ahead), F.lit(-1)).alias("previous"),
        F.count("block").over(after).alias("blocks_after"),
        "first",
        "last",
        "stop",
        "inner",
        "n",
    )
    tail = F.col("stop") - 1 - F.coalesce("last", "previous")
    lengths = F.concat(
        F.when(F.col("n") > 0, F.array(F.col("first") - F.col("previous") - 1)).otherwise(F.array().cast("array<bigint>")),
        "inner",
        F.when((F.col("blocks_after") == 0) & (tail > 0), F.array(tail)).otherwise(F.array().cast("array<bigint>")),
    )
    return stitched.select("file", "base", F.posexplode(lengths).alias("place", "n_tokens")).select(
        "file", (F.col("base") + F.col("place")).alias("ordinal"), "n_tokens"
    )


def token_counts(files: DataFrame) -> DataFrame:
    """Stored token files -> ``doc_id, n_tokens`` of every document row."""
    names = files.filter(F.col("block").isNull()).select("file", "ordinal", F.posexplode("doc_ids").alias("place", "doc_id"))
    names = names.select("file", (F.col("ordinal") + F.col("place")).alias("ordinal"), "doc_id")
    counts = separator_scan(files.filter(F.col("block").isNotNull()))
    return names.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
