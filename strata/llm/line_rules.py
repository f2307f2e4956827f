"""Line-first quality rules.

Every line that holds a word is judged on its own: it must end in terminal
punctuation, must not look like navigation (separators between labels), must
not be boilerplate (fixed phrases), must not be dominated by symbols and must
not shout.  Failing lines are removed; a document is rejected when it loses
more than ``MAX_LOST`` of its word characters, or by the base rules (too few
words, too many words in repeated 8-word windows).

Defined results: null text is empty; a document without words has zero counts
and is rejected; rows are judged one by one, so repeated rows give repeated
results and an empty table gives none.  Only the named columns are read, so
extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.textops import RangeHash, Words, byte_values, cover, mix, word_chunks

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A document goes when the removed lines held more than this share of its word characters.
MAX_LOST = 0.4
MAX_SYMBOL_SHARE = 0.1
MAX_BANG_PER_WORD = 0.3
NAV_SEPARATORS = 2
SYMBOLS = b"#*$%&|<>"
BOILERPLATE = (
    b"all rights reserved",
    b"click here",
    b"cookie policy",
    b"javascript is disabled",
    b"lorem ipsum",
    b"privacy policy",
    b"sign up",
    b"skip to content",
    b"terms of use",
    b"use of cookies",
)
#: Last bytes of a line that ends a sentence: ASCII marks, and the UTF-8 of … ” » 。 ！ ？
END_ASCII = b".!?:;\"')]"
END_UTF8 = ("…", "”", "»", "。", "！", "？", "“", "’")

_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_END = np.isin(np.arange(256), list(END_ASCII))

METRICS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, lost_share double"


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeated(doc: np.ndarray, key: np.ndarray, first_too: bool) -> np.ndarray:
    """Which keys occur again in their document (or, without the first, occurred before)."""
    if not len(key):
        return np.zeros(0, bool)
    both = key ^ mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:]] = same
    if first_too:
        out[order[:-1]] |= same
    return out


class Chunk:
    """Counts and line verdicts of the documents in one chunk."""

    def __init__(self, words: Words):
        data, offsets = words.data, words.offsets
        n = len(offsets) - 1
        self.n_words = np.diff(words.first)
        point = _sums((data & 0xC0) != 0x80)
        word_points = point[words.end] - point[words.start]
        upto = _sums(word_points)
        self.word_chars = upto[words.first[1:]] - upto[words.first[:-1]]
        symbols = _sums(_SYMBOL[data])
        self.n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]

        # repeated windows
        at, key = words.windows(WINDOW)
        again = at[_repeated(words.doc[at], key, first_too=True)]
        in_repeat = _sums(cover(again, again + WINDOW, len(words)))
        self.n_repeat_words = in_repeat[words.first[1:]] - in_repeat[words.first[:-1]]

        # lines that hold a word: [line_start, line_end) in bytes, [w0, w1) in words
        breaks = np.flatnonzero(data == 10)
        starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data))
        w0 = np.searchsorted(words.start, starts)
        w1 = np.append(w0[1:], len(words))
        held = w1 > w0
        starts, ends, w0, w1 = starts[held], ends[held], w0[held], w1[held]
        self.line_doc = words.doc[w0] if len(w0) else np.zeros(0, np.int64)
        self.line_start = starts
        self.line_end = ends
        body_end = ends - (data[ends - 1] == 10) if len(ends) else ends
        line_key = RangeHash(byte_values(data))(starts, body_end)
        self.n_dup_lines = np.bincount(self.line_doc, _repeated(self.line_doc, line_key, first_too=False), minlength=n).astype(np.int64)

        # line rules
        chars = upto[w1] - upto[w0]
        last = words.end[w1 - 1] - 1
        ok = _END[data[last]]
        for mark in END_UTF8:
            tail = mark.encode()
            hit = np.ones(len(last), bool)
            for back, byte in enumerate(reversed(tail)):
                hit &= data[np.maximum(last - back, 0)] == byte
            ok |= hit
        punctuation_fails = ~ok
        pipes = _sums((data == 124) | (data == 62))
        navigation = pipes[ends] - pipes[starts] >= NAV_SEPARATORS
        noisy = (symbols[ends] - symbols[starts]) > MAX_SYMBOL_SHARE * chars
        bangs = _sums(data == 33)
        shouting = (bangs[ends] - bangs[starts] > 1) & ((bangs[ends] - bangs[starts]) > MAX_BANG_PER_WORD * (w1 - w0))
        boiler = np.zeros(len(starts), bool)
        low = data.tobytes().lower()
        for phrase in BOILERPLATE:
            found = low.find(phrase)
            while found >= 0:
                line = int(np.searchsorted(starts, found, "right")) - 1
                if line >= 0 and found + len(phrase) <= ends[line]:
                    boiler[line] = True
                found = low.find(phrase, found + 1)
        self.line_failed = punctuation_fails | navigation | noisy | shouting | boiler
        lost = np.bincount(self.line_doc, self.line_failed * chars, minlength=n)
        self.base_failed = (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words)
        self.lost_share = np.where(self.word_chars > 0, lost / np.maximum(self.word_chars, 1), 1.0)
        self.kept = ~self.base_failed & (self.lost_share <= MAX_LOST)

    def cleaned(self, words: Words, doc: int) -> str:
        """The document's text without the failed lines."""
        mine = np.flatnonzero((self.line_doc == doc) & ~self.line_failed)
        return b"".join(words.data[self.line_start[i] : self.line_end[i]].tobytes() for i in mine).decode(errors="replace")


def _metrics(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, words in word_chunks(batch.column(1)):
                c = Chunk(words)
                columns = [ids.slice(i, j - i)] + [
                    pa.array(x)
                    for x in (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.base_failed, c.kept, c.lost_share)
                ]
                names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_share"]
                if with_text:
                    columns.append(pa.array([c.cleaned(words, d) for d in range(j - i)], pa.string()))
                    names.append("cleaned_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Counts and verdict of every row; ``with_text`` adds the text of the lines that passed."""
    chosen = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return chosen.mapInArrow(_metrics(with_text), METRICS + (", cleaned_text string" if with_text else ""))


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows (all columns) whose document passes; no shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [Chunk(words).kept for _, _, words in word_chunks(batch.column(at))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
