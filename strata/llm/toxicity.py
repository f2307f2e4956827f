"""Toxicity by a subsequence string kernel SVM with Nystroem landmarks, trained on sentences.

The kernel of two strings sums, over all character triples that both hold in
order (gaps allowed), decay**(span in one + span in the other), scaled by what
strings of their lengths could reach; gapped and inserted characters cost only
decay.  A sentence is a bag of strings: its tokens, its runs of single
characters ("i d i o t") and those neighbouring tokens that read on across the
space as inside a landmark ("id iot", two-word insults).  It scores by its
most toxic string, its witness, and a document by its most toxic sentence,
mapped to 0..1 by a logistic fitted on the sample.

A linear SVM (squared hinge) is trained on Nystroem features of the witnesses
of labelled sentences.  The sentences of toxic documents are not all toxic, so
witnesses are chosen in rounds: first by a likelihood ratio of the two classes'
uses, held to ``CHANCE`` false ones in all, then by the machine's own margin
over every sentence of the sample.  Clean sentences give their most toxic
strings and a spread of the others.  Sentences with one witness count once, so
copies weigh no more.  Pairs read as one lose as much
margin as lets them reach a tenth of the clean documents that tokens reach.

Because the SVM is linear in kernel values against landmarks, scoring a string
is one table of weights per triple.  As the largest of the sentences' maxima is
the document's, scoring needs sentence ends only to keep pairs inside them.

Defined results: null, empty and wordless texts score 0; equal texts score
alike; an empty table gives no rows; without labels of both classes, or without
any string commoner in toxic documents than chance allows, every score is 0.
Very long texts are scored whole, very long tokens in overlapping pieces.
Several rows of one id are scored each, but train as one.  Extra columns are
ignored; labels, lang, source and id are never inputs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import fold, sample

#: Bounds of the fit: at most this many labelled documents that are not toxic, and that are,
#: and of each so many pieces of sentences (chosen by hash) of so many characters.
PER_CLASS = (4000, 2000)
SENTENCES, PIECE = 128, 512
LANDMARKS, NEUTRAL, CONTRAST = 192, 32, 160
DECAY = 0.6
LONGEST = 24
HARD, RANDOM, ROUNDS = 3000, 6000, 4
#: Weight of the hinge loss against the norm.
COST = 100.0
#: First witnesses: expected number by chance; all witnesses: least share of toxic documents among their uses.
CHANCE, PURE = 0.05, 0.7
#: Share of clean documents whose pairs of tokens may look worse than their tokens by chance or wrong labels.
BY_CHANCE = 0.001
#: Triple codes looked up in one array over all of them; a larger alphabet's are searched in sorted order.
DENSE = 1 << 22
FOLDS, HELD_OUT = 5, 0
#: A character that no landmark holds.
FOREIGN = "\0"
#: Tokens whose margins a task remembers (a cache only; any token is scored again after it).
REMEMBERED = 300_000

_EDGE = " \t\n\r.,;:!?\"'()[]{}«»“”„…-*#"
_ENDS = (".", "!", "?")
_SPELLED = re.compile(r"(?<!\S)\w(?:[ .*_-]\w){2,}(?!\w)")


def spelled(text: str) -> list[str]:
    """Runs of single characters, joined."""
    return [re.sub(r"[ .*_-]", "", run) for run in _SPELLED.findall(text)]


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}


def _triples(length: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Positions i < j < k of a token, decay weights, and their norm."""
    if length not in _TRIPLES:
        at = np.array(list(combinations(range(length), 3)), np.int64).reshape(-1, 3)
        weight = (DECAY ** (at[:, 2] - at[:, 0] - 2)).astype(np.float32)
        _TRIPLES[length] = at, weight, float(np.sqrt((weight**2).sum())) or 1.0
    return _TRIPLES[length]


class Alphabet:
    """Characters of the landmarks; any other character matches nothing."""

    def __init__(self, chars: str):
        self.size = len(chars) + 1
        self.table = np.zeros(0x110000, np.int32)  # code point -> 0 (other) or 1..
        self.table[[ord(c) for c in chars]] = np.arange(1, self.size)

    def codes(self, texts: list[str], length: int) -> np.ndarray:
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.table[points].reshape(-1, length).astype(np.int64)

    def pieces(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(owner, character codes)`` of the words by equal length; long words go in overlapping pieces."""
        groups: dict[int, tuple[list[int], list[str]]] = {}
        for n, word in enumerate(words):
            word = f"^{word.strip(_EDGE)}$"  # the marks tell a token's ends from its middle
            for at in range(0, max(1, len(word) - LONGEST // 2), LONGEST // 2):
                piece = word[at : at + LONGEST]
                if len(piece) >= 4:
                    owners, texts = groups.setdefault(len(piece), ([], []))
                    owners.append(n)
                    texts.append(piece)
        for length, (owners, texts) in groups.items():
            step = max(1, 400_000 // max(1, len(_triples(length)[0])))
            for k in range(0, len(texts), step):
                yield np.array(owners[k : k + step]), self.codes(texts[k : k + step], length)

    def borders(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the last two characters of ``^word`` and of the first two of ``word$`` (0: matches nothing)."""
        bare = [w.strip(_EDGE) for w in words]
        last = self.codes([f"{FOREIGN}^{w}"[-2:] for w in bare], 2)
        first = self.codes([(f"{w}$" + FOREIGN)[:2] for w in bare], 2)
        out = (last[:, 0] * self.size + last[:, 1], first[:, 0] * self.size + first[:, 1])
        return tuple(np.where((pair > 0).all(1), code, 0) for pair, code in zip((last, first), out, strict=True))

    def triple_codes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code of every triple (0 where a character is not in the alphabet) and its scaled weight."""
        at, weight, norm = _triples(codes.shape[1])
        a, b, c = codes[:, at[:, 0]], codes[:, at[:, 1]], codes[:, at[:, 2]]
        out = (a * self.size + b) * self.size + c
        out[(a == 0) | (b == 0) | (c == 0)] = 0
        return out, weight / norm


class Rows:
    """Row numbers (1..) of the triple codes in use; 0 for any other code."""

    def __init__(self, used: np.ndarray, size: int):
        self.used, self.dense = used, None
        if size**3 <= DENSE:
            self.dense = np.zeros(size**3, np.int32)
            self.dense[used] = np.arange(1, len(used) + 1)

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense[codes]
        if not len(self.used):
            return np.zeros(codes.shape, np.int64)
        at = np.minimum(np.searchsorted(self.used, codes), len(self.used) - 1)
        return np.where(self.used[at] == codes, at + 1, 0)


class Kernel:
    """Kernel values of strings against landmarks."""

    def __init__(self, landmarks: list[str]):
        self.alphabet = Alphabet("".join(sorted(set("^$".join(["", *landmarks])))))
        entries: dict[int, dict[int, float]] = {}
        for owner, codes in self.alphabet.pieces(landmarks):
            triple, weight = self.alphabet.triple_codes(codes)
            for n, r in zip(owner.tolist(), triple, strict=True):
                for code, w in zip(r.tolist(), weight.tolist(), strict=True):
                    if code:
                        mine = entries.setdefault(code, {})
                        mine[n] = mine.get(n, 0.0) + w
        used = sorted(entries)
        self.row = Rows(np.array(used, np.int64), self.alphabet.size)
        self.weights = np.zeros((len(used) + 1, len(landmarks)), np.float32)
        for k, code in enumerate(used):
            for n, w in entries[code].items():
                self.weights[k + 1, n] = w

    def joints(self, landmarks: list[str]) -> Rows:
        """Triples of neighbouring characters in the given landmarks."""
        runs = [codes for _, codes in self.alphabet.pieces(landmarks)]
        size = self.alphabet.size
        triples = [((c[:, :-2] * size + c[:, 1:-1]) * size + c[:, 2:]).ravel() for c in runs]
        return Rows(np.unique(np.concatenate([np.zeros(0, np.int64), *triples])), size)

    def model(self, weights: np.ndarray, bias: float, marked: list[str]) -> Model:
        """The margin ``values @ weights + bias``; ``marked`` are the landmarks that a pair of tokens may resemble."""
        return Model(self.alphabet, self.row, (self.weights @ weights).astype(np.float32), self.joints(marked), bias)

    def values(self, words: list[str]) -> np.ndarray:
        """Largest kernel value of each word's pieces against every landmark."""
        out = np.zeros((len(words), self.weights.shape[1]), np.float32)
        for owner, codes in self.alphabet.pieces(words):
            triple, weight = self.alphabet.triple_codes(codes)
            rows = self.row[triple]
            for k in range(0, len(rows), 256):  # bounds the values held at once
                part = rows[k : k + 256]
                word, place = np.nonzero(part)
                if len(word):
                    cut = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                    sums = np.add.reduceat(self.weights[part[word, place]] * weight[place, None], cut, axis=0)
                    np.maximum.at(out, owner[k : k + 256][word[cut]], sums)
        return out


@dataclass
class Model:
    """Margins as one weight per character triple."""

    alphabet: Alphabet
    row: Rows
    weight: np.ndarray  # row of a triple -> weight in the margin
    joint: Rows
    bias: float
    across: float = 0.0  # what a pair of tokens must exceed a token by
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), -np.inf)
        for owner, codes in self.alphabet.pieces(words):
            triple, weight = self.alphabet.triple_codes(codes)
            np.maximum.at(out, owner, self.weight[self.row[triple]] @ weight)
        return np.where(np.isfinite(out), out, 0.0) + self.bias

    def joined(self, last: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which borders of two tokens read on as inside a landmark."""
        size = self.alphabet.size
        near = self.joint[last * size + first // size] > 0
        return near & (self.joint[last % size * size**2 + first] > 0) & (last > 0) & (first > 0)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


class Scorer:
    """Largest margins of texts, with the tokens' margins remembered."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number = {"": 0}  # 0 also parts the texts
        self.margin, self.last, self.first, self.ends = np.full(1, -np.inf), *(np.zeros(1, np.int64) for _ in "lf"), np.ones(1, bool)

    def _learn(self, words: list[str]) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))
        last, first = self.model.alphabet.borders(words)
        self.margin = np.concatenate([self.margin, self.model.margins(words)])
        self.last, self.first = np.concatenate([self.last, last]), np.concatenate([self.first, first])
        self.ends = np.concatenate([self.ends, np.fromiter((w.endswith(_ENDS) for w in words), bool, len(words))])

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Of each text; -inf without words."""
        lists = []
        for text in texts:
            text = (text or "").lower()
            words = text.split()
            lists.append(["", *words, "", *[w for run in spelled(text) for w in (run, "")]] if words else [""])
        flat = [w for words in lists for w in words]
        new = sorted(set(flat).difference(self.number))
        if len(self.number) + len(new) > REMEMBERED:
            self._forget()
            new = sorted(set(flat).difference(self.number))
        if new:
            self._learn(new)
        ids = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        starts = np.concatenate([[0], np.cumsum([len(words) for words in lists])[:-1]]).astype(np.int64)
        out = np.maximum.reduceat(self.margin[ids], starts)
        at = np.flatnonzero(self.model.joined(self.last[ids[:-1]], self.first[ids[1:]]) & ~self.ends[ids[:-1]])
        if len(at):
            pairs = [flat[k].strip(_EDGE) + flat[k + 1].strip(_EDGE) for k in at.tolist()]
            distinct = sorted(set(pairs))
            margin = dict(zip(distinct, (self.model.margins(distinct) - self.model.across).tolist(), strict=True))
            np.maximum.at(out, np.searchsorted(starts, at, "right") - 1, [margin[p] for p in pairs])
        return out


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by damped Newton steps over the active rows."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x1.shape[1], 1.0)
    ridge[-1] = 1e-6

    def loss(out: np.ndarray, w: np.ndarray) -> float:
        return float((ridge * w * w).sum() + (cost * np.maximum(0, 1 - y * out) ** 2).sum())

    w, out = np.zeros(x1.shape[1]), np.zeros(len(x1))
    now = loss(out, w)
    for _ in range(rounds):
        on = y * out < 1
        xa = x1[on]
        weighted = xa * cost[on, None]
        step = np.linalg.solve(np.diag(ridge) + weighted.T @ xa, weighted.T @ y[on]) - w
        out_step, size = x1 @ step, 1.0
        while size > 1e-3 and loss(out + size * out_step, w + size * step) > now:
            size /= 2
        w, out = w + size * step, out + size * out_step
        before, now = now, loss(out, w)
        if before - now <= 1e-4 * before:
            break
    return w[:-1], float(w[-1])


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(1 | margin), both classes weighing the same; slope > 0."""
    slope, offset = 1.0, 0.0
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g = weight * (p - y)
        h = weight * np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * margin).sum() + 1e-4 * slope, g.sum()])
        hess = np.array([[(h * margin**2).sum() + 1e-4, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        slope, offset = slope - np.clip(step[0], -1, 1), offset - np.clip(step[1], -1, 1)
    return max(float(slope), 1e-3), float(offset)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often each occurs."""
    rows = rows[np.lexsort(rows.T)]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), (rows[1:] != rows[:-1]).any(1)]))
    return rows[first], np.diff(np.append(first, len(rows)))


class Corpus:
    """The sample's sentences as one array of token numbers; 0 parts sentences."""

    def __init__(self, examples: list[tuple[list[str], int]]):
        number: dict[str, int] = {"": 0}
        tokens, owner = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        for n, (sentences, _) in enumerate(examples):
            words = []
            for text in sentences:
                text = text.lower()
                words += [w.strip(_EDGE) for w in text.split()] + [""]
                words += [w for run in spelled(text) for w in (run, "")]
            tokens.append(np.array([number.setdefault(w, len(number)) for w in words], np.int32))
            owner.append(np.full(len(words), n, np.int32))
        self.tokens, self.owner = np.concatenate(tokens, dtype=np.int32), np.concatenate(owner, dtype=np.int32)
        self.words = list(number)
        self.label = np.array([y for _, y in examples])

    def uses(self, width: int, label: int, spare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of ``width`` tokens as one sorted number each, and how often a class uses them.

        Uses between the same two tokens count once.

        Runs of under three characters, across sentences or with a spare token are left out.
        """
        n = len(self.tokens) - width - 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        columns = [self.tokens[k : k + n] for k in range(width + 2)]
        inner = columns[1:-1]
        length = np.array([len(w) for w in self.words])
        fit = (self.label[self.owner[1 : n + 1]] == label) & (sum(length[c] for c in inner) >= 3)
        for c in inner:
            fit &= (c > 0) & ~spare[c]
        rows, _ = _distinct(np.stack([c[fit] for c in columns], 1))
        key = np.zeros(len(rows), np.int64)
        for k in range(1, width + 1):
            key = key * len(self.words) + rows[:, k]
        return np.unique(key, return_counts=True)

    def text(self, key: int) -> str:
        before, last = divmod(key, len(self.words))
        return (self.words[before] if before else "") + self.words[last]

    def pairs(self, model: Model) -> tuple[np.ndarray, list[str]]:
        """Places of the neighbouring tokens that the model reads as one, and the joined strings."""
        last, first = model.alphabet.borders(self.words)
        last[0] = first[0] = 0
        at = np.flatnonzero(model.joined(last[self.tokens[:-1]], first[self.tokens[1:]]))
        return at, [self.words[self.tokens[k]] + self.words[self.tokens[k + 1]] for k in at.tolist()]


def _marking(toxic: tuple[np.ndarray, np.ndarray], clean: tuple[np.ndarray, np.ndarray]) -> dict[int, int]:
    """Runs commoner in toxic documents than chance allows over the whole vocabulary, with their uses there.

    Log-likelihood ratio of the two classes' uses against one rate for both,
    held to ``CHANCE`` false ones in all.
    """
    (runs, c), (known, uses) = toxic, clean
    if not len(runs) or not len(known):
        return {}
    at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
    shared = known[at] == runs
    other = np.where(shared, uses[at], 0)
    least = np.log((len(runs) + len(known) - shared.sum()) / CHANCE)
    share = c.sum() / (c.sum() + uses.sum())
    rate = c / (c + other)
    gain = c * np.log(rate / share) + other * np.log(np.maximum(1 - rate, 1e-300) / (1 - share))
    on = (rate > share) & (gain >= least) & (rate >= PURE)
    return dict(zip(runs[on].tolist(), c[on].tolist(), strict=True))


def _spread(words: list[str], most: int) -> list[str]:
    """Words by their order, each unlike those before."""
    near = Kernel(words)
    values = near.values(words)
    scale = np.sqrt(np.maximum(np.diag(values), 1e-9))
    values = values / scale[:, None] / scale[None, :]
    chosen, closest = [0], values[0].copy()
    while len(chosen) < min(most, len(words)):
        n = int(np.argmin(closest))
        if closest[n] > 0.98:
            break
        chosen.append(n)
        closest = np.maximum(closest, values[n])
    return [words[n] for n in chosen]


def train(examples: list[tuple[list[str], int]]) -> Model | None:
    """Fit on ``(sentences of a document, label)`` pairs."""
    corpus = Corpus(examples)
    single = [corpus.uses(1, y, np.zeros(len(corpus.words), bool)) for y in (1, 0)]
    first = {corpus.words[k]: c for k, c in _marking(*single).items()}
    clean = {corpus.words[k]: c for k, c in zip(*(v.tolist() for v in single[1]), strict=True)}
    # pairs of tokens that mark together, though neither does alone
    spare = np.array([w in first for w in corpus.words])
    for key, c in _marking(*(corpus.uses(2, y, spare) for y in (1, 0))).items():
        text = corpus.text(key)
        first[text] = max(first.get(text, 0), c)
    if not first:
        return None
    marked = _spread(sorted(first, key=lambda t: (-first[t], t))[: 8 * LANDMARKS], LANDMARKS)
    common = sorted(clean.items(), key=lambda x: (-x[1], x[0]))
    landmarks = marked + [t for t, _ in common if len(t) >= 4 and t not in first][:NEUTRAL]
    sentence = np.cumsum(corpus.tokens == 0) - (corpus.tokens == 0)  # a separator ends its sentence
    is_toxic = corpus.label[corpus.owner] == 1
    positive, negative, model = set(first), set(), None
    for step in range(ROUNDS):
        if step < 2:  # the landmarks stay from then on
            kernel, place, features = Kernel(landmarks), {}, []
            middle = kernel.values(landmarks).astype(np.float64)
            value, axes = np.linalg.eigh((middle + middle.T) / 2)
            root = axes @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ axes.T
        if model is None:
            others = sorted(t for t in clean if t not in positive)
            negative.update(others[:: max(1, len(others) // RANDOM)])
        negative -= positive
        rows = sorted(positive), sorted(negative)
        new = [t for t in (*rows[0], *rows[1]) if t not in place]
        place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
        features.append(kernel.values(new).astype(np.float64) @ root)
        x = np.concatenate(features)[[place[t] for t in (*rows[0], *rows[1])]]
        y = np.repeat([1.0, -1.0], [len(r) for r in rows])
        w, bias = _svm(x, y, np.where(y > 0, COST * min(len(rows[1]) / len(rows[0]), 20.0), COST))
        model = kernel.model(root @ w, bias, marked)

        # every sentence's strings under the new machine
        margin = model.margins(corpus.words)
        margin[0] = -np.inf
        at, pairs = corpus.pairs(model)
        pair_margin = model.margins(pairs)
        # chance puts insults together from clean tokens too: at any margin, pairs may reach a tenth of the clean documents that tokens reach
        ranks = []
        for owners, values in ((corpus.owner, margin[corpus.tokens]), (corpus.owner[at], pair_margin)):
            worst = np.full(len(examples), -np.inf)
            np.maximum.at(worst, owners, values)
            ranks.append(np.sort(worst[corpus.label == 0])[::-1])
        filled = np.arange(int(np.isfinite(ranks[0]).sum() * BY_CHANCE), np.isfinite(ranks[0]).sum(), 10)
        joined = ranks[1][filled[0] : filled[0] + len(filled)] if len(filled) else ranks[1][:0]
        model.across = max(0.0, float((joined - ranks[0][filled]).max(initial=0.0)))
        pair_margin = pair_margin - model.across
        best = np.full(sentence[-1] + 1, -np.inf)
        np.maximum.at(best, sentence, margin[corpus.tokens])
        np.maximum.at(best, sentence[at], pair_margin)
        if step == ROUNDS - 1:
            break
        # witnesses of toxic sentences, unless clean documents use them too; the hardest strings of clean ones
        places = [*np.flatnonzero((margin[corpus.tokens] == best[sentence]) & (best[sentence] > 0) & is_toxic).tolist()]
        uses = Counter(corpus.words[corpus.tokens[k]] for k in places)
        uses.update(p for k, p, m in zip(at.tolist(), pairs, pair_margin.tolist(), strict=True) if is_toxic[k] and m > 0 and m == best[sentence[k]])
        seen = Counter(clean)
        positive = set(first) | {t for t, c in uses.items() if len(t) >= 3 and c >= PURE * (c + seen[t] + 1)}
        known = dict(zip(corpus.words, margin.tolist(), strict=True))
        strings = sorted(t for t in seen if t not in positive)
        hard = np.argsort([-known[t] for t in strings], kind="stable")
        negative.update(strings[k] for k in hard[:HARD])
        if step == 0:  # the clean strings that come closest are landmarks from now on
            landmarks += [strings[k] for k in hard[: 4 * CONTRAST : 4] if strings[k] not in landmarks]
    most = np.full(len(examples), -np.inf)
    np.maximum.at(most, corpus.owner, best[sentence])
    filled = np.isfinite(most)
    model.slope, model.offset = _logistic(most[filled], corpus.label[filled].astype(float))
    return model


def sentences(text: Column, most: int = SENTENCES, piece: int = PIECE) -> Column:
    """Sentences of a text in pieces of ``piece`` characters; of more than ``most``, those first by hash."""
    whole = F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+")
    cut = F.flatten(F.transform(whole, lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1)), F.lit(piece)), lambda k: s.substr(k, F.lit(piece)))))
    ranked = F.array_sort(F.transform(cut, lambda s: F.struct(F.xxhash64(s).alias("h"), s.alias("s"))))
    return F.when(F.size(cut) <= most, cut).otherwise(F.transform(F.slice(ranked, 1, most), lambda r: r["s"]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: tuple[int, int] = PER_CLASS) -> Model | None:
    rows = sample(docs, labels, label, fold(F.col("doc_id"), FOLDS) == HELD_OUT, per_class)
    rows = rows.select("doc_id", "y", sentences(F.col("text")).alias("sentences")).collect()
    return train([(r.sentences, r.y) for r in sorted(rows, key=lambda r: r.doc_id)])


def score_toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = Scorer(model) if model else None
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for first in range(0, batch.num_rows if model else 0, 256):
                margin = scorer.margins(batch.column(1).slice(first, 256).to_pylist())
                score[first : first + 256] = np.where(np.isfinite(margin), np.round(model.probability(margin), 6), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
