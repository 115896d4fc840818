"""Toxic spans and document scores by a linear-chain conditional random field.

Two states, plain and toxic, over the words of a line. A word's features are the word without punctuation in lower
case, its beginnings and ending, and the words next to it. Forward-backward marginals give the chance that each word is
toxic; a document's score is a calibrated function of its marginals, and words above one half are its offending spans.

Labels are per document, so words are labelled first: cues (words, or beginnings of words) that occur in toxic documents
and hardly elsewhere are picked one by one, each for the toxic documents that no cue picked before explains. The words that
carry a cue in toxic documents are the labelled toxic ones.
"""

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.llm.common import add_columns
from claimledger.llm.quality import labelled

# Labelled documents to learn from, at most, for each label. Longer texts are left out of the sample (not cut).
MAX_PER_LABEL = 1_000
MAX_CHARS = 20_000

BITS = 18
PREFIXES = (4, 5, 6, 7, 8)
MIN_DOCUMENTS = 3
MIN_PRECISION = 0.85
MAX_CUES = 500
STEPS = 60
RIDGE = 1e-6
REMEMBERED = 500_000

EDGE = re.compile(r"^\W+|\W+$")
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_WORD = re.compile(r"\S+")


def core(word: str) -> str:
    return EDGE.sub("", word).lower()


def own_features(word: str) -> list[int]:
    """Hashed features of a word itself."""
    plain = core(word)
    names = [f"w {plain}", f"s {plain[-3:]}", *(f"p{n} {plain[:n]}" for n in PREFIXES if len(plain) >= n)]
    return [_hash(name) for name in names]


def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def cues_of(word: str) -> list[str]:
    plain = core(word)
    return [plain, *(f"{plain[:n]}*" for n in PREFIXES if len(plain) >= n)] if plain else []


def pick_cues(documents: Sequence[set[str]], labels: Sequence[int]) -> set[str]:
    """Cues that explain the toxic documents (sets of cues), each new one documents left over by those before."""
    clean = Counter(cue for cues, label in zip(documents, labels, strict=True) if not label for cue in cues)
    left = [cues for cues, label in zip(documents, labels, strict=True) if label]
    toxic = Counter(cue for cues in left for cue in cues)
    picked: set[str] = set()
    while len(picked) < MAX_CUES:
        gain = Counter(cue for cues in left for cue in cues)
        good = [
            (n - 3 * clean[cue], -len(cue), cue)
            for cue, n in gain.items()
            if n >= MIN_DOCUMENTS and toxic[cue] >= MIN_PRECISION * (toxic[cue] + clean[cue] + 0.5)
        ]
        if not good or max(good)[0] <= 0:
            break
        best = max(good)[2]
        picked.add(best)
        left = [cues for cues in left if best not in cues]
    return picked


class Chains:
    """Words of many lines, as one flat row of word numbers and the lines' places, longest first."""

    def __init__(self, lengths: np.ndarray):
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        self.starts, self.lengths = starts[order], lengths[order]
        self.size = int(lengths.sum())
        longest = int(self.lengths[0]) if len(self.lengths) else 0
        #: How many lines have more than t words.
        self.active = np.searchsorted(-self.lengths, -np.arange(longest), "left")
        self.first = np.zeros(self.size, bool)
        self.first[self.starts] = True
        self.last = np.zeros(self.size, bool)
        self.last[self.starts + self.lengths - 1] = True

    def messages(self, odds: np.ndarray, move: np.ndarray, begin: float) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward messages as ratios toxic to plain. ``move[a, b]``: weight from a to b."""
        forward, backward = np.empty(self.size), np.ones(self.size)
        if not self.size:
            return forward, backward
        forward[self.starts] = begin * odds[self.starts]
        for t in range(1, len(self.active)):
            at = self.starts[: self.active[t]] + t
            before = forward[at - 1]
            forward[at] = np.clip(
                odds[at] * (move[0, 1] + move[1, 1] * before) / (move[0, 0] + move[1, 0] * before), 1e-30, 1e30
            )
        for t in range(len(self.active) - 2, -1, -1):
            at = self.starts[: self.active[t + 1]] + t
            after = odds[at + 1] * backward[at + 1]
            backward[at] = (move[1, 0] + move[1, 1] * after) / (move[0, 0] + move[0, 1] * after)
        return forward, backward


@dataclass(frozen=True)
class Tagger:
    """Weights of the field, and of the calibration."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    move: np.ndarray
    begin: float
    calibration: np.ndarray

    def __hash__(self) -> int:
        return id(self)

    def __eq__(self, other: object) -> bool:
        return self is other


class Words(dict):
    """Word to number, with the word's weights alongside. Starts anew when full, between slices."""

    def __init__(self, tagger: Tagger):
        super().__init__()
        self.tagger = tagger
        self.weights = [array("d"), array("d"), array("d")]

    def __missing__(self, word: str) -> int:
        name = _hash(f"w {core(word)}")
        given = self.tagger
        for kept, weight in zip(self.weights, (sum(given.own[i] for i in own_features(word)), given.before[name], given.after[name]), strict=True):
            kept.append(weight)
        number = self[word] = len(self)
        return number

    def numbers(self, lines: list[list[str]], size: int) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
            self.weights = [array("d"), array("d"), array("d")]
        return np.fromiter((n for line in lines for n in map(self.__getitem__, line)), np.int64, size)


def log_odds(numbers: np.ndarray, chains: Chains, own: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Emission log-odds of each word: its own weight, and those of the words next to it in its line."""
    out = own[numbers]
    out[1:] += np.where(chains.first[1:], 0.0, before[numbers[:-1]])
    out[:-1] += np.where(chains.last[:-1], 0.0, after[numbers[1:]])
    return np.clip(out, -30, 30)


def fit(texts: Sequence[str], labels: Sequence[int]) -> Tagger:
    """Learn cues, field and calibration from labelled texts. Without both labels, every score is the same."""
    size = 1 << BITS
    if len(set(labels)) < 2:
        level = 6.0 if labels and labels[0] else -6.0
        zero = np.zeros(size)
        return Tagger(zero, zero, zero, np.ones((2, 2)), 1e-6, np.array([level, 0, 0, 0]))
    lines = [line.split() for text in texts for line in text.split("\n")]
    counts = [len(text.split("\n")) for text in texts]
    lengths = np.array([len(line) for line in lines], np.int64)
    owner = np.repeat(np.repeat(np.arange(len(texts)), counts), lengths)
    vocabulary: dict[str, int] = {}
    numbers = np.array([vocabulary.setdefault(w, len(vocabulary)) for line in lines for w in line], np.int64)
    cues_by_word = [set(cues_of(word)) for word in vocabulary]
    sets: list[set[str]] = [set() for _ in texts]
    for document, number in set(zip(owner.tolist(), numbers.tolist(), strict=True)):
        sets[document] |= cues_by_word[number]
    picked = pick_cues(sets, labels)
    has_cue = np.array([bool(cues & picked) for cues in cues_by_word], bool)
    target = (has_cue[numbers] & (np.asarray(labels)[owner] == 1)).astype(float)

    features = [own_features(word) for word in vocabulary]
    flat = np.array([f for own in features for f in own], np.int64)
    of_word = np.repeat(np.arange(len(features)), [len(own) for own in features])
    name = np.array([_hash(f"w {core(word)}") for word in vocabulary], np.int64)
    chains = Chains(lengths)
    inner = ~chains.first[1:]  # word t+1 follows word t in its line
    weights = [np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(3), np.zeros(1)]  # own, before, after, moves, begin
    weights[3][:] = (-4.0, 0.0, 0.0)
    weights[4][:] = -4.0
    momentum, energy = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    both = np.stack([(1 - target[:-1]) * target[1:], target[:-1] * (1 - target[1:]), target[:-1] * target[1:]])[:, inner].sum(1)
    for step in range(1, STEPS + 1):
        own, before, after, moves, begin = weights
        per_word = np.bincount(of_word, own[flat], len(features))
        odds = np.exp(log_odds(numbers, chains, per_word, before[name], after[name]))
        move = np.exp(np.array([[0.0, moves[0]], [moves[1], moves[2]]]))
        forward, backward = chains.messages(odds, move, float(np.exp(begin[0])))
        ratio = forward * backward
        chance = ratio / (1 + ratio)
        miss = (chance - target) / len(texts)
        into = odds[1:] * backward[1:]
        cells = np.stack([np.ones_like(into) * move[0, 0], move[0, 1] * into, forward[:-1] * move[1, 0], forward[:-1] * move[1, 1] * into])[:, inner]
        expected = (cells / cells.sum(0)).sum(1)[1:]
        by_word = np.bincount(numbers, miss, len(features))
        gradient = [
            np.bincount(flat, by_word[of_word], size),
            np.bincount(name, np.bincount(numbers[:-1], miss[1:] * inner, len(features)), size),
            np.bincount(name, np.bincount(numbers[1:], miss[:-1] * inner, len(features)), size),
            (expected - both) / len(texts),
            np.array([miss[chains.starts].sum()]),
        ]
        for number, slope in enumerate(gradient):  # Adam
            slope = slope + RIDGE * weights[number]
            momentum[number] = 0.9 * momentum[number] + 0.1 * slope
            energy[number] = 0.99 * energy[number] + 0.01 * slope**2
            scaled = momentum[number] / (1 - 0.9**step) / (np.sqrt(energy[number] / (1 - 0.99**step)) + 1e-8)
            weights[number] = weights[number] - 0.15 * scaled
    own, before, after, moves, begin = weights
    move = np.exp(np.array([[0.0, moves[0]], [moves[1], moves[2]]]))
    tagger = Tagger(own, before, after, move, float(np.exp(begin[0])), np.zeros(4))
    per_word = np.bincount(of_word, own[flat], len(features))
    odds = np.exp(log_odds(numbers, chains, per_word, before[name], after[name]))
    forward, backward = chains.messages(odds, move, tagger.begin)
    chance = forward * backward / (1 + forward * backward)
    x = aggregate(chance, owner, len(texts))
    return Tagger(own, before, after, move, tagger.begin, _logistic(x, np.asarray(labels, float)))


def aggregate(chance: np.ndarray, owner: np.ndarray, documents: int) -> np.ndarray:
    """Per document: a constant, the largest log-odds, and the expected number and share of toxic words."""
    peak = np.full(documents, 1e-9)
    np.maximum.at(peak, owner, chance)
    peak = np.clip(peak, 1e-9, 1 - 1e-9)
    expected = np.bincount(owner, chance, documents)
    words = np.maximum(np.bincount(owner, minlength=documents), 1)
    return np.stack([np.ones(documents), np.log(peak / (1 - peak)) / 5, np.log1p(expected), np.sqrt(expected / words)], 1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression, both labels weighing the same."""
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-3 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        change = np.linalg.solve(curve, slope)
        w -= change / max(1.0, np.abs(change).max() / 5)
    return w


@lru_cache(maxsize=2)
def _words(tagger: Tagger) -> Words:
    return Words(tagger)


def tag(tagger: Tagger, texts: list[str], words: Words | None = None) -> tuple[np.ndarray, list[list[dict[str, int]]]]:
    """Scores and offending spans (code points, end exclusive) of texts."""
    words = Words(tagger) if words is None else words
    lines, counts = [], []
    for text in texts:
        own = [line.split() for line in text.split("\n")]
        counts.append(len(own))
        lines += own
    lengths = np.array([len(line) for line in lines], np.int64)
    owner = np.repeat(np.repeat(np.arange(len(texts)), counts), lengths)
    chains = Chains(lengths)
    numbers = words.numbers(lines, chains.size)
    tables = [np.frombuffer(w, float) if len(w) else np.empty(0) for w in words.weights]
    odds = np.exp(log_odds(numbers, chains, *tables)) if chains.size else np.empty(0)
    del tables  # the arrays can grow again
    forward, backward = chains.messages(odds, tagger.move, tagger.begin)
    ratio = forward * backward
    chance = ratio / (1 + ratio)
    scores = 1 / (1 + np.exp(-np.clip(aggregate(chance, owner, len(texts)) @ tagger.calibration, -30, 30)))
    spans: list[list[dict[str, int]]] = [[] for _ in texts]
    hits = np.flatnonzero(chance >= 0.5)
    first = np.searchsorted(owner, np.arange(len(texts)))
    for document in np.unique(owner[hits]).tolist():
        wanted = set((hits[owner[hits] == document] - first[document]).tolist())
        for number, found in enumerate(_WORD.finditer(texts[document])):
            if number in wanted:
                spans[document].append({"start": found.start(), "end": found.end()})
    return scores, spans


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = MAX_PER_LABEL) -> Tagger:
    """Learn from a bounded sample: at most ``per_label`` documents for each label, of at most ``MAX_CHARS`` each."""
    short = documents.where(F.length("text") <= MAX_CHARS)
    sample = labelled(short, labels, label, per_label).select("text", "label").collect()
    rows = sorted({(r.text, r.label) for r in sample})
    return fit([r[0] for r in rows], [r[1] for r in rows])


def score(documents: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """``documents`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``toxic_spans``.

    NULL texts score as empty ones. No shuffle; columns of these names are replaced. Repeated rows get equal scores.
    """
    given = documents.sparkSession.sparkContext.broadcast(tagger)

    def make():
        words = _words(given.value)

        def compute(texts: list[str]) -> list[pa.Array]:
            scores, spans = tag(given.value, texts, words)
            return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(spans, SPANS)]

        return compute

    return add_columns(documents, text, make, "score double, predicted int, toxic_spans array<struct<start:bigint,end:bigint>>")
