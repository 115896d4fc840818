"""Periodic runs of words: stretches that repeat with a period, and the texts without the repetitions.

Words are runs of anything but ASCII white space. A run is a stretch of at least ``LEAST_WORDS`` words that holds its smallest
period at least ``LEAST_REPEATS`` times and that no neighbouring word extends keeping the period.

Suffixes of a text's words are put in classes: first each suffix is a class, then classes are united by falling length of the
common beginning (LCP) of neighbours in suffix order, with union-find. Each class keeps its positions in order. Where a union
makes two positions neighbours and they are no further apart than their LCP allows, the words from one to the end of the
common beginning of the other repeat with that distance as their period: a seed. Both ends are then known, as the LCP
ends where the period does, and a seed that can be continued to the left belongs to a run that starts earlier.

Why every run is found once, with its smallest period: with a run's start s, length n and period q, the suffixes at s
and s + q share n - q >= 2q words. A position of the same class between them would give the run a smaller period
(Fine and Wilf), so the two become neighbours exactly when their classes are united. For the same reason a multiple of the
smallest period is never the distance of neighbours.

A run's first two periods share at least ``SHARED`` words. So only texts in which some window of that many words occurs twice,
by hash, are sorted at all, and unions end at that LCP; what is sorted are the words themselves, so hashes decide nothing.
Each text is handled whole, where it is read; memory grows with the longest text.
"""

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimledger.llm.blocks import hash_words, mix, rolling
from claimledger.llm.common import add_columns

LEAST_WORDS = 24
LEAST_REPEATS = 3
# The least of max(LEAST_WORDS - q, (LEAST_REPEATS - 1) * q) over all periods q.
SHARED = -(-LEAST_WORDS * (LEAST_REPEATS - 1) // LEAST_REPEATS)
CHUNK = 512

Run = tuple[int, int, int]  # start, length, period

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
ADDED = (
    "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>,"
    " strongest struct<start:bigint,length:bigint,period:bigint>, collapsed string"
)


class Positions:
    """An ordered set of positions in chunks of bounded size, so that adding one costs little in a set of any size."""

    def __init__(self, position: int):
        self.chunks = [[position]]
        self.least = [position]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk

    def around(self, position: int) -> tuple[int | None, int | None]:
        """The nearest positions below and above one that is not in the set."""
        at = bisect_right(self.least, position) - 1
        if at < 0:
            return None, self.least[0]
        chunk = self.chunks[at]
        place = bisect_left(chunk, position)
        if place < len(chunk):
            return chunk[place - 1], chunk[place]
        return chunk[-1], self.least[at + 1] if at + 1 < len(self.least) else None

    def add(self, position: int) -> None:
        at = max(bisect_right(self.least, position) - 1, 0)
        chunk = self.chunks[at]
        insort(chunk, position)
        self.least[at] = chunk[0]
        self.size += 1
        if len(chunk) > 2 * CHUNK:
            self.chunks[at : at + 1] = [chunk[:CHUNK], chunk[CHUNK:]]
            self.least[at : at + 1] = [chunk[0], chunk[CHUNK]]


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of numbered words (1 and up) in order, and how many words each shares with the next one.

    Ranks of windows of 1, 2, 4 ... words come from pairs of ranks of half the width, until all differ.
    """
    count, width = len(words), 1
    ranks = [np.append(words, 0).astype(np.int32)]
    while True:
        last = ranks[-1]
        pair = last[:-1].astype(np.int64) * (count + 2)
        pair[: max(count - width, 0)] += last[width:-1][: max(count - width, 0)]
        found, place = np.unique(pair, return_inverse=True)
        ranks.append(np.append(place + 1, 0).astype(np.int32))
        width *= 2
        if len(found) == count:
            break
    order = np.argsort(ranks[-1][:-1], kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(left), np.int64)
    for level in range(len(ranks) - 2, -1, -1):  # the widest windows all differ
        same = ranks[level][left] == ranks[level][right]
        step = same.astype(np.int64) << level
        left, right, shared = left + step, right + step, shared + step
    return order, shared


def runs_of(words: np.ndarray) -> list[Run]:
    """The runs of numbered words (1 and up), by start and then period."""
    order, shared = suffix_order(words)
    edges = np.flatnonzero(shared >= SHARED)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}
    runs: list[Run] = []

    def class_of(position: int) -> int:
        root = position
        while (above := parent.setdefault(root, root)) != root:
            root = above
        while parent[position] != root:
            parent[position], position = root, parent[position]
        if root not in classes:
            classes[root] = Positions(root)
        return root

    def seed(first: int, second: int, common: int) -> None:
        starts_here = first == 0 or words[first - 1] != words[second - 1]
        if starts_here and common + second - first >= LEAST_WORDS:
            runs.append((first, common + second - first, second - first))

    for a, b, common in zip(order[edges].tolist(), order[edges + 1].tolist(), shared[edges].tolist(), strict=True):
        small, large = class_of(a), class_of(b)
        if classes[small].size > classes[large].size:
            small, large = large, small
        parent[small] = large
        moved, kept = list(classes.pop(small)), classes[large]
        reach = common // (LEAST_REPEATS - 1)
        for at, position in enumerate(moved):
            below, above = kept.around(position)
            if below is not None and position - below <= reach and (at == 0 or moved[at - 1] < below):
                seed(below, position, common)
            if above is not None and above - position <= reach and (at + 1 == len(moved) or moved[at + 1] > above):
                seed(position, above, common)
        for position in moved:
            kept.add(position)
    return sorted(runs, key=lambda run: (run[0], run[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length / period; of equal ones the first, then that of the least period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def repetitions(count: int, runs: list[Run]) -> np.ndarray:
    """Which of ``count`` words lie in a run after its first period."""
    change = np.zeros(count + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:count] > 0


def suspects(texts: list[bytes]) -> np.ndarray:
    """Whether some window of ``SHARED`` words occurs twice in a text, for each text. Equal hashes count as equal."""
    hashes, lengths = hash_words(texts)
    found = np.zeros(len(texts), bool)
    windows = rolling(hashes, SHARED)
    owner = np.repeat(np.arange(len(texts)), lengths)
    whole = owner[: len(windows)] == owner[SHARED - 1 :][: len(windows)]
    windows, owner = windows[whole], owner[: len(whole)][whole]
    with np.errstate(over="ignore"):
        keys = windows + mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    found[owner[order][1:][same]] = True
    return found


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words under equal numbers, from 1."""
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(word, len(numbers) + 1) for word in words], np.int64)


def _compute() -> Callable[[list[str]], list[pa.Array]]:
    def compute(texts: list[str]) -> list[pa.Array]:
        data = [text.encode("utf-8", "surrogatepass") for text in texts]
        counts, found, best, collapsed = [], [], [], []
        for text, suspect in zip(data, suspects(data).tolist(), strict=True):
            words = text.split()  # bytes: at ASCII white space
            runs = runs_of(numbered(words)) if suspect else []
            counts.append(len(words))
            found.append([dict(zip(("start", "length", "period"), run, strict=True)) for run in runs])
            top = strongest(runs)
            best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
            if runs:
                gone = repetitions(len(words), runs).tolist()
                words = [word for word, out in zip(words, gone, strict=True) if not out]
            collapsed.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return [
            pa.array(counts, pa.int64()),
            pa.array(found, pa.list_(RUN)),
            pa.array(best, RUN),
            pa.array(collapsed, pa.string()),
        ]

    return compute


def find_runs(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``n_words``, ``runs`` (structs start, length, period, by start and then period), ``strongest``
    (the run with the greatest length / period, NULL without a run) and ``collapsed`` (the text's words without
    the repetitions, joined by single spaces).

    Positions are word numbers from 0. A NULL, empty or blank text has no words, no runs and an empty ``collapsed``. Every row
    is judged by itself, repeated rows and rows without an id too. Columns with the added names are replaced. No shuffle.
    """
    return add_columns(documents, text, _compute, ADDED)
