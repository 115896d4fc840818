"""Benchmark passages in documents, within an edit budget.

Each benchmark item is cut into patterns of ``PATTERN_CHARS`` characters that start every ``PATTERN_STEP`` characters, and
one at its end (a shorter item is one pattern).
A region of a document matches a pattern of m characters if at most k = floor(rate * m) insertions, deletions or
replacements turn one into the other. By the q-gram lemma such a region shares at least m - q + 1 - k * q of the
pattern's q-grams, and all of them lie on k + 1 neighbouring diagonals (position in the document minus position
in the pattern). So:

1. every document position's q-gram is hashed and looked up among the benchmark's q-grams;
2. the hits are counted per document, pattern and diagonal band; bands are 2(k + 1) wide and overlap by half, so every
   k + 1 neighbouring diagonals lie in one;
3. bands that reach the bound are kept and verified by an alignment within the band.

The index holds each position of an item once; the patterns around a hit follow from its position.
Letters are compared in lower case and every kind of white space as a space; positions are not moved by that.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.llm.common import stored, text_slices

Q = 12
PATTERN_CHARS = 80
PATTERN_STEP = 8
EDIT_RATE = 0.05
# Items shorter than this are no passages and are not looked for.
MIN_CHARS = 24

# The benchmark goes to the tasks in parts of at most so much text; each part is one pass over the documents.
PART_BYTES = 16 * 1024 * 1024

# Hits of a text that are counted at a time, and the positions that are taken at least.
CHUNK_HITS = 1 << 20
CHUNK_CHARS = 1024

FOUND = "item_id bigint, start bigint, end bigint, n_patterns int, n_edits int"
_MULTIPLIER = 0x9E3779B1
_TABLE_BITS = 22


_ASCII = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def folded(text: str) -> np.ndarray:
    """The code points of a text in lower case, white space as spaces, one for each character of the text."""
    if text.isascii():
        return np.frombuffer(text.encode("ascii").translate(_ASCII), np.uint8).astype(np.uint32)
    low = text.lower()
    if len(low) != len(text):  # a few letters become two
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    points[((points >= 9) & (points <= 13)) | (points == 0xA0)] = 32
    return points


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """A hash of the ``Q`` code points from each position on: polynomial hashes of 2, 4, 8 and 12 of them, mixed."""
    if len(points) < Q:
        return np.empty(0, np.uint32)

    def joined(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
        count = len(right)
        return left[:count] * np.uint32(pow(_MULTIPLIER, width, 1 << 32)) + right

    two = joined(points, points[1:], 1)
    four = joined(two, two[2:], 2)
    eight = joined(four, four[4:], 4)
    value = joined(eight, four[8:], 4)
    value ^= value >> np.uint32(15)
    value *= np.uint32(0x85EBCA6B)
    value ^= value >> np.uint32(13)
    return value


class Patterns:
    """The patterns of some benchmark items and an index of the items' q-grams."""

    def __init__(self, items: list[tuple[int | None, str]], edit_rate: float):
        folds = [(item, folded(text.strip())) for item, text in items]
        folds = [(item, points) for item, points in folds if len(points) >= MIN_CHARS]
        self.ids = [item for item, _ in folds]
        self.texts = [points for _, points in folds]
        length = np.array([len(points) for points in self.texts], np.int64)
        # Where an item's last pattern starts, how many start before it, and the number of its first.
        self.last = np.maximum(length - PATTERN_CHARS, 0)
        self.before = -(-self.last // PATTERN_STEP)
        self.first = np.cumsum(self.before + 1) - self.before - 1
        self.size = np.minimum(length, PATTERN_CHARS)
        self.budget = np.floor(self.size * edit_rate).astype(np.int64)
        self.bound = np.maximum(self.size - Q + 1 - self.budget * Q, 1)
        grams = [gram_hashes(points) for points in self.texts]
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint32)
        order = np.argsort(flat, kind="stable")
        self.hashes = flat[order]
        counts = np.array([len(g) for g in grams], np.int64)
        self.owners = np.repeat(np.arange(len(grams), dtype=np.int32), counts)[order]
        self.places = (np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)[order]
        self.known = np.zeros(1 << _TABLE_BITS, bool)
        self.known[self.hashes >> np.uint32(32 - _TABLE_BITS)] = True

    def item_of(self, pattern: int) -> int:
        """The place of a pattern's item."""
        return int(np.searchsorted(self.first, pattern, "right")) - 1

    def points(self, pattern: int) -> np.ndarray:
        item = self.item_of(pattern)
        start = min((pattern - int(self.first[item])) * PATTERN_STEP, int(self.last[item]))
        return self.texts[item][start : start + PATTERN_CHARS]

    def _around(self, at: np.ndarray, owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, pattern, diagonal) for every pattern that holds the q-gram of a hit."""
        span = self.size[owner] - Q  # the last place of a gram in a pattern
        made = []
        for step in range(PATTERN_CHARS // PATTERN_STEP + 1):
            number = place // PATTERN_STEP - step
            start = number * PATTERN_STEP
            inside = np.flatnonzero((number >= 0) & (number < self.before[owner]) & (place - start <= span))
            made.append((at[inside], self.first[owner[inside]] + number[inside], at[inside] - place[inside] + start[inside]))
        inside = np.flatnonzero(place >= self.last[owner])
        whose = owner[inside]
        made.append((at[inside], self.first[whose] + self.before[whose], at[inside] - place[inside] + self.last[whose]))
        return tuple(np.concatenate(column) for column in zip(*made, strict=True))

    def _bands(self, at: np.ndarray, low: np.ndarray, count: np.ndarray) -> np.ndarray:
        """(pattern, band) of the bands that reach the bound."""
        at = np.repeat(at, count)
        entry = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        at, pattern, diagonal = self._around(at, self.owners[entry], self.places[entry].astype(np.int64))
        item = np.searchsorted(self.first, pattern, "right") - 1
        upper = (diagonal + PATTERN_CHARS) // (self.budget[item] + 1)  # diagonals start below 0
        pattern, item, at = np.tile(pattern, 2), np.tile(item, 2), np.tile(at, 2)
        band = np.concatenate([upper, upper - 1])
        # Most bands hold a hit or two: only those with hits enough are counted by position.
        width = band.max(initial=0) + 2
        bands, place, hits = np.unique(pattern * width + band + 1, return_inverse=True, return_counts=True)
        enough = hits[place] >= self.bound[item]
        # The same document position counts once for a band, whatever the pattern repeats.
        place, at = place[enough], at[enough] - at.min(initial=0)
        span = at.max(initial=0) + 1
        shared = np.bincount(np.unique(place * span + at) // span, minlength=len(bands))
        kept = np.stack([bands // width, bands % width - 1], 1)
        return kept[shared >= self.bound[np.searchsorted(self.first, kept[:, 0], "right") - 1]]

    def find(self, documents: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, pattern, start, end, edits) of every verified region; a region may come twice.

        Hits are counted in chunks of the text. The hits of a band span less than two patterns, and chunks overlap by so
        much, so every band is whole in one of them.
        """
        if not len(self.hashes):
            return
        for number, points in enumerate(documents):
            grams = gram_hashes(points)
            at = np.flatnonzero(self.known[grams >> np.uint32(32 - _TABLE_BITS)])
            low = np.searchsorted(self.hashes, grams[at], "left")
            count = np.searchsorted(self.hashes, grams[at], "right") - low
            at, low, count = at[count > 0], low[count > 0], count[count > 0]
            total = np.cumsum(count)
            begin = 0 if len(at) >= self.bound.min() else len(at)
            while begin < len(at):
                most = np.searchsorted(total, total[begin] - count[begin] + CHUNK_HITS, "right")
                end = max(int(most), int(np.searchsorted(at, at[begin] + CHUNK_CHARS, "left")))
                for pattern, band in self._bands(at[begin:end], low[begin:end], count[begin:end]).tolist():
                    k = int(self.budget[self.item_of(pattern)])
                    first = band * (k + 1) - PATTERN_CHARS
                    found = verified(self.points(pattern), points, first, first + 2 * (k + 1) - 1, k)
                    if found:
                        yield number, pattern, *found
                if end >= len(at):
                    break
                begin = max(begin + 1, int(np.searchsorted(at, at[end] - 2 * PATTERN_CHARS, "left")))


def verified(pattern: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """What ``banded_alignment`` gives; without it where the text holds the pattern as it is."""
    for start in range(max(low, 0), min(high, len(text) - len(pattern)) + 1):
        if text[start] == pattern[0] and np.array_equal(text[start : start + len(pattern)], pattern):
            return start, start + len(pattern), 0
    return banded_alignment(pattern, text, low, high, budget)


def banded_alignment(
    pattern: np.ndarray, text: np.ndarray, low: int, high: int, budget: int
) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best match of the whole pattern, the text offset minus the pattern offset kept
    within ``low`` to ``high``; None if it takes more than ``budget`` edits. Among equals, the first end is taken.
    """
    far = len(pattern) + len(text) + 1
    width = high - low + 1
    slots = np.arange(width)
    # cost[d]: edits for the pattern so far, ending before text position (pattern position + low + d)
    ends = slots + low
    cost = np.where((ends >= 0) & (ends <= len(text)), 0, far)
    origin = ends.copy()
    padded = np.full(len(pattern) + width + 1, -1, np.int64)
    take = np.arange(low, low + len(padded))
    inside = (take >= 0) & (take < len(text))
    padded[inside] = text[take[inside]]
    for row in range(len(pattern)):
        step = cost + (padded[row : row + width] != pattern[row])  # both move: same diagonal
        skip = np.append(cost[1:] + 1, far)  # pattern moves alone: one diagonal down
        came = np.where(step <= skip, origin, np.append(origin[1:], 0))
        best = np.minimum(step, skip)
        ends = slots + low + row + 1
        best = np.where((ends >= 0) & (ends <= len(text)), best, far)
        run = np.minimum.accumulate(best - slots)  # text moves alone: one diagonal up
        source = np.maximum.accumulate(np.where(best - slots == run, slots, 0))
        cost, origin = run + slots, came[source]
    end = int(np.argmin(cost))
    if cost[end] > budget:
        return None
    return int(origin[end]), len(pattern) + low + end, int(cost[end])


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    edit_rate: float = EDIT_RATE,
) -> DataFrame:
    """One row per document and benchmark item that it holds a passage of.

    ``start`` and ``end`` (code points, end exclusive) span all matching patterns, ``n_patterns`` counts them and
    ``n_edits`` is the fewest edits of one. A passage of ``PATTERN_CHARS + PATTERN_STEP - 1`` characters, wherever it
    begins in its item, always holds a whole pattern. NULL or empty texts hold and are nothing; items under ``MIN_CHARS`` characters are not looked
    for; repeated document rows each give their rows, repeated items count once; NULL ids are kept as they are. The
    documents are read once per part of the benchmark and are not shuffled. Where there are several parts, the hits
    of one are written before the next is sent, so the driver and the workers hold one part at a time.
    """
    narrow = documents.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return _found(narrow, benchmark, edit_rate)


def _found(narrow: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE) -> DataFrame:
    """``contaminated`` for (doc_id of any type, text)."""
    if not 0 <= edit_rate < 1 / Q:
        raise ValueError(f"the lemma bounds nothing from an edit rate of 1/{Q} on")
    spark = narrow.sparkSession
    items = (
        benchmark.where(F.col("text").isNotNull())
        .groupBy("item_id", "text")
        .agg(F.first(F.octet_length("text")).alias("size"))
    )
    total = items.agg(F.sum("size")).first()[0] or 0
    n_parts = max(1, -(-2 * total // PART_BYTES))
    parts = items.select(F.col("item_id").cast("bigint"), "text", F.pmod(F.xxhash64("text"), F.lit(n_parts)).alias("part"))
    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, {FOUND}"
    found = None
    for part in range(n_parts):
        here = [(r.item_id, r.text) for r in parts.where(F.col("part") == part).collect()]
        given = spark.sparkContext.broadcast(here)
        rows = narrow.mapInArrow(_search(given, uuid.uuid4().hex, edit_rate), schema)
        if n_parts > 1:
            rows = stored(rows)
            given.destroy()
        found = rows if found is None else found.union(rows)
    return found


# The patterns that this worker process made last, and the name of their part.
_made: dict[str, Patterns] = {}


def _patterns(name: str, given, edit_rate: float) -> Patterns:
    """The patterns of a part, made once for all tasks of a worker process."""
    if name not in _made:
        _made.clear()
        _made[name] = Patterns(given.value, edit_rate)
    return _made[name]


def _search(given, name: str, edit_rate: float):
    names = ["doc_id", *(field.split()[0] for field in FOUND.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _patterns(name, given, edit_rate)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                hits: dict[tuple[int, int | None], list] = {}
                for number, pattern, start, end, edits in patterns.find([folded(t) for t in texts]):
                    hit = hits.setdefault((number, patterns.ids[patterns.item_of(pattern)]), [start, end, set(), edits])
                    hit[0], hit[1], hit[3] = min(hit[0], start), max(hit[1], end), min(hit[3], edits)
                    hit[2].add(pattern)
                rows = [(n, item, h[0], h[1], len(h[2]), h[3]) for (n, item), h in sorted(hits.items(), key=repr)]
                if rows:
                    places, *columns = zip(*rows, strict=True)
                    kinds = [pa.int64()] * 3 + [pa.int32()] * 2
                    told = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(places)), *told], names)

    return run


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a passage of the benchmark. Rows without ``doc_id`` are judged by their text, which is known by
    its SHA-256, so no clean document goes with another one.
    """
    key = "_row_key"
    keyed = documents.withColumn(key, F.sha2(F.col("text").cast("binary"), 256))
    rows = _found(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark)
    return keyed.join(rows.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(documents.columns)
