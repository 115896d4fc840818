"""Ranked lexical search: the documents with the greatest integer scores for each query text, all documents looked at.

A document is a vector of impacts, one for each term of the queries that it holds:
``(1000000000 * tf) div (1000 * tf + 8 * m)``, where ``m`` grows with its number of terms. A query is a vector of term weights
times how often the query repeats the term, and the score is their inner product.

Impact vectors are ordered by length (norm) over the whole table, range-partitioned and stored in that order, and searched
from the longest on in rounds. Arrow batches of ordered rows are the norm buckets. For a query with threshold t (its
``top``-th best score so far):

* a bucket, or the rest of it, is skipped where |query| * |document| < t (Cauchy-Schwarz); a round reads
  no rows below the least length at which some query's threshold can still be met, which prunes row groups of the stored table;
* within a bucket, the query's few largest coordinates are added up exactly, and the other coordinates are bounded by what
  is left of both lengths. Only documents whose bound reaches t are scored in full, in 64-bit integers.

Bounds are floating-point with a margin and decide only what is scored; scores and their order are exact.

Queries go in blocks of at most about ``QUERY_BYTES`` of text; only a block's terms, weights and thresholds are on the driver
and at the workers. Document statistics cover all documents. A worker returns at most ``top`` rows for each query of the
block and task.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from claimledger.llm.common import stored, text_slices

TOP = 10
QUERY_BYTES = 2_000_000
# Documents of the first rounds: the longest vectors, as shares of all.
ROUNDS = (0.02, 0.2, 1.0)
# Coordinates that are added up before the rest is bounded.
FOCUS = 6
# Bounds are computed in doubles: a bound this much over its value is safe.
MARGIN = 1e-9
#: About so many bytes of vectors in a partition of the ordered table.
PARTITION_BYTES = 64 * 1024 * 1024

_VECTOR = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
_IMPACT = "doc_id bigint, length double, terms array<int>, impacts array<bigint>"
_HIT = "query int, doc_id bigint, score bigint"

# Terms are runs of ASCII letters and digits and of anything beyond ASCII; only A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass(frozen=True)
class Queries:
    """A block of queries: each one's terms (numbered over the block) and how often it repeats them."""

    keys: list[Row]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    numbers: dict[bytes, int]

    @staticmethod
    def of(rows: list[Row]) -> "Queries":
        numbers: dict[bytes, int] = {}
        terms, repeats = [], []
        for row in rows:
            own = Counter(terms_of(row.text or ""))
            terms.append(np.array([numbers.setdefault(t, len(numbers)) for t in own], np.int64))
            repeats.append(np.array(list(own.values()), np.int64))
        return Queries(rows, terms, repeats, numbers)


def count_terms(documents: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of all documents with a term: how many terms, and the queries' terms among them."""
    shared = documents.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                ids, sizes, terms, counts = [], [], [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    words = terms_of(text)
                    if not words:
                        continue
                    own = {known[word]: count for word, count in Counter(words).items() if word in known}
                    ids.append(doc_id)
                    sizes.append(len(words))
                    terms.append(list(own))
                    counts.append(list(own.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(terms, pa.list_(pa.int32())),
                        pa.array(counts, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    return documents.mapInArrow(run, _VECTOR)


def impacts(vectors: DataFrame, documents: int, terms: int) -> DataFrame:
    """(doc_id, length, terms, impacts): the documents that hold a term of the queries, as vectors with their norms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tf, owner = _flat(batch.column("counts"))
            # Python's integers: n * documents may pass 64 bits.
            m = np.array([25 + 75 * n * documents // terms for n in batch.column("n").to_pylist()], np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[owner])
            squares = np.bincount(owner, impact.astype(np.float64) ** 2, batch.num_rows)
            ends = np.cumsum(np.bincount(owner, minlength=batch.num_rows))
            lists = pa.ListArray.from_arrays(pa.array([0, *ends.tolist()], pa.int32()), pa.array(impact, pa.int64()))
            made = [batch.column("doc_id"), pa.array(np.sqrt(squares)), batch.column("terms"), lists]
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "length", "terms", "impacts"])

    return vectors.where(F.size("terms") > 0).mapInArrow(run, _IMPACT)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The items of an array of lists, and the list that each is of."""
    items = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return items, np.repeat(np.arange(len(lists)), sizes)


class Search:
    """The best documents so far of each query of a block, over buckets of rows by falling length."""

    def __init__(self, queries: list[tuple[np.ndarray, np.ndarray]], least: list[int], top: int):
        self.top = top
        self.least = list(least)
        self.found: list[list[tuple[int, bool, int]]] = [[] for _ in queries]
        self.queries = []
        for terms, weights in queries:
            order = np.argsort(-weights, kind="stable")
            terms, weights = terms[order], weights[order]
            length = math.sqrt(float((weights.astype(np.float64) ** 2).sum()))
            rest = math.sqrt(float((weights[FOCUS:].astype(np.float64) ** 2).sum()))
            self.queries.append((list(zip(terms.tolist(), weights.tolist(), strict=True)), length, rest))

    def bucket(self, batch: pa.RecordBatch) -> None:
        """Look through a bucket: (doc_id, length, terms, impacts) rows."""
        size = batch.num_rows
        length = batch.column("length").to_numpy()
        longest = float(length.max())
        ids = batch.column("doc_id").to_pylist()
        impact, owner = _flat(batch.column("impacts"))
        term, _ = _flat(batch.column("terms"))
        order = np.argsort(term, kind="stable")
        term, impact, owner = term[order], impact[order], owner[order]
        known, starts = np.unique(term, return_index=True)
        column = dict(zip(known.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(term)], strict=True), strict=True))
        for number, (coordinates, norm, rest) in enumerate(self.queries):
            least = self.least[number]
            if norm * longest * (1 + MARGIN) < least:
                continue
            score, seen = np.zeros(size, np.int64), np.zeros(size)
            for t, weight in coordinates[:FOCUS]:
                if t in column:
                    a, b = column[t]
                    score[owner[a:b]] += weight * impact[a:b]
                    seen[owner[a:b]] += impact[a:b].astype(np.float64) ** 2
            left = np.sqrt(np.maximum(length**2 * (1 + MARGIN) - seen, 0))
            bound = (score + rest * left) * (1 + MARGIN)
            maybe = np.flatnonzero((bound >= least) & (norm * length * (1 + MARGIN) >= least))
            if not len(maybe):
                continue
            for t, weight in coordinates[FOCUS:]:
                if t in column:
                    a, b = column[t]
                    score[owner[a:b]] += weight * impact[a:b]
            hits = maybe[score[maybe] >= least]
            if len(hits):
                self._add(number, [(-int(score[at]), ids[at] is None, ids[at] or 0) for at in hits.tolist()])

    def _add(self, number: int, hits: list[tuple[int, bool, int]]) -> None:
        best = sorted([*self.found[number], *hits])[: self.top]
        self.found[number] = best
        if len(best) == self.top:
            self.least[number] = max(self.least[number], -best[-1][0])

    def rows(self) -> pa.RecordBatch:
        flat = [(n, None if none else i, -s) for n, own in enumerate(self.found) for s, none, i in own]
        kinds = (("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([row[at] for row in flat], kind) for at, (_, kind) in enumerate(kinds)], [name for name, _ in kinds]
        )


def _hits(rows: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], least: list[int], top: int) -> DataFrame:
    """For each task, the best ``top`` rows of each query among those with at least its threshold."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value, top)
        for batch in batches:
            if batch.num_rows:
                search.bucket(batch)
        yield search.rows()

    return rows.mapInArrow(run, _HIT)


def _best(hits: DataFrame, by: list[Column], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(documents: DataFrame, block: list[Row], top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of a block of queries."""
    spark = documents.sparkSession
    queries = Queries.of(block)
    vectors = stored(count_terms(documents, queries.numbers))
    totals = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    held = {r.term: r["count"] for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    # In doubles, rounded down. A term that no document holds adds nothing to any score.
    weight = np.array(
        [math.floor(1000 * math.log((2 * totals.documents + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(queries.numbers))],
        np.int64,
    )
    weighed = [(t, weight[t] * r) for t, r in zip(queries.terms, queries.repeats, strict=True)]
    rows = impacts(vectors, totals.documents, totals.terms or 1)
    size = vectors.agg(F.sum(F.size("terms") * 12 + 16).cast("bigint")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES))
    longest_first = [F.desc("length"), F.asc("doc_id")]
    ordered = stored(rows.repartitionByRange(parts, *longest_first).sortWithinPartitions(*longest_first))
    cuts = ordered.agg(F.percentile_approx("length", [1 - share for share in ROUNDS[:-1]])).first()[0] or []
    found, least, below = None, [1] * len(block), math.inf
    for cut in [*cuts, -math.inf]:
        # Shorter vectors than this reach no query's threshold.
        norms = [math.sqrt(float((w.astype(np.float64) ** 2).sum())) for _, w in weighed]
        bar = min([t / (n * (1 + MARGIN)) for t, n in zip(least, norms, strict=True) if n], default=math.inf)
        here = ordered.where((F.col("length") < below) & (F.col("length") >= max(cut, bar * (1 - MARGIN))))
        hits = _hits(here, weighed, least, top)
        found = stored(_best(hits if found is None else found.unionByName(hits), [F.col("query")], top).drop("rank"))
        below = cut
        last = found.groupBy("query").agg(F.count("score").alias("hits"), F.min("score").alias("least")).collect()
        for row in last:
            if row.hits == top:
                least[row.query] = max(least[row.query], row.least)
    names = spark.createDataFrame([(n, row.item_id) for n, row in enumerate(queries.keys)], "query int, item_id bigint")
    ranked = _best(found, [F.col("query")], top).join(names, "query")
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0, best first.

    ``documents`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Equal scores rank by ascending
    doc_id, a missing id last. Every row of ``documents`` is a document, so repeated rows rank one after the other.
    Every distinct (item_id, text) is a query with ranks of its own. NULL or empty texts have no terms:
    such documents do not count and such items have no results, as with empty tables.
    """
    spark = documents.sparkSession
    wanted = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    size = wanted.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BYTES))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for number in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        block = own.orderBy("item_id", "text").collect()
        if block:
            out = out.unionByName(_search_block(texts, block, top))
    return out
