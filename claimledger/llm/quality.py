"""Document quality by pairwise ranking.

Each text becomes a row of features (character classes, repetition, word statistics). A Bradley-Terry model learns a weight
per feature from preference pairs, a document labelled 1 over one labelled 0: the chance that a is
preferred to b is the logistic of w . (x_a - x_b). A document's rank score is w . x; it is accepted above a quantile of
the labelled documents' scores, the one that decides best between their labels.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.llm.common import add_columns, text_slices

# Labelled documents to learn from, at most, for each label, and pairs drawn from them.
MAX_PER_LABEL = 2_000
PAIRS = 40_000
RIDGE = 1e-4

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEATURES = (
    "upper", "lower", "digit", "space", "line_end", "non_ascii", "control", "repeated",
    *(f"char_{ord(c)}" for c in PUNCTUATION),
    "log_words", "word_length", "long_words", "distinct_words", "top_word", "distinct_lines", "line_words",
    "capital_words", "upper_words", "word_punctuation", "symbol_words", "distinct_pairs", "empty",
)
N_BYTE_FEATURES = 8 + len(PUNCTUATION)

# Class of each byte, as a column of the byte features; counts of a class come from one histogram per text.
_CLASS = np.full((256, N_BYTE_FEATURES), 0.0)
_CLASS[ord("A") : ord("Z") + 1, 0] = _CLASS[ord("a") : ord("z") + 1, 1] = _CLASS[ord("0") : ord("9") + 1, 2] = 1
_CLASS[[32, 9], 3] = _CLASS[[10, 13], 4] = 1
_CLASS[128:, 5] = 1
_CLASS[:9, 6] = _CLASS[14:32, 6] = _CLASS[127, 6] = 1
for _number, _character in enumerate(PUNCTUATION):
    _CLASS[ord(_character), 8 + _number] = 1


def features(text: str) -> np.ndarray:
    """The features of one text, as in ``FEATURES``. Rates, so that length alone decides little."""
    out = np.zeros(len(FEATURES))
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = text.split()
    if not words:
        out[-1] = 1
        return out
    out[:N_BYTE_FEATURES] = np.bincount(data, minlength=256) @ _CLASS / len(data)
    out[7] = np.count_nonzero(data[1:] == data[:-1]) / len(data)
    lines = [line for line in text.split("\n") if line.strip()]
    count = len(words)
    tally: dict[str, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    weights = np.fromiter(tally.values(), float, len(tally))
    kinds = np.array(
        [(len(w), w[0].isupper(), w.isupper() and len(w) > 1, not w[-1].isalnum(), not any(map(str.isalnum, w))) for w in tally],
        float,
    )
    pairs = len(set(zip(words, words[1:], strict=False))) / (count - 1) if count > 1 else 1
    length, capital, upper, ends, symbol = (weights @ kinds / count).tolist()
    out[N_BYTE_FEATURES:] = (
        np.log1p(count), length, weights @ (kinds[:, 0] > 20) / count, len(tally) / count, weights.max() / count,
        len(set(lines)) / len(lines), np.log1p(count / len(lines)), capital, upper, ends, symbol, pairs, 0,
    )
    return out


@dataclass(frozen=True)
class RankModel:
    """Weights over standardized features, and the score at which a document is accepted."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float
    quantile: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 and more is accepted."""
        ranks = self._standard(rows) @ self.weights
        return 1 / (1 + np.exp(-np.clip((ranks - self.threshold) / self.scale, -500, 500)))

    def _standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.spread, -8, 8)


def fit_ranking(rows: np.ndarray, labels: np.ndarray, seed: int = 7) -> RankModel:
    """Learn from feature rows and 0/1 labels. With one label only, everything is scored as that label."""
    width = rows.shape[1] if rows.size else len(FEATURES)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        sure = 1e6 if len(bad) else -1e6
        return RankModel(np.zeros(width), np.ones(width), np.zeros(width), sure, 1.0, float(bool(len(bad))))
    centre, spread = rows.mean(0), rows.std(0) + 1e-6
    x = np.clip((rows - centre) / spread, -8, 8)
    draw = np.random.default_rng(seed)
    difference = x[draw.choice(good, PAIRS)] - x[draw.choice(bad, PAIRS)]
    weights = np.zeros(width)
    for _ in range(25):  # Newton steps on the pairwise logistic loss
        chance = 1 / (1 + np.exp(-np.clip(difference @ weights, -500, 500)))
        gradient = difference.T @ (chance - 1) / PAIRS + RIDGE * weights
        curve = (difference * (chance * (1 - chance))[:, None]).T @ difference / PAIRS
        step = np.linalg.solve(curve + (RIDGE + 1e-6) * np.eye(width), gradient)
        weights -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-4:
            break
    ranks = x @ weights
    levels = np.linspace(0.002, 0.998, 499)
    cuts = np.quantile(ranks, levels)
    right = [np.sum((ranks >= cut) == (labels == 1)) for cut in cuts]
    best = int(np.argmax(right))
    # The cut may lie anywhere between the neighbouring scores; the middle leaves room on both sides.
    below, above = ranks[ranks < cuts[best]], ranks[ranks >= cuts[best]]
    threshold = (below.max() + above.min()) / 2 if len(below) and len(above) else float(cuts[best])
    return RankModel(centre, spread, weights, float(threshold), float(ranks.std() + 1e-9), float(levels[best]))


def labelled(documents: DataFrame, labels: DataFrame, label: str, per_label: int = MAX_PER_LABEL) -> DataFrame:
    """At most ``per_label`` documents for each label (0, 1), the same ones each time: those whose ids hash lowest.

    An id with labels that contradict each other is left out.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("_other"))
        .where(F.col("label") == F.col("_other"))
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    chosen = [known.where(F.col("label") == value).orderBy("_order", "doc_id").limit(per_label) for value in (0, 1)]
    wanted = chosen[0].union(chosen[1]).select("doc_id", "label")
    # At most 2 * per_label rows of two numbers: small enough to send to every task.
    return documents.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"])


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = MAX_PER_LABEL) -> RankModel:
    """Learn from a bounded sample of the labelled documents. Only their features reach the driver."""
    names = "label int, x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                rows = pa.array([features(t).tolist() for t in texts], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("label"), rows], ["label", "x"])

    sample = labelled(documents, labels, label, per_label).select("label", "text").mapInArrow(run, names)
    rows = sorted((r.label, *r.x) for r in sample.collect())
    x = np.array([r[1:] for r in rows]).reshape(-1, len(FEATURES))
    return fit_ranking(x, np.array([r[0] for r in rows]))


def score(documents: DataFrame, model: RankModel, text: str = "text") -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on). NULL texts score as empty ones.

    No shuffle; columns called ``score`` or ``predicted`` are replaced. Repeated rows get equal scores.
    """
    given = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        def compute(texts: list[str]) -> list[pa.Array]:
            rows = np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))
            scores = given.value.scores(rows)
            return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

        return compute

    return add_columns(documents, text, make, "score double, predicted int")


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the ranking accepts, with their own columns."""
    names = {c: f"_own_{c}" for c in documents.columns}
    scored = score(documents.withColumnsRenamed(names), train(documents, labels), "_own_text")
    return scored.where(F.col("predicted") == 1).select([F.col(f"_own_{c}").alias(c) for c in documents.columns])
