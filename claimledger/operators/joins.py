"""Key joins that stay balanced when one key holds a large share of the rows.

Every join of the jobs looks up at most one row per key. Three cases, decided on measured sizes:

* no key is hot: a plain equi-join. Spark broadcasts the looked-up side below its own size limit,
  and no shuffle partition can be burdened by one key;
* some keys are hot, and the looked-up side is small: it is broadcast, and nothing is shuffled;
* some keys are hot, and the side is large: only the rows of hot keys are cut into slices, and only
  the single row of each hot key is repeated per slice on the other side.

Slicing changes where rows are joined, never which rows come out.
"""

import math
from collections.abc import Callable, Sequence
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A side is broadcast only up to both bounds.
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Bytes counted per value on top of the length of text.
FIXED_WIDTH = 16

# A looked-up side of more rows is hashed, and neither side of the join sorted, if the share of one shuffle partition is
# within this size: a hash table cannot spill. Bytes of a text, if its rows are counted but not its bytes.
HASHED_ROWS = 100_000
HASHED_BYTES = 256 * 1024 * 1024
TEXT_WIDTH = 32

# Rows of a key that one task should take. A key with more is hot and cut into slices of so many rows. So there are
# at most rows / SLICE_ROWS hot keys, a million (16 MB) for 1e12 rows.
SLICE_ROWS = 1_000_000

# Keys are counted on a sample that holds about so many rows of a key at the limit: its count is then within a few
# times a tenth. A key counts as hot from EARLY of the limit on, unless the sample is the whole table.
SAMPLES = 128
EARLY = 0.75
SEED = 20_240

# Tables of at most so many bytes, by Spark's statistics, are counted before they are measured (footers only).
SMALL_BYTES = 64 * 1024 * 1024

HotKeys = list[tuple[int, int]]

# Rows with a NULL key match nothing. All of them count as one key, and slices of it cost nothing on the other side.
NULL_KEY = 0
_ALL_ROWS = -1


def least_row(columns: Sequence[str]) -> Column:
    """An aggregation: the least row by ``columns``, NULL last, as a struct that has them."""
    order = [part for c in columns for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    return F.min(F.struct(*order))


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the least by its other columns, NULL last. Rows with a NULL key never match and go.

    An update from several matches keeps any one of them; a fixed choice makes the result repeatable.
    """
    rest = [c for c in df.columns if c not in keys]
    df = df.dropna(subset=list(keys))
    if not rest:
        return df.distinct()
    least = df.groupBy(*keys).agg(least_row(rest).alias("row"))
    return least.select(*keys, *[F.col("row")[c].alias(c) for c in rest])


def small_files(df: DataFrame) -> bool:
    """Whether what ``df`` reads is small, by Spark's statistics. No bound on its rows: they may compress well."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SMALL_BYTES


class Side:
    """The looked-up side of a join: ``rows`` holds one row per key.

    ``probe`` is what its size is judged by: a table with the same text columns, at least as many
    rows, and cheap to count, or the ``KeyUse`` of such a table, whose rows are counted once. It is looked at only
    when it decides something.
    """

    def __init__(self, rows: DataFrame, probe: "DataFrame | KeyUse", original: "Side | None" = None):
        self.rows = rows
        self.probe = probe
        self.original = original

    @cached_property
    def small(self) -> bool:
        """Whether the side is within the broadcast bounds. A plain Parquet count reads footers only."""
        if self.original is not None:
            return self.original.small
        measured = isinstance(self.probe, KeyUse)
        df = self.probe.df if measured else self.probe
        fields = self.rows.schema.fields
        texts = [f.name for f in fields if isinstance(f.dataType, StringType) and f.name in df.columns]
        text = [F.coalesce(F.octet_length(name), F.lit(0)) for name in texts]
        size = F.sum(sum(text, F.lit(0)).cast("bigint"))
        if not measured and small_files(df):
            count, text_bytes = df.agg(F.count(F.lit(1)), size).first()
        else:
            count = self.probe.rows if measured else df.count()
            if count > MAX_BROADCAST_ROWS:
                return False
            text_bytes = df.agg(size).first()[0]
        total = (text_bytes or 0) + count * FIXED_WIDTH * len(fields)
        return count <= MAX_BROADCAST_ROWS and total <= MAX_BROADCAST_BYTES

    def broadcast(self) -> "Side":
        """The same side, for broadcast in joins without hot keys too."""
        return Side(F.broadcast(self.rows), self.probe, original=self)

    def renamed(self, names: dict[str, str]) -> "Side":
        """The same side for another role."""
        return Side(self.rows.withColumnsRenamed(names), self.probe, original=self)


def hashed(rows: DataFrame, count: int, tables: int = 1, few: bool = False) -> DataFrame:
    """``rows``, at most ``count`` and one per key, marked to be hashed in a join without hot keys, if they fit.

    ``tables`` says how many sides are joined on the same key, as a task holds all their hash tables together. ``few``
    rows are hashed too only if it is said.
    """
    fields = rows.schema.fields
    width = FIXED_WIDTH * len(fields) + TEXT_WIDTH * sum(isinstance(f.dataType, StringType) for f in fields)
    share = tables * count * width / int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.hint("shuffle_hash") if (few or count > HASHED_ROWS) and share <= HASHED_BYTES else rows


def keyed(df: DataFrame, keys: Sequence[str]) -> Side:
    return Side(one_per_key(df, keys), df)


def _key_hash(keys: Sequence[str]) -> Column:
    """One number per key."""
    return F.when(_missing(keys), F.lit(NULL_KEY)).otherwise(F.xxhash64(*keys))


def _missing(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(key).isNull() for key in keys])


class KeyUse:
    """How the rows of a table spread over their keys, measured when first asked for.

    The table stands for the left side of a join: it has its key columns and, up to copies and rows
    that were filtered out, its rows, without all that was joined on since.

    ``key_sets`` names the sets of columns that will be asked for. All of them and the number of rows are measured in one
    scan and one aggregation, and kept.
    """

    def __init__(self, df: DataFrame, *key_sets: Sequence[str]):
        self.df = df
        self.key_sets = [tuple(keys) for keys in key_sets]
        self._hot: dict[tuple[str, ...], HotKeys] = {}
        self._rows: int | None = None

    @property
    def rows(self) -> int:
        if self._rows is None:
            if not self.key_sets or small_files(self.df):
                self._rows = self.df.count()
            else:
                self._measure()
        return self._rows

    def hot(self, *keys: str) -> HotKeys:
        """The hot keys as (key hash, number of slices); none for a table that a single task can take.

        The counts come from a sample of the rows and only steer the slicing, so neither their error nor a hash
        collision can change a result.
        """
        if keys not in self.key_sets:
            self.key_sets.append(keys)
        if keys not in self._hot:
            if self._rows is None and small_files(self.df):
                self._rows = self.df.count()
            if self._rows is not None and self._rows <= SLICE_ROWS:
                return []
            self._measure()
        return self._hot[keys]

    def _measure(self) -> None:
        """Count the rows, and the sampled rows of every key, in one aggregation, added up before the shuffle."""
        share = min(1.0, SAMPLES / SLICE_ROWS)
        limit = SLICE_ROWS * (1.0 if share == 1.0 else EARLY)

        def entry(number: int, key: Column) -> Column:
            return F.struct(F.lit(number).alias("keys"), key.cast("bigint").alias("key"))

        # Drawn before anything else looks at the keys: ids that are built on reading are built for drawn rows alone.
        drawn = F.struct(*dict.fromkeys(c for keys in self.key_sets for c in keys))
        if share < 1.0:
            drawn = F.when(F.rand(SEED) < share, drawn)
        row = entry(_ALL_ROWS, F.lit(0))
        keys_of_row = (entry(n, _key_hash([f"drawn.{c}" for c in keys])) for n, keys in enumerate(self.key_sets))
        entries = F.when(F.col("drawn").isNull(), F.array(row)).otherwise(F.array(row, *keys_of_row))
        many = (F.col("keys") == _ALL_ROWS) | (F.col("found") > limit * share)
        rows = self.df.select(drawn.alias("drawn")).select(F.inline(entries))
        counts = rows.groupBy("keys", "key").agg(F.count(F.lit(1)).alias("found")).where(many)
        self._rows = 0
        self._hot = {keys: [] for keys in self.key_sets}
        for number, key, found in counts.collect():
            if number == _ALL_ROWS:
                self._rows = found
            else:
                self._hot[self.key_sets[number]].append((key, math.ceil(found / share / limit)))


def sliced_join(
    left: DataFrame,
    rights: Sequence[DataFrame],
    keys: Sequence[str],
    hot: HotKeys,
    spread: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join ``left`` to each of ``rights`` (one row per key) with the hot keys cut into slices.

    ``spread`` names columns that tell the rows of a hot key apart. All rights share one slicing, so
    ``left`` is shuffled once for all of them.
    """
    keys = list(keys)
    slices = F.broadcast(left.sparkSession.createDataFrame(hot, "_key bigint, _slices int"))

    def with_slices(df: DataFrame) -> DataFrame:
        marked = df.withColumn("_key", _key_hash(keys)).join(slices, "_key", "left")
        return marked.withColumn("_slices", F.coalesce("_slices", F.lit(1))).drop("_key")

    slice_of_row = F.pmod(F.xxhash64(*spread), F.col("_slices")).cast("int")
    out = with_slices(left).withColumn("_slice", slice_of_row).drop("_slices")
    for right in rights:
        every_slice = F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))
        repeated = with_slices(right).withColumn("_slice", every_slice).drop("_slices")
        out = out.join(repeated, [*keys, "_slice"], how)
    return out.drop("_slice")


def lookup(
    left: DataFrame,
    sides: Side | Sequence[Side],
    keys: Sequence[str],
    hot: HotKeys,
    spread: Sequence[str],
    how: str = "left",
    collapse: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Join ``left`` to each of ``sides`` on ``keys``. No row of ``left`` comes out twice.

    ``hot`` are the hot keys of ``left`` and ``spread`` the columns that tell their rows apart.
    ``collapse`` merges the rows that agree on ``spread``; it runs only if rows are to be sliced, so
    that copies of a row, which no slicing can part, are merged before the shuffle.
    """
    keys = list(keys)
    large = []
    for side in [sides] if isinstance(sides, Side) else sides:
        if not hot:
            left = left.join(side.rows, keys, how)
        elif side.small:
            left = left.join(F.broadcast(side.rows), keys, how)
        else:
            large.append(side.rows)
    if not large:
        return left
    return sliced_join(left if collapse is None else collapse(left), large, keys, hot, spread, how)
