"""The warehouse load of the charge fact and the check of its contract.

The table is a folder of versions and a log that names the current one. The log holds a small file for each version, called
by its number; the greatest number is the table.
"""

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimledger.sources.schemas import F_TRANSACTIONS, F_TRANSACTIONS_FROM, F_TRANSACTIONS_KEY, typed
from claimledger.sources.storage import (
    create_file,
    delete,
    file_names,
    keep_files_open,
    modified,
    read_file,
    shuffles_removed,
)

NOT_NULL = "NOT NULL"
PRIMARY_KEY = "PRIMARY KEY"
VERSIONS = "_versions"
# Versions that are kept besides the current one.
EARLIER = 1
# So many files may a task leave without the rows being rebalanced.
FEW_PRACTICES = 8


class ContractError(ValueError):
    """The rows break the contract of the warehouse table."""


def warehouse_rows(fact: DataFrame) -> DataFrame:
    """The charge fact under the warehouse's column names, order and types."""
    named = fact.select([F.col(source).alias(target) for target, source in F_TRANSACTIONS_FROM.items()])
    return typed(named, F_TRANSACTIONS)


class LoadConflict(RuntimeError):
    """Another load made its version the table while this one was running."""


def _nulls(rows: DataFrame) -> list:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns]


def _possible_nulls(rows: DataFrame) -> list:
    """The same without the columns that cannot be NULL by their type: an amount is dear to look at."""
    nullable = [f.name for f in rows.schema.fields if f.nullable]
    return _nulls(rows.select(nullable)) or [F.count(F.lit(1)).alias("rows")]


def _repeated_keys(rows: DataFrame) -> DataFrame:
    """How many key values occur more than once. Shuffles the key alone."""
    return (
        rows.where(F.col(F_TRANSACTIONS_KEY).isNotNull())
        .groupBy(F_TRANSACTIONS_KEY)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.count_if(F.col("copies") > 1).alias("violations"))
    )


def _repeated_hashes(rows: DataFrame) -> DataFrame:
    """How many hashes of the key occur more than once; if none does, no key does. Shuffles eight bytes a row."""
    hashes = rows.where(F.col(F_TRANSACTIONS_KEY).isNotNull()).select(F.xxhash64(F_TRANSACTIONS_KEY).alias("hash"))
    return hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("copies")).agg(F.count_if(F.col("copies") > 1).alias("violations"))


def contract_violations(rows: DataFrame) -> DataFrame:
    """One row per rule: NULLs per required column, and how many key values occur more than once.

    Reads ``rows`` twice, so give it a stored table; ``store_checked`` counts the NULLs while it writes one.
    """
    required = (
        rows.agg(*_nulls(rows))
        .unpivot([], rows.columns, "column_name", "violations")
        .select(F.lit(NOT_NULL).alias("rule"), "column_name", "violations")
    )
    repeated = _repeated_keys(rows).select(
        F.lit(PRIMARY_KEY).alias("rule"), F.lit(F_TRANSACTIONS_KEY).alias("column_name"), "violations"
    )
    return required.union(repeated)


def store_checked(rows: DataFrame, folder: str, by: Sequence[str] = ("Practice_ID",)) -> list[tuple[str, str, int]]:
    """Write warehouse rows to ``folder``, in folders by ``by``, and return the rules with their violations, those
    without any too.

    NULLs are counted on the way to the files, in the stage that writes them, where a task that is
    repeated counts once. Only the key is read again: its hashes, and the keys themselves if a hash occurs twice.

    The shuffle files of the fact go when it is written, before the key or the table is read.
    """
    spark = rows.sparkSession
    keep_files_open(spark)
    seen = Observation()
    with shuffles_removed(spark):
        rows.observe(seen, *_possible_nulls(rows)).write.partitionBy(*by).parquet(folder)
    nulls = seen.get
    written = spark.read.schema(F_TRANSACTIONS).parquet(folder)
    found = [(NOT_NULL, c, nulls.get(c) or 0) for c in rows.columns]
    with shuffles_removed(spark):
        repeated = _repeated_hashes(written).first().violations and _repeated_keys(written).first().violations
    return [*found, (PRIMARY_KEY, F_TRANSACTIONS_KEY, repeated)]


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers in the log, newest first."""
    return sorted((int(name) for name in file_names(spark, f"{path}/{VERSIONS}") if name.isdigit()), reverse=True)


def _entry(path: str, number: int) -> str:
    return f"{path}/{VERSIONS}/{number:012d}"


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The warehouse table as last loaded. The declared schema keeps practice ``0001`` as text."""
    numbers = _versions(spark, path)
    if not numbers:
        raise ValueError(f"no load has made a table at {path}")
    folder = read_file(spark, _entry(path, numbers[0]))
    return typed(spark.read.schema(F_TRANSACTIONS).parquet(f"{path}/{folder}"), F_TRANSACTIONS)


def load_fact(fact: DataFrame, path: str, practices: int | None = None) -> DataFrame:
    """Replace the warehouse table at ``path`` by ``fact``, or raise and leave it as it is.

    The rows are computed and written once, into a version folder of their own; NULLs are counted meanwhile and the key is
    checked there. Only then is the next number claimed: its file in the log, which names the folder, must not exist
    yet and appears whole. Until then, readers see the version before.

    Loads may run at a time. The number is the one after that seen when a load began, so of several loads
    that began at the same version one becomes the table, and the others raise ``LoadConflict`` and delete their
    folders. The log and the folders are cut down to the current version and ``EARLIER`` ones; a number that has been cut
    away and is claimed by a slow load is given back, as greater ones exist.

    Rebalancing splits a practice with many rows over several files and keeps small practices from leaving many small ones.
    ``practices`` says how many there are at most, if that is known: with ``FEW_PRACTICES`` or fewer, the rows are written
    where they are, a file per task and practice, and do not move for it.
    """
    spark = fact.sparkSession
    number = next(iter(_versions(spark, path)), 0) + 1
    folder = f"version-{uuid.uuid4().hex}"
    rows = warehouse_rows(fact)
    if practices is None or practices > FEW_PRACTICES:
        rows = rows.hint("rebalance", "Practice_ID")
    broken = [rule for rule in store_checked(rows, f"{path}/{folder}") if rule[2]]
    if broken:
        delete(spark, f"{path}/{folder}")
        raise ContractError("; ".join(f"{rule} {column}: {count}" for rule, column, count in broken))
    commit(spark, path, folder, number)
    return read_fact(spark, path)


def commit(spark: SparkSession, path: str, folder: str, number: int) -> None:
    """Make a version folder the table under a number of its own, or delete it and raise ``LoadConflict``."""
    claimed = create_file(spark, _entry(path, number), folder)
    numbers = _versions(spark, path)
    if not claimed or numbers[0] > number:
        if claimed and number not in numbers[: EARLIER + 1]:
            delete(spark, _entry(path, number))
        if not claimed or number not in numbers[: EARLIER + 1]:
            delete(spark, f"{path}/{folder}")
            raise LoadConflict(f"another load has made version {max(numbers[0], number)} of {path}")
    for old in numbers[EARLIER + 1 :]:
        gone = read_file(spark, _entry(path, old))
        delete(spark, _entry(path, old))
        delete(spark, f"{path}/{gone}")


def remove_leftovers(spark: SparkSession, path: str, hours: float = 24) -> list[str]:
    """Delete version folders that no log entry names and that are older than ``hours``: what broken-off loads left."""
    named = {read_file(spark, _entry(path, number)) for number in _versions(spark, path)}
    old = time.time() - hours * 3600
    left = [
        name
        for name in file_names(spark, path)
        if name.startswith("version-") and name not in named and modified(spark, f"{path}/{name}") < old
    ]
    for name in left:
        delete(spark, f"{path}/{name}")
    return left
