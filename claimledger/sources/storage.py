"""Shared folders, stored intermediate tables, small files that only one writer can create, and the bucketed layout."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from claimledger.sources.billing import Billing

# Buckets of the facts, if not said otherwise: as many as shuffle partitions, so that Spark joins by bucket.
FACTS = ("charges", "trans_detail")
FACT_KEY = ("charge_id", "practice_id")

FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 16

CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, name: str = "stored") -> str:
    """A new folder name where all executors can write: below the session's checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="claimledger-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared folder and read back, so that later steps do not redo the job."""
    folder = shared_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, a job's shuffle files go when the job is over, not when the driver happens to collect its garbage.

    For jobs whose result is stored: whoever needs a removed file after all finds it missing and runs the stages again.
    """
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)


def stored_step(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` written to ``folder`` and read back, as a step of a large job: nothing is left of it but these files."""
    with shuffles_removed(rows.sparkSession):
        rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def keep_files_open(spark: SparkSession) -> None:
    """From now on, tasks of this session that write into several folders or buckets keep a file open for each, up to
    ``OPEN_FILES``, and sort only what goes beyond. Otherwise Spark sorts all rows by folder or bucket first.

    Left set: a write that is planned with it must not be run without it, and another thread may be writing.
    """
    if int(spark.conf.get(FILES_SETTING, "0")) == 0:
        spark.conf.set(FILES_SETTING, str(OPEN_FILES))


# Files


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, hidden ones left out; none if there is no folder."""
    hadoop, system = _path(spark, folder)
    if not system.exists(hadoop):
        return []
    names = [status.getPath().getName() for status in system.listStatus(hadoop)]
    return sorted(name for name in names if not name.startswith("."))


def delete(spark: SparkSession, path: str) -> None:
    hadoop, system = _path(spark, path)
    system.delete(hadoop, True)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 at which a path was last changed."""
    hadoop, system = _path(spark, path)
    return system.getFileStatus(hadoop).getModificationTime() / 1000


def read_file(spark: SparkSession, path: str) -> str:
    return spark._jvm.org.apache.commons.io.IOUtils.toString(_open(spark, path), "UTF-8")


def _open(spark: SparkSession, path: str):
    hadoop, system = _path(spark, path)
    return system.open(hadoop)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole, if there is none of that name; otherwise leave it and say False.

    The text is written under a hidden name that then becomes the wanted one: by a hard link on local disks, which
    fails if the name is taken, and elsewhere by a rename that does not overwrite, which HDFS does as one step. A store
    without such a rename (plain object stores) needs a file system that adds it.
    """
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    hadoop, system = _path(spark, draft)
    system.mkdirs(hadoop.getParent())
    out = system.create(hadoop, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if system.getScheme() == "file":
        local = spark._jvm.org.apache.hadoop.fs.Path.getPathWithoutSchemeAndAuthority
        try:
            os.link(local(hadoop).toString(), local(_path(spark, path)[0]).toString())
        except FileExistsError:
            return False
        finally:
            delete(spark, draft)
        return True
    final = _path(spark, path)[0]
    if system.rename(hadoop, final):
        return True
    delete(spark, draft)
    return False


# Layout


def store_by_charge(billing: Billing, database: str, folder: str, buckets: int | None = None) -> Billing:
    """The billing tables with both facts stored as tables of ``database`` that are bucketed by practice and charge.

    Sums by charge and joins on it then read the facts as they lie, without moving them. The files go below
    ``folder``; a new load writes a new folder and replaces the tables.
    """
    spark = billing.charges.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep_files_open(spark)
    kept = {}
    for name in FACTS:
        table = f"{database}.{name}"
        spark.sql(f"drop table if exists {table}")
        # Dealt by bucket first: otherwise every task writes a file for every bucket.
        rows = getattr(billing, name).repartition(count, *FACT_KEY)
        writer = rows.write.format("parquet").option("path", f"{folder}/{name}")
        # Not sorted: no reader relies on an order within buckets, and joins that need one sort anew.
        writer.bucketBy(count, *FACT_KEY).saveAsTable(table)
        kept[name] = spark.table(table)
    return replace(billing, **kept)
