"""Reading tables, shared folders and stored intermediate tables."""

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows taken from an Arrow batch at a time end at so many bytes of text (a single longer text is whole).
SLICE_BYTES = 2_000_000
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per session, as ``--py-files`` would.

    Arrow batches of the session get at most ``BATCH_ROWS`` rows, as rows hold whole texts.
    """
    context = spark.sparkContext
    if getattr(context, "_claimledger_sent", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = f"{tempfile.mkdtemp(prefix='claimledger-')}/claimledger.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(limit)) <= BATCH_ROWS:
        spark.conf.set(limit, str(BATCH_ROWS))
    context._claimledger_sent = True


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``. Only a session within one process may leave that unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="claimledger-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/stored-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage is cut, and a lost executor loses nothing."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``. NULL for a missing id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch in slices of bounded text, each with its texts (NULL: empty)."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    group = np.cumsum(lengths) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            part = batch.slice(start, end - start)
            yield part, [text or "" for text in part.column(column).to_pylist()]


def add_columns(
    df: DataFrame, column: str, make: Callable[[], Callable[[list[str]], list[pa.Array]]], added: str
) -> DataFrame:
    """``df`` with columns (DDL in ``added``) computed from the texts in ``column``. Added names replace existing ones.

    ``make`` runs once per task and returns the function that turns texts into one Arrow array per added column.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(added)
    kept = [c for c in df.columns if c not in new.names]
    wanted = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part, texts in text_slices(batch, column):
                arrays = [a.cast(f.type) for a, f in zip(compute(texts), wanted, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *arrays], [*kept, *new.names])
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return df.mapInArrow(run, StructType([*(df.schema[c] for c in kept), *new.fields]))
