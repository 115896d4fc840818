import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from claimledger.llm import blocks
from claimledger.llm.common import ship

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # names that the operators use themselves
        StructField("score", StringType()),
        StructField("ids", StringType()),
        StructField("block", StringType()),
    ]
)


@pytest.fixture(autouse=True, scope="module")
def sent(spark):
    """The package at the workers, few partitions for few rows, and several blocks for little text."""
    ship(spark)
    sizes = blocks.BLOCKS_PER_CORE, blocks.LEAST_BYTES
    blocks.BLOCKS_PER_CORE, blocks.LEAST_BYTES = 1, 1
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    blocks.BLOCKS_PER_CORE, blocks.LEAST_BYTES = sizes


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) pairs, with columns of clashing names."""

    def make(rows):
        full = [(i, t, "en", None, None if t is None else len(t), "s", None, "b") for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd():
    """Rows that every operator must take: NULLs, empty, blank, long, repeated, without an id."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "word " * 30_000), (5, "a"), (5, "a"), (None, "no id here"), (None, None)]
