"""A training corpus from raw documents: ``run(spark, sf_dir)`` applies ``STAGES`` to the table ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of the documents they were given. Columns other than ``doc_id`` and
``text`` pass unchanged, whatever they are called. An empty table gives empty results in every stage.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimledger.llm import decontamination, jaccard_join, quality, secret_scan, sentencepiece_codec
from claimledger.llm.common import ship, stored, table

PIECES = "piece_bpe_32k.model"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality ranking rejects, a NULL or empty text as the ranking has it."""
    ship(spark)
    labels = table(spark, sf_dir, "labels")
    return quality.accepted(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, the one with the least id."""
    ship(spark)
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark."""
    ship(spark)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document and masks the secrets in its text; ``n_chars`` follows the text."""
    ship(spark)
    return secret_scan.without_secrets(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text, ids, n_tokens and round_trip: whether decoding the ids gives the text back. NULL text: no ids, NULL."""
    ship(spark)
    model = public_tokenizers.path(PIECES)
    coded = sentencepiece_codec.encode(docs.select("doc_id", "text"), model)
    return sentencepiece_codec.decode(coded, model).select(
        "doc_id", "text", "ids", F.size("ids").cast("bigint").alias("n_tokens"), (F.col("decoded") == F.col("text")).alias("round_trip")
    )


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding and decoding", tokenize),
]

#: The ranking, the alignment and the encoding are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
