"""The billing tables as one bundle of DataFrames, and its Parquet reader."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimledger.sources.schemas import SOURCES


@dataclass(frozen=True)
class Billing:
    patient_encounter: DataFrame
    accounts: DataFrame
    encounter_payer: DataFrame
    charges: DataFrame
    trans_detail: DataFrame
    transactions: DataFrame
    person_relationship: DataFrame
    practice: DataFrame
    employer_mstr: DataFrame
    person: DataFrame
    code_tables: DataFrame
    location_mstr: DataFrame
    mstr_lists: DataFrame
    payer_mstr: DataFrame


def read_billing(spark: SparkSession, root: str) -> Billing:
    """Read ``root/<table>`` Parquet folders with the declared schemas, so no inference job runs.

    A folder layout ``charges/practice_id=0001/...`` is fine too: the declared schema keeps the
    practice code as text, and a practice filter then prunes whole folders.
    """
    return Billing(
        **{name: spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in SOURCES.items()}
    )
