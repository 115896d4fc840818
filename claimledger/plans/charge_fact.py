"""The charge fact: one row per charge with its amounts, transactions and balance."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.operators.joins import KeyUse, Side, hashed, keyed, lookup
from claimledger.operators.measures import (
    TRANSACTION_MEASURES,
    charge_part_sums,
    charge_sums,
    in_parts,
    out_of_parts,
    parts_of,
    total_of,
    transaction_part_sums,
    with_zeros,
)
from claimledger.sources.billing import Billing
from claimledger.sources.schemas import CHARGE_FACT, typed

# The id first: joins sort by the first bytes of the first key, and a practice's tell few rows apart.
CHARGE = ["charge_id", "practice_id"]
GRAIN = ["practice_id", "enc_id", "charge_id"]

# Fact column -> charge column it sums. An amount that is NULL throughout stays NULL.
CHARGE_SUMS = {
    "chgamt": "amt",
    "chgcob1": "cob1_amt",
    "chgcob2": "cob2_amt",
    "chgcob3": "cob3_amt",
    "chgpat": "pat_amt",
}
# Measure -> fact column: ins_pmt is chginspmt.
TRANSACTION_SUMS = {name: f"chg{name.replace('_', '')}" for name in TRANSACTION_MEASURES}
SAMPLE_ROWS = 100


def of_practices(table: DataFrame, practices: Sequence[str]) -> DataFrame:
    return table.where(F.col("practice_id").isin(*practices))


def summed_charges(charges: DataFrame, practices: Sequence[str]) -> DataFrame:
    """Charge lines summed per charge of an encounter; the practice filter reaches the scan."""
    sums = charge_sums(of_practices(charges, practices), ["practice_id", "source_id", "charge_id"], CHARGE_SUMS)
    return sums.withColumnRenamed("source_id", "enc_id")


def with_insurance_balance(charges: DataFrame) -> DataFrame:
    return charges.withColumn("chginsbal", total_of(["chgcob1", "chgcob2", "chgcob3"]))


def transaction_use(trans_detail: DataFrame, practices: Sequence[str]) -> KeyUse:
    """How transaction lines spread over transactions."""
    return KeyUse(of_practices(trans_detail, practices).select(*CHARGE, "trans_id"), ["trans_id"])


def transaction_sums_by_charge(billing: Billing, practices: Sequence[str], lines: KeyUse) -> DataFrame:
    """The six measures by charge, in parts.

    Only posted lines count, and a header is found by transaction id alone: a line counts once per
    practice that has a header of that id.
    """
    return transaction_part_sums(
        of_practices(billing.trans_detail, practices),
        billing.transactions,
        by=CHARGE,
        header_keys=["trans_id"],
        unposted_payments=False,
        names=TRANSACTION_SUMS,
        use=lines,
    )


def with_transactions(
    charges: DataFrame, billing: Billing, practices: Sequence[str], use: KeyUse
) -> DataFrame:
    """The six measures attached to summed charges, in parts."""
    lines = transaction_use(billing.trans_detail, practices)
    return lookup(
        charges,
        Side(transaction_sums_by_charge(billing, practices, lines), lines),
        CHARGE,
        use.hot(*CHARGE),
        spread=[c for c in GRAIN if c in charges.columns],
    )


def with_measures(charges: DataFrame) -> DataFrame:
    """The six measures whole, zero where a charge has none."""
    return with_zeros(out_of_parts(charges, TRANSACTION_SUMS.values()), TRANSACTION_SUMS.values())


def settled_charges(billing: Billing, practices: Sequence[str], use: KeyUse) -> DataFrame:
    """Charge lines summed per charge of an encounter, with the six measures in parts.

    Where no charge is hot, lines find the transaction sums of their charge first and are grouped then. Join and
    grouping share one distribution by charge, so lines move once, and not at all if the table is bucketed by charge.
    The lines of hot charges are added up before they move instead, and cut into slices for the join.
    """
    if use.hot(*CHARGE):
        charges = summed_charges(billing.charges, practices)
        return with_transactions(charges, billing, practices, use)
    lines = in_parts(of_practices(billing.charges, practices), [*CHARGE, "source_id"], CHARGE_SUMS.values())
    details = transaction_use(billing.trans_detail, practices)
    sums = hashed(transaction_sums_by_charge(billing, practices, details), details.rows)
    # Within a charge the measures are the same on all lines, so grouping by them too parts nothing, and is less work than
    # an aggregation for each.
    same = ["practice_id", "source_id", "charge_id", *parts_of(TRANSACTION_SUMS.values())]
    grouped = lines.join(sums, CHARGE, "left").groupBy(*same).agg(*charge_part_sums(CHARGE_SUMS))
    return out_of_parts(grouped.withColumnRenamed("source_id", "enc_id"), CHARGE_SUMS)


def charge_transactions(billing: Billing, practices: Sequence[str]) -> DataFrame:
    """One row per (practice, charge), each charge included."""
    lines = of_practices(billing.charges, practices).select(*CHARGE)
    return with_measures(with_transactions(lines.distinct(), billing, practices, KeyUse(lines, CHARGE)))


def key_use(charges: DataFrame, practices: Sequence[str]) -> KeyUse:
    """How charge lines spread over encounters and over charges."""
    keys = of_practices(charges, practices).select("practice_id", F.col("source_id").alias("enc_id"), "charge_id")
    return KeyUse(keys, ["enc_id"], CHARGE)


def with_guarantor(charges: DataFrame, patient_encounter: DataFrame, use: KeyUse) -> DataFrame:
    """Guarantor of the charge's encounter, found by encounter id; a charge without one is dropped.

    Where an encounter id occurs with a guarantor and without, the row with one counts: no charge that has an
    owner is lost.
    """
    owned = patient_encounter.where(F.col("guar_id").isNotNull())
    owners = keyed(owned.select("enc_id", "guar_id", "guar_type"), ["enc_id"])
    hot = use.hot("enc_id")
    if not hot:
        owners.rows = hashed(owners.rows, patient_encounter.count())
    found = lookup(charges, owners, ["enc_id"], hot, spread=GRAIN)
    return found.where(F.col("guar_id").isNotNull())


def charge_fact(billing: Billing, practices: Sequence[str]) -> DataFrame:
    use = key_use(billing.charges, practices)
    settled = settled_charges(billing, practices, use)
    # The insurance balance after the move by encounter: what can be formed again need not move.
    fact = with_measures(with_insurance_balance(with_guarantor(settled, billing.patient_encounter, use)))
    fact = fact.withColumn("chgencbal", total_of(["chgamt", *TRANSACTION_SUMS.values()]))
    return typed(fact, CHARGE_FACT)


def charge_fact_sample(fact: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A look at the fact: its first rows by key. Never part of the load."""
    return fact.orderBy(*GRAIN).limit(rows)
