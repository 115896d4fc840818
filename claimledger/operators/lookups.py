"""Encounter scope and attributes, and the descriptions looked up for ids and codes."""

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.functions.expressions import EMPLOYER, PERSON, encounter_numbers, full_name
from claimledger.operators import joins
from claimledger.operators.joins import KeyUse, Side, keyed, least_row, lookup

ENCOUNTER = ["practice_id", "enc_id"]

# List and code types. The list types are LIKE patterns, in which "_" is any character.
RELATION_CODES = "relation"
PATIENT_TYPES = "pat_type"
FINANCIAL_CLASSES = "fin_class"

PAYER_SLOTS = (1, 2, 3)


# The keys by which encounters look something up, measured together.
ENCOUNTER_KEYS = (
    ["guar_id"],
    ["practice_id"],
    ["location_id"],
    ["pat_type"],
    ["person_id"],
    ["guar_id", "person_id"],
)

# Encounters


def encounter_use(patient_encounter: DataFrame) -> KeyUse:
    """How the encounters spread over all the keys that are looked up for them."""
    return KeyUse(encounter_rows(patient_encounter), *ENCOUNTER_KEYS)


def encounter_rows(patient_encounter: DataFrame) -> DataFrame:
    """The encounter table under the output's column names. The date keeps no time of day."""
    return patient_encounter.select(
        "practice_id",
        "enc_id",
        "guar_id",
        "guar_type",
        "person_id",
        "enc_status",
        "location_id",
        "enc_nbr",
        F.to_date("enc_timestamp").alias("dos"),
        "pat_resp_date",
        F.col("patient_type_id").alias("pat_type"),
    )


def one_per_encounter(rows: DataFrame) -> DataFrame:
    """One row per (practice_id, enc_id), with the attributes of its own row: of several, the least one, NULL last.

    Attributes belong to an encounter id, so a row without one keeps none.
    """
    attributes = [c for c in rows.columns if c not in ENCOUNTER]
    # Sorted by the id first: practices tell few rows apart.
    least = rows.groupBy(*reversed(ENCOUNTER)).agg(least_row(attributes).alias("row"))
    known = F.col("enc_id").isNotNull()
    return least.select(*ENCOUNTER, *[F.when(known, F.col("row")[c]).alias(c) for c in attributes])


def chosen_guarantors(
    patient_encounter: DataFrame, practices: Iterable[str], numbers: Sequence[str | int] | None = None
) -> Side:
    """The guarantors of the chosen encounters: those of some practices, or of some numbers there."""
    chosen = patient_encounter.where(F.col("practice_id").isin(*practices))
    if numbers is not None:
        chosen = chosen.where(F.col("enc_nbr").isin(*encounter_numbers(numbers)))
    guarantors = chosen.where(F.col("guar_id").isNotNull()).select("guar_id").distinct()
    return Side(guarantors, guarantors)


def scoped_encounters(use: KeyUse, guarantors: Side, few: bool = False) -> DataFrame:
    """Every encounter of the chosen guarantors, in whatever practice, one row each.

    ``use`` holds the encounter rows. With ``few``, the guarantors are expected to be few: if they
    are, the encounters are filtered where they are read.
    """
    owned = use.df.where(F.col("guar_id").isNotNull())
    if few and guarantors.small:
        scoped = owned.join(F.broadcast(guarantors.rows), "guar_id", "left_semi")
    else:
        scoped = lookup(
            owned,
            guarantors,
            ["guar_id"],
            use.hot("guar_id"),
            spread=owned.columns,
            how="left_semi",
            collapse=DataFrame.distinct,
        )
    return one_per_encounter(scoped)


# Looked-up sides


def account_side(accounts: DataFrame) -> Side:
    return keyed(accounts.select("guar_id", "acct_id", "acct_nbr"), ["guar_id"])


def employer_side(employer_mstr: DataFrame) -> Side:
    names = employer_mstr.select(F.col("employer_id").alias("guar_id"), F.col("name").alias("employer_name"))
    return keyed(names, ["guar_id"])


def person_side(person: DataFrame) -> Side:
    names = person.select("person_id", full_name("last_name", "first_name").alias("person_name"))
    return keyed(names, ["person_id"])


def guarantor_person_side(persons: Side) -> Side:
    """The same people in the role of guarantor."""
    return persons.renamed({"person_id": "guar_id", "person_name": "guar_person_name"})


def practice_side(practice: DataFrame) -> Side:
    return keyed(practice.select("practice_id", "practice_name"), ["practice_id"])


def location_side(location_mstr: DataFrame) -> Side:
    return keyed(location_mstr.select("location_id", "location_name"), ["location_id"])


def relationship_side(person_relationship: DataFrame, code_tables: DataFrame) -> Side:
    """How a patient (person_id) is related to a guarantor: the code, and the text of the code."""
    pairs = person_relationship.select(
        F.col("person_id").alias("guar_id"),
        F.col("related_person_id").alias("person_id"),
        F.col("relation_code").alias("relationship_id"),
    )
    codes = code_tables.where(F.col("code_type") == RELATION_CODES).select(
        F.col("code").alias("relationship_id"), F.col("description").alias("relationship_desc")
    )
    keys = ["guar_id", "person_id"]
    hot = KeyUse(pairs, ["relationship_id"]).hot("relationship_id")
    coded = lookup(
        pairs, keyed(codes, ["relationship_id"]), ["relationship_id"], hot, spread=keys, collapse=DataFrame.distinct
    )
    return keyed(coded, keys)


def master_list_side(mstr_lists: DataFrame, list_type: str, key: str, text: str) -> Side:
    items = mstr_lists.where(F.col("mstr_list_type").like(list_type)).select(
        F.col("mstr_list_item_id").alias(key), F.col("mstr_list_item_desc").alias(text)
    )
    return keyed(items, [key])


def payer_side(payer_mstr: DataFrame, mstr_lists: DataFrame) -> Side:
    """Payer with name, financial class and its text, joined once for all three roles."""
    payers = payer_mstr.select("payer_id", "payer_name", F.col("financial_class").alias("fc_id"))
    classes = master_list_side(mstr_lists, FINANCIAL_CLASSES, "fc_id", "fin_class")
    hot = KeyUse(payers, ["fc_id"]).hot("fc_id")
    spread = ["payer_id", "payer_name"]
    classed = lookup(payers, classes, ["fc_id"], hot, spread, collapse=DataFrame.distinct)
    return keyed(classed, ["payer_id"])


# Lookups


def with_description(encounters: DataFrame, side: Side, keys: Sequence[str], use: KeyUse) -> DataFrame:
    return lookup(encounters, side, keys, use.hot(*keys), spread=ENCOUNTER)


def with_guarantor_name(encounters: DataFrame) -> DataFrame:
    """The employer's name or the person's, as the guarantor type says."""
    name = F.when(F.col("guar_type") == EMPLOYER, F.col("employer_name")).when(
        F.col("guar_type") == PERSON, F.col("guar_person_name")
    )
    return encounters.withColumn("guar_name", name).drop("employer_name", "guar_person_name")


def payer_slots(encounter_payer: DataFrame) -> DataFrame:
    """One row per encounter with the payers of its three slots, in one pass."""
    slots = [
        F.min(F.when(F.col("cob") == slot, F.col("payer_id"))).alias(f"payer{slot}_id") for slot in PAYER_SLOTS
    ]
    wanted = F.col("cob").isin(*PAYER_SLOTS) & F.col("enc_id").isNotNull()
    return encounter_payer.where(wanted).groupBy("enc_id").agg(*slots)


def with_payers(encounters: DataFrame, encounter_payer: DataFrame) -> DataFrame:
    """Payer ids by encounter id; there is one row per key on both sides, so no key can be hot."""
    return encounters.join(payer_slots(encounter_payer), "enc_id", "left")


def with_payer_names(encounters: DataFrame, encounter_payer: DataFrame, payers: Side, use: KeyUse) -> DataFrame:
    """Names and classes of the three payers.

    ``use`` counts the encounters: no payer is hot unless they are many, and all of them may leave a slot empty.
    """
    hot = []
    if use.rows > joins.SLICE_ROWS:
        paid = KeyUse(encounter_payer.select("payer_id"), ["payer_id"]).hot("payer_id")
        hot = [(key, slices) for key, slices in paid if key != joins.NULL_KEY]
        hot.append((joins.NULL_KEY, math.ceil(use.rows / joins.SLICE_ROWS)))
    for slot in PAYER_SLOTS:
        role = {
            "payer_id": f"payer{slot}_id",
            "payer_name": f"payer{slot}_name",
            "fc_id": f"payer{slot}_fc_id",
            "fin_class": f"payer{slot}_fin_class",
        }
        encounters = lookup(encounters, payers.renamed(role), [f"payer{slot}_id"], hot, spread=ENCOUNTER)
    return encounters
