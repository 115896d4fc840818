"""Encounter balances: one wide row per encounter of the chosen guarantors."""

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.functions.expressions import status_text
from claimledger.operators import lookups, measures
from claimledger.operators.joins import KeyUse, Side, hashed, lookup
from claimledger.operators.lookups import ENCOUNTER
from claimledger.sources.billing import Billing
from claimledger.sources.schemas import ENCOUNTER_BALANCES, typed
from claimledger.sources.storage import FACTS, delete, shared_folder, stored, stored_step

# With more transaction lines than this, the job is run in steps: the shuffle files of a step go before the next one, and what is
# stored in between, by columns, takes a third of the room of rows in a shuffle.
STEP_ROWS = 2_000_000


def encounter_sums(billing: Billing, lines: KeyUse | None = None) -> list[DataFrame]:
    """The charge sums and the transaction sums by encounter. ``lines`` is the use of the transaction lines, if known."""
    return [
        measures.encounter_charge_sums(billing.charges),
        measures.encounter_transaction_sums(billing.trans_detail, billing.transactions, lines),
    ]


def with_encounter_money(encounters: DataFrame, sums: Sequence[DataFrame]) -> DataFrame:
    """The sums by encounter, and the bad debt move."""
    for by_encounter in sums:
        encounters = measures.with_sums(encounters, by_encounter)
    return measures.with_bad_debt(encounters)


def few_encounters(billing: Billing, guarantors: Side, use: KeyUse) -> tuple[DataFrame, Billing]:
    """The scoped encounters of a few guarantors, and the billing tables with only their charges, lines and payers.

    The scope is computed once and stored: its size is then known from the stored rows, and these tables are
    filtered by it where they are read. If it is not small after all, they stay as they are.
    """
    scoped = stored(lookups.scoped_encounters(use, guarantors, few=True))
    keys = scoped.select("practice_id", F.col("enc_id").alias("source_id"))
    if not Side(keys, keys).small:
        return scoped, billing
    own = {name: getattr(billing, name).join(F.broadcast(keys), keys.columns, "left_semi") for name in FACTS}
    ids = keys.select(F.col("source_id").alias("enc_id"))
    own["encounter_payer"] = billing.encounter_payer.join(F.broadcast(ids), "enc_id", "left_semi")
    return scoped, replace(billing, **own)


def encounter_balances(
    billing: Billing, practices: Sequence[str], numbers: Sequence[str | int] | None = None
) -> DataFrame:
    """All 73 columns, for every encounter of the guarantors with a chosen encounter.

    An encounter is chosen by practice and, if given, by number. The descriptions are joined on
    before the money, while rows are narrow. Everything keyed by guarantor is joined last and together:
    the account sums need the money of all encounters first, and the rows then move once for all four.

    A large job is run in three steps, which bounds the disk it needs at a time: the encounters with their
    descriptions, with their money, and with what is keyed by guarantor. The last one is left to the caller.
    """
    use = lookups.encounter_use(billing.patient_encounter)
    guarantors = lookups.chosen_guarantors(billing.patient_encounter, practices, numbers)
    # Of all lines, also where they are filtered below: a filtered fact cannot be counted without reading it.
    lines = measures.encounter_transaction_use(billing.trans_detail)
    if numbers is None:
        scoped = lookups.scoped_encounters(use, guarantors)
    else:
        rows = stored(guarantors.rows)
        guarantors = Side(rows, rows)
        scoped, billing = few_encounters(billing, guarantors, use)
        # What is looked up for the scope now is looked up for its own rows.
        use = KeyUse(scoped, *lookups.ENCOUNTER_KEYS)
    sums = encounter_sums(billing, lines)
    in_steps = numbers is None and lines.rows > STEP_ROWS
    if numbers is None:
        counts = [billing.charges.count(), lines.rows]
        sums = [hashed(by_encounter, count, len(sums)) for by_encounter, count in zip(sums, counts, strict=True)]

    persons = lookups.person_side(billing.person)
    payers = lookups.payer_side(billing.payer_mstr, billing.mstr_lists)
    types = lookups.master_list_side(billing.mstr_lists, lookups.PATIENT_TYPES, "pat_type", "pat_type_desc")
    relationships = lookups.relationship_side(billing.person_relationship, billing.code_tables)
    wide, late = scoped, []
    for side, keys in (
        (lookups.practice_side(billing.practice), ["practice_id"]),
        (lookups.location_side(billing.location_mstr), ["location_id"]),
        (types, ["pat_type"]),
    ):
        if in_steps and side.small:
            late.append((side.broadcast(), keys))
        else:
            wide = lookups.with_description(wide, side, keys, use)
    wide = lookups.with_description(wide, persons, ["person_id"], use)
    wide = lookups.with_description(wide, relationships, ["guar_id", "person_id"], use)
    wide = lookups.with_payers(wide, billing.encounter_payer)
    late_payers = in_steps and payers.small
    if not late_payers:
        wide = lookups.with_payer_names(wide, billing.encounter_payer, payers, use)
    if in_steps:
        folder = shared_folder(wide.sparkSession)
        wide = with_encounter_money(stored_step(wide, f"{folder}/described"), sums)
        wide = owners = stored_step(wide, f"{folder}/money")
        delete(wide.sparkSession, f"{folder}/described")
        # What is broadcast, here: texts take more room than the ids they are found by, in every shuffle.
        for side, keys in late:
            wide = lookups.with_description(wide, side, keys, use)
        if late_payers:
            wide = lookups.with_payer_names(wide, billing.encounter_payer, payers.broadcast(), use)
    else:
        wide = with_encounter_money(wide, sums)
        owners = with_encounter_money(scoped.select(*ENCOUNTER, "guar_id", "enc_status"), sums)

    by_guarantor = [
        lookups.account_side(billing.accounts),
        lookups.employer_side(billing.employer_mstr),
        lookups.guarantor_person_side(persons),
        Side(measures.account_sums(owners), guarantors.probe),
    ]
    hot = use.hot("guar_id")
    late_totals = False
    if not hot and numbers is None:
        # All hashed, or the wide rows are sorted for the one that is not.
        counts = [billing.accounts.count(), billing.employer_mstr.count(), billing.person.count(), use.rows]
        rows = [side.rows for side in by_guarantor]
        for side, count in zip(by_guarantor, counts, strict=True):
            side.rows = hashed(side.rows, count, len(by_guarantor), few=in_steps)
        late_totals = in_steps and all(side.rows is not before for side, before in zip(by_guarantor, rows, strict=True))
    if not late_totals:
        # Before the last step: with its own work, they would make code too long for the JVM to compile where it sorts.
        wide = measures.with_totals(wide, "enc")
    wide = lookup(wide, by_guarantor, ["guar_id"], hot, spread=ENCOUNTER)
    wide = lookups.with_guarantor_name(wide).withColumn("enc_status_desc", status_text("enc_status"))
    if late_totals:
        wide = measures.with_totals(wide, "enc")
    wide = measures.with_account_columns(wide)
    return typed(wide, ENCOUNTER_BALANCES)
