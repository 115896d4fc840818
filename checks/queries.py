"""Every registered query, each over its whole tables.

The scope of the large jobs is a list of practices; the queries name all of them. Lookups run over
every encounter, those without a guarantor too.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimledger.functions.expressions import status_text
from claimledger.operators import lookups, measures
from claimledger.operators.joins import KeyUse, lookup
from claimledger.operators.lookups import ENCOUNTER
from claimledger.plans import charge_fact as fact_plan
from claimledger.plans import encounter_balances as balance_plan
from claimledger.plans import warehouse
from claimledger.sources.billing import Billing
from claimledger.sources.schemas import CHARGES_SUMMED, typed
from claimledger.sources.staging import ALL_PRACTICES, flawed, stage_billing
from claimledger.sources.storage import shared_folder, store_by_charge

# The scope operator itself: one practice, and encounter numbers within it.
SCOPE_PRACTICE = ["0001"]
SCOPE_NUMBERS = ["5", "10", "25", "100", "1000"]
# The practices that the charge fact is limited to in the job itself; the tables hold more.
FACT_PRACTICES = ["0001", "0002", "0003"]

Job = Callable[[Billing], DataFrame]


def _use(b: Billing) -> KeyUse:
    return lookups.encounter_use(b.patient_encounter)


def _encounters(b: Billing) -> DataFrame:
    return lookups.one_per_encounter(_use(b).df)


def _scope(b: Billing, numbers: list[str] | None) -> DataFrame:
    guarantors = lookups.chosen_guarantors(b.patient_encounter, SCOPE_PRACTICE, numbers)
    return lookups.scoped_encounters(_use(b), guarantors, few=numbers is not None).select(*ENCOUNTER)


def encounter_scope(b: Billing) -> DataFrame:
    return _scope(b, None)


def encounter_scope_by_number(b: Billing) -> DataFrame:
    return _scope(b, SCOPE_NUMBERS)


def encounter_attributes(b: Billing) -> DataFrame:
    return _encounters(b)


def account_lookup(b: Billing) -> DataFrame:
    found = lookups.with_description(_encounters(b), lookups.account_side(b.accounts), ["guar_id"], _use(b))
    return found.select(*ENCOUNTER, "guar_id", "acct_id", "acct_nbr")


def payer_slots(b: Billing) -> DataFrame:
    found = lookups.with_payers(_encounters(b), b.encounter_payer)
    return found.select(*ENCOUNTER, "payer1_id", "payer2_id", "payer3_id")


def encounter_charge_sums(b: Billing) -> DataFrame:
    sums = measures.encounter_charge_sums(b.charges)
    return measures.with_sums(_encounters(b).select(*ENCOUNTER), sums)


def encounter_trans_sums(b: Billing) -> DataFrame:
    sums = measures.encounter_transaction_sums(b.trans_detail, b.transactions)
    return measures.with_sums(_encounters(b).select(*ENCOUNTER), sums)


def bad_debt_move(b: Billing) -> DataFrame:
    encounters = _encounters(b).select(*ENCOUNTER, "enc_status")
    summed = measures.with_sums(encounters, measures.encounter_charge_sums(b.charges))
    return measures.with_bad_debt(summed).select(*ENCOUNTER, "enc_status", "enc_pat_buc", "enc_bad_debt_amt")


def encounter_totals(b: Billing) -> DataFrame:
    encounters = _encounters(b).select(*ENCOUNTER, "enc_status")
    money = balance_plan.with_encounter_money(encounters, balance_plan.encounter_sums(b))
    totals = measures.with_totals(money, "enc")
    return totals.select(*ENCOUNTER, *[f"enc_{name}" for name in measures.TOTALS])


def account_totals(b: Billing) -> DataFrame:
    encounters = _encounters(b).select(*ENCOUNTER, "guar_id", "enc_status")
    money = balance_plan.with_encounter_money(encounters, balance_plan.encounter_sums(b))
    totals = measures.with_account_totals(money, _use(b))
    return totals.select(*ENCOUNTER, "guar_id", *measures.ACCOUNT_COLUMNS)


def relationship_desc(b: Billing) -> DataFrame:
    side = lookups.relationship_side(b.person_relationship, b.code_tables)
    found = lookups.with_description(_encounters(b), side, ["guar_id", "person_id"], _use(b))
    return found.select(*ENCOUNTER, "relationship_id", "relationship_desc")


def practice_name(b: Billing) -> DataFrame:
    found = lookups.with_description(_encounters(b), lookups.practice_side(b.practice), ["practice_id"], _use(b))
    return found.select(*ENCOUNTER, "practice_name")


def guarantor_name(b: Billing) -> DataFrame:
    people = lookups.guarantor_person_side(lookups.person_side(b.person))
    sides = [lookups.employer_side(b.employer_mstr), people]
    found = lookup(_encounters(b), sides, ["guar_id"], _use(b).hot("guar_id"), spread=ENCOUNTER)
    return lookups.with_guarantor_name(found).select(*ENCOUNTER, "guar_id", "guar_type", "guar_name")


def person_name(b: Billing) -> DataFrame:
    found = lookups.with_description(_encounters(b), lookups.person_side(b.person), ["person_id"], _use(b))
    return found.select(*ENCOUNTER, "person_id", "person_name")


def status_desc(b: Billing) -> DataFrame:
    return _encounters(b).select(*ENCOUNTER, "enc_status", status_text("enc_status").alias("enc_status_desc"))


def location_name(b: Billing) -> DataFrame:
    found = lookups.with_description(_encounters(b), lookups.location_side(b.location_mstr), ["location_id"], _use(b))
    return found.select(*ENCOUNTER, "location_id", "location_name")


def patient_type_desc(b: Billing) -> DataFrame:
    types = lookups.master_list_side(b.mstr_lists, lookups.PATIENT_TYPES, "pat_type", "pat_type_desc")
    found = lookups.with_description(_encounters(b), types, ["pat_type"], _use(b))
    return found.select(*ENCOUNTER, "pat_type", "pat_type_desc")


def _with_payer_names(b: Billing) -> DataFrame:
    slots = lookups.with_payers(_encounters(b), b.encounter_payer)
    return lookups.with_payer_names(
        slots, b.encounter_payer, lookups.payer_side(b.payer_mstr, b.mstr_lists), _use(b)
    )


def payer_names(b: Billing) -> DataFrame:
    columns = [f"payer{slot}_{part}" for slot in lookups.PAYER_SLOTS for part in ("id", "name", "fc_id")]
    return _with_payer_names(b).select(*ENCOUNTER, *columns)


def payer_financial_class(b: Billing) -> DataFrame:
    columns = [f"payer{slot}_{part}" for slot in lookups.PAYER_SLOTS for part in ("fc_id", "fin_class")]
    return _with_payer_names(b).select(*ENCOUNTER, *columns)


def encounter_balances(b: Billing) -> DataFrame:
    return balance_plan.encounter_balances(b, ALL_PRACTICES)


def charge_sums(b: Billing) -> DataFrame:
    charges = fact_plan.summed_charges(b.charges, ALL_PRACTICES)
    declared = {f.name: f.dataType for f in CHARGES_SUMMED.fields}
    return charges.select([F.col(c).cast(declared[c]) for c in charges.columns])


def charge_insurance_balance(b: Billing) -> DataFrame:
    charges = fact_plan.with_insurance_balance(fact_plan.summed_charges(b.charges, ALL_PRACTICES))
    return charges.select(*fact_plan.GRAIN, "chginsbal")


def charge_trans_sums(b: Billing) -> DataFrame:
    return fact_plan.charge_transactions(b, ALL_PRACTICES)


def charge_guarantor(b: Billing) -> DataFrame:
    charges = fact_plan.with_insurance_balance(fact_plan.summed_charges(b.charges, ALL_PRACTICES))
    use = fact_plan.key_use(b.charges, ALL_PRACTICES)
    return typed(fact_plan.with_guarantor(charges, b.patient_encounter, use), CHARGES_SUMMED)


def charge_fact(b: Billing) -> DataFrame:
    return fact_plan.charge_fact(b, ALL_PRACTICES)


def charge_fact_sample(b: Billing) -> DataFrame:
    return fact_plan.charge_fact_sample(charge_fact(b))


def fact_load(b: Billing) -> DataFrame:
    fact = charge_fact(b)
    return warehouse.load_fact(fact, shared_folder(fact.sparkSession, "f_transactions"), len(ALL_PRACTICES))


def fact_contract_violations(b: Billing) -> DataFrame:
    rows = warehouse.warehouse_rows(charge_fact(b))
    spark = rows.sparkSession
    # Nobody reads this copy by practice, so it is stored without folders.
    found = warehouse.store_checked(rows, shared_folder(spark, "f_transactions"), by=())
    return spark.createDataFrame(found, "rule string, column_name string, violations bigint")


def encounter_balances_by_number(b: Billing) -> DataFrame:
    return balance_plan.encounter_balances(b, SCOPE_PRACTICE, SCOPE_NUMBERS)


def charge_fact_of_practices(b: Billing) -> DataFrame:
    return fact_plan.charge_fact(b, FACT_PRACTICES)


def charge_fact_by_bucket(b: Billing) -> DataFrame:
    spark = b.charges.sparkSession
    folder = shared_folder(spark, "facts")
    name = f"facts_{folder[-12:]}"
    spark.sql(f"create database if not exists {name} location '{folder}/database'")
    return charge_fact(store_by_charge(b, name, folder))


JOBS: dict[str, Job] = {
    job.__name__: job
    for job in (
        encounter_scope,
        encounter_scope_by_number,
        encounter_attributes,
        account_lookup,
        payer_slots,
        encounter_charge_sums,
        encounter_trans_sums,
        bad_debt_move,
        encounter_totals,
        account_totals,
        relationship_desc,
        practice_name,
        guarantor_name,
        person_name,
        status_desc,
        location_name,
        patient_type_desc,
        payer_names,
        payer_financial_class,
        encounter_balances,
        charge_sums,
        charge_insurance_balance,
        charge_trans_sums,
        charge_guarantor,
        charge_fact,
        charge_fact_sample,
        fact_load,
        fact_contract_violations,
        encounter_balances_by_number,
        charge_fact_of_practices,
        charge_fact_by_bucket,
    )
}

# Jobs that run over the flawed tables too: there, a rule that is left out changes the result.
FLAWED_JOBS: dict[str, Job] = {
    f"flawed_{job.__name__}": job
    for job in (
        encounter_attributes,
        encounter_trans_sums,
        charge_trans_sums,
        encounter_balances,
        charge_fact,
        fact_contract_violations,
    )
}


def _query(job: Job) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: job(stage_billing(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _query(job) for name, job in JOBS.items()},
    **{name: _query(lambda b, job=job: job(flawed(b))) for name, job in FLAWED_JOBS.items()},
}
