"""Plan checks on stored tables: one pass per fact, pruned columns, pushed filters, no needless work."""

import re
from dataclasses import replace

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

from claimledger.operators import joins, measures
from claimledger.operators.lookups import encounter_rows, one_per_encounter
from claimledger.plans.charge_fact import charge_fact, charge_transactions, summed_charges
from claimledger.plans.encounter_balances import encounter_balances, encounter_sums, with_encounter_money
from claimledger.sources.billing import read_billing
from claimledger.sources.staging import ALL_PRACTICES
from claimledger.sources.storage import store_by_charge
from tests.conftest import same_rows


@pytest.fixture(scope="module")
def billing(spark, stored):
    return read_billing(spark, stored)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    """The plan as it ran, with exchanges reused."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def scans(plan, table):
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{table}]" in line]


def columns_read(scan):
    return set(re.findall(r"(\w+):", scan.split("ReadSchema: struct<")[1]))


def sums_of(plan, node="HashAggregate"):
    """Final aggregations that sum, by the keys they group on."""
    return [line for line in plan.splitlines() if f"{node}(" in line and "functions=[sum(" in line]


def test_reading_keeps_the_practice_code_as_text(billing):
    practices = {r[0] for r in billing.charges.select("practice_id").distinct().collect()}
    assert practices == set(ALL_PRACTICES)
    assert dict(billing.charges.dtypes)["practice_id"] == "string"


def test_stored_tables_give_the_same_fact(spark, billing, staged):
    same_rows(charge_fact(billing, ALL_PRACTICES), charge_fact(staged, ALL_PRACTICES))


def test_charge_sums_are_one_pass(billing):
    plan = planned(measures.encounter_charge_sums(billing.charges))
    assert len(scans(plan, "charges")) == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert len(sums_of(plan)) == 1
    assert "charge_id" not in columns_read(scans(plan, "charges")[0])


def test_encounter_transaction_sums_are_one_pass(billing):
    sums = measures.encounter_transaction_sums(billing.trans_detail, billing.transactions)
    plan = planned(sums)
    assert len(scans(plan, "trans_detail")) == 1
    # The headers prune folders of the details too, out of the same broadcast.
    assert "dynamicpruning" in plan
    assert len(sums_of(plan)) == 1
    assert "charge_id" not in columns_read(scans(plan, "trans_detail")[0])


def test_charge_transaction_sums_are_one_pass(billing):
    plan = planned(charge_transactions(billing, ["0001", "0002"]))
    assert len(scans(plan, "trans_detail")) == len(scans(plan, "transactions")) == 1
    assert len(sums_of(plan)) == 1
    detail = scans(plan, "trans_detail")[0]
    assert "source_id" not in columns_read(detail)
    assert "EqualTo(post_ind,Y)" in detail.split("PushedFilters")[1]
    assert "practice_id" in detail.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_the_practice_filter_prunes_folders(billing):
    scan = scans(planned(summed_charges(billing.charges, ["0002"])), "charges")[0]
    assert "practice_id" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_account_sums_are_grouped_not_windowed(billing):
    encounters = one_per_encounter(encounter_rows(billing.patient_encounter))
    owners = encounters.select("practice_id", "enc_id", "guar_id", "enc_status")
    plan = planned(measures.account_sums(with_encounter_money(owners, encounter_sums(billing))))
    assert "Window" not in plan
    assert len(scans(plan, "charges")) == len(scans(plan, "trans_detail")) == 1


def test_the_wide_job_reads_each_fact_once(billing):
    plan = final(encounter_balances(billing, ALL_PRACTICES))
    assert len(scans(plan, "charges")) == 1
    assert len(scans(plan, "trans_detail")) == 1
    assert "ReusedExchange" in plan


@pytest.fixture
def executed(monkeypatch):
    """Plans of the jobs that run while a job is being planned."""
    plans = []
    for name in ("collect", "first", "count"):
        real = getattr(DataFrame, name)

        def run(self, *args, real=real):
            plans.append(planned(self))
            return real(self, *args)

        monkeypatch.setattr(DataFrame, name, run)
    return plans


@pytest.mark.parametrize("job", [encounter_balances, charge_fact])
@pytest.mark.parametrize("large", [False, True])
def test_planning_scans_a_fact_once(monkeypatch, billing, executed, job, large):
    if large:
        monkeypatch.setattr(joins, "SMALL_BYTES", -1)
    job(billing, ALL_PRACTICES)
    for fact in ("charges", "trans_detail", "patient_encounter"):
        assert sum(len(scans(plan, fact)) for plan in executed) <= 1, fact
    assert executed


def exchanges_of(plan, column):
    """Exchanges that the rows with a column pass, with what they are dealt by."""
    tree = plan.split("\n")
    return [line for line in tree if "Exchange hashpartitioning(" in line and column in line]


def test_charge_lines_move_twice(spark, billing):
    """Once by charge, for their sums and those of their transactions, and once by encounter."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = charge_fact(billing, ALL_PRACTICES)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_charge = exchanges_of(plan, "charge_id")
    # charge lines, transaction sums
    assert len(by_charge) == 2 and not any("source_id" in line for line in by_charge), plan
    # charges by encounter, encounters; transaction lines and headers by transaction; no other
    assert plan.count("Exchange hashpartitioning") == 6, plan


@pytest.mark.parametrize("broadcast", [True, False])
def test_facts_stored_by_charge_stay_where_they_are(spark, billing, tmp_path, broadcast):
    """Charge lines are summed and joined as they lie in their buckets; transaction lines move for large headers only."""
    spark.sql("create database if not exists by_charge")
    tables = store_by_charge(billing, "by_charge", str(tmp_path))
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = charge_fact(tables, ALL_PRACTICES)
        plan = planned(fact)
        assert len(re.findall(r"by_charge\.charges\[.*Bucketed: true", plan)) == 1
        assert len(exchanges_of(plan, "charge_id")) == (0 if broadcast else 1), plan
        assert len([x for x in exchanges_of(plan, "trans_id") if "source" not in x]) == (1 if broadcast else 2), plan
        same_rows(fact, charge_fact(billing, ALL_PRACTICES))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_new_load_replaces_the_bucketed_tables(spark, billing, tmp_path):
    spark.sql("create database if not exists by_charge")
    store_by_charge(billing, "by_charge", str(tmp_path / "a"))
    few = replace(billing, charges=billing.charges.limit(7))
    assert store_by_charge(few, "by_charge", str(tmp_path / "b"), buckets=3).charges.count() == 7


def test_the_scope_of_a_few_encounters_is_computed_once(billing, executed):
    """The encounters are read twice while planning: for the guarantors, and for what they own; then never again."""
    reads = []
    real = DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        reads.append(planned(self._df))
        return real(self, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", parquet)
        wide = encounter_balances(billing, ["0001"], ["5", "10", "25", "100", "1000"])
    assert [len(scans(plan, "patient_encounter")) for plan in reads] == [1, 1]
    assert not scans(planned(wide), "patient_encounter")
    assert not any(scans(plan, "patient_encounter") for plan in executed)


@pytest.mark.parametrize("job", [encounter_balances, charge_fact])
def test_no_pairs_no_python_no_windows(billing, job):
    plan = planned(job(billing, ALL_PRACTICES))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window", "SinglePartition"):
        assert node not in plan


def test_a_few_encounters_filter_the_facts_where_they_are_read(billing):
    plan = planned(encounter_balances(billing, ["0001"], ["5", "10", "25", "100", "1000"]))
    assert len(re.findall(r"BroadcastHashJoin.*LeftSemi", plan)) >= 3
