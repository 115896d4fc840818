"""Large jobs run in steps: the same rows, short code, and no shuffle files of steps that are over."""

import os

import pytest

from claimledger.operators import joins
from claimledger.plans import encounter_balances as plan
from claimledger.plans.charge_fact import charge_fact
from claimledger.plans.encounter_balances import encounter_balances
from claimledger.plans.warehouse import load_fact
from claimledger.sources.billing import read_billing
from claimledger.sources.staging import ALL_PRACTICES, flawed
from claimledger.sources.storage import CLEANUP_SETTING, shared_folder, shuffles_removed, stored_step
from tests.conftest import same_rows
from tests.test_parts import LONGEST
from tests.test_plans import planned, scans


@pytest.fixture
def settings(spark):
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def sizes_of_code(df):
    code = df._jdf.queryExecution().debug().codegenToSeq()
    return [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]


def moved_by(df, column):
    return planned(df).count(f"Exchange hashpartitioning({column}")


@pytest.mark.parametrize("fits", [True, False])
def test_a_large_job_leaves_its_last_step_to_the_caller(spark, stored, monkeypatch, settings, fits):
    """Its code is short where the sides by guarantor are hashed, and where rows are sorted."""
    monkeypatch.setattr(joins, "HASHED_BYTES", joins.HASHED_BYTES if fits else -1)
    billing = read_billing(spark, stored)
    whole = encounter_balances(billing, ALL_PRACTICES)
    monkeypatch.setattr(plan, "STEP_ROWS", 0)
    steps = encounter_balances(billing, ALL_PRACTICES)
    # Rows by guarantor are left, nothing that came before.
    assert not moved_by(steps, "enc_id") and moved_by(whole, "enc_id") and moved_by(steps, "guar_id")
    assert not any(scans(planned(steps), table) for table in ("charges", "trans_detail", "patient_encounter"))
    assert ("ShuffledHashJoin [guar_id" in planned(steps)) == fits
    sizes = sizes_of_code(steps)
    assert max(sizes) < LONGEST, sizes
    same_rows(steps, whole)


@pytest.mark.parametrize("small", [500_000, -1])
def test_steps_give_the_same_rows_of_flawed_tables(spark, staged, monkeypatch, small):
    """Small descriptions are broadcast at the end, others joined before."""
    whole = encounter_balances(flawed(staged), ALL_PRACTICES)
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", small)
    monkeypatch.setattr(plan, "STEP_ROWS", 0)
    same_rows(encounter_balances(flawed(staged), ALL_PRACTICES), whole)


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {n for top in folders for _, _, names in os.walk(top.toString()) for n in names if n.startswith("shuffle_")}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    rows = spark.range(10_000).groupBy("id").count()
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP_SETTING)
    step = stored_step(rows, shared_folder(spark))
    assert spark.conf.get(CLEANUP_SETTING) == setting
    assert shuffle_files(spark) <= before
    assert step.count() == 10_000
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        raise ZeroDivisionError
    assert spark.conf.get(CLEANUP_SETTING) == setting


def test_a_load_leaves_no_shuffle_files(spark, staged):
    fact = charge_fact(staged, ALL_PRACTICES)
    before = shuffle_files(spark)
    table = load_fact(fact, shared_folder(spark, "f_transactions"), len(ALL_PRACTICES))
    assert shuffle_files(spark) <= before
    assert table.count() == fact.count()


def test_the_insurance_balance_is_formed_after_the_last_move(spark, stored, settings):
    lines = planned(charge_fact(read_billing(spark, stored), ALL_PRACTICES)).splitlines()
    move = next(n for n, line in enumerate(lines) if "Exchange hashpartitioning(enc_id" in line)
    assert any("AS chginsbal" in line for line in lines[:move])
    assert not any("chginsbal" in line for line in lines[move:])
