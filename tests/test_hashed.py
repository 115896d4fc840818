"""Large sides are hashed where they fit, joins sort by ids first, and bucketed facts are not sorted to be stored."""

import re

import pytest
from pyspark.sql import functions as F

from claimledger.operators import joins
from claimledger.operators.joins import hashed
from claimledger.plans.charge_fact import charge_fact
from claimledger.plans.encounter_balances import encounter_balances
from claimledger.sources.billing import read_billing
from claimledger.sources.staging import ALL_PRACTICES, _practice
from claimledger.sources.storage import FILES_SETTING, OPEN_FILES, keep_files_open, store_by_charge
from tests.conftest import same_rows


@pytest.fixture
def billing(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield read_billing(spark, stored)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def joined_by(plan, node, keys):
    plain = re.sub(r"#\d+", "", plan)
    return [line for line in plain.splitlines() if re.search(rf"{node} \[{keys}\].*(LeftOuter|Inner)", line)]


FACT_JOINS = ["charge_id, practice_id", "enc_id"]
BALANCE_JOINS = ["enc_id, practice_id", "guar_id"]


@pytest.mark.parametrize("job,keys", [(charge_fact, FACT_JOINS), (encounter_balances, BALANCE_JOINS)])
def test_large_sides_are_hashed_and_rows_stay(monkeypatch, billing, job, keys):
    sorted_rows = job(billing, ALL_PRACTICES)
    monkeypatch.setattr(joins, "HASHED_ROWS", 0)
    hashed_rows = job(billing, ALL_PRACTICES)
    for key in keys:
        assert joined_by(planned(hashed_rows), "ShuffledHashJoin", key), key
        assert not joined_by(planned(hashed_rows), "SortMergeJoin", key), key
    same_rows(hashed_rows, sorted_rows)


def test_a_side_that_does_not_fit_is_not_hashed(spark):
    rows, tasks = spark.range(1), int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = joins.HASHED_BYTES * tasks // joins.FIXED_WIDTH

    def hinted(count, tables=1):
        return "shuffle_hash" in hashed(rows, count, tables)._jdf.queryExecution().logical().toString()

    assert hinted(most) and not hinted(most + 1)
    assert not hinted(most, tables=2) and not hinted(joins.HASHED_ROWS)


@pytest.mark.parametrize("job", [charge_fact, encounter_balances])
def test_joins_sort_by_ids_before_practices(billing, job):
    assert not re.search(r"Sort \[practice_id#\d+ ASC NULLS FIRST, (enc|charge)_id", planned(job(billing, ALL_PRACTICES)))


def test_bucketed_facts_are_not_sorted_to_be_stored(spark, billing, tmp_path):
    spark.sql("create database if not exists unsorted")
    store_by_charge(billing, "unsorted", str(tmp_path))
    described = dict((r[0], r[1]) for r in spark.sql("describe extended unsorted.charges").collect())
    assert "Sort Columns" not in described or described["Sort Columns"] in ("", "[]")
    assert described["Bucket Columns"] == "[`charge_id`, `practice_id`]"


def test_files_are_kept_open_instead_of_sorting(spark):
    spark.conf.unset(FILES_SETTING)
    keep_files_open(spark)
    assert int(spark.conf.get(FILES_SETTING)) == OPEN_FILES
    spark.conf.set(FILES_SETTING, "3")
    keep_files_open(spark)
    assert int(spark.conf.get(FILES_SETTING)) == 3
    spark.conf.unset(FILES_SETTING)


def test_more_buckets_than_open_files_keep_their_rows(spark, stored, tmp_path):
    """What goes beyond the open files is sorted, not lost."""
    spark.sql("create database if not exists open_files")
    spark.conf.set(FILES_SETTING, "2")
    try:
        tables = store_by_charge(read_billing(spark, stored), "open_files", str(tmp_path), buckets=7)
        same_rows(tables.charges, read_billing(spark, stored).charges)
    finally:
        spark.conf.unset(FILES_SETTING)


def test_measures_are_grouped_by_and_not_added_up(billing):
    plan = planned(charge_fact(billing, ALL_PRACTICES))
    assert "max(" not in plan


def test_practices_of_all_remainders(spark):
    """The looked-up practice is the padded remainder, of negative and missing keys too."""
    keys = spark.range(-12, 13).union(spark.sql("select cast(null as bigint)"))
    padded = F.lpad((F.col("id") % 5 + 1).cast("string"), 4, "0")
    assert keys.where(~_practice("id").eqNullSafe(padded)).count() == 0
    assert "lpad" not in planned(keys.select(_practice("id")))


def test_ids_are_built_for_drawn_rows_alone(spark, monkeypatch):
    """Measuring draws first: a key that cannot be built on other rows does no harm."""
    monkeypatch.setattr(joins, "SMALL_BYTES", -1)
    monkeypatch.setattr(joins, "SLICE_ROWS", 10**12)
    rows = spark.range(1000).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("built"))).cast("string").alias("key"))
    assert joins.KeyUse(rows, ["key"]).rows == 1000
