"""The load, its contract and the stored table."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimledger.plans import warehouse
from claimledger.plans.charge_fact import charge_fact
from claimledger.plans.warehouse import (
    ContractError,
    LoadConflict,
    contract_violations,
    load_fact,
    read_fact,
    warehouse_rows,
)
from claimledger.sources.schemas import F_TRANSACTIONS
from claimledger.sources.staging import ALL_PRACTICES
from claimledger.sources.storage import create_file, file_names, read_file, shared_folder
from tests.conftest import dollars, make_billing, same_rows


def small_fact(spark, charges=(), encounters=()):
    def line(charge_id, source_id="1", practice_id="0001", amt=1):
        amounts = dict.fromkeys(["amt", "cob1_amt", "cob2_amt", "cob3_amt", "pat_amt"], amt)
        return {"practice_id": practice_id, "source_id": source_id, "charge_id": charge_id, **amounts}

    tables = make_billing(
        spark,
        patient_encounter=[
            {"practice_id": "0001", "enc_id": "1", "guar_id": "G", "guar_type": "P"},
            {"practice_id": "0001", "enc_id": "2", "guar_id": "G", "guar_type": None},
            {"practice_id": "0001", "enc_id": "3", "guar_id": "G", "guar_type": "E"},
        ],
        charges=[line(**c) for c in charges],
    )
    return charge_fact(tables, ALL_PRACTICES)


def broken(fact):
    found = contract_violations(warehouse_rows(fact)).collect()
    assert len(found) == 19
    return {(r.rule, r.column_name): r.violations for r in found if r.violations}


def test_load_and_read_back(spark, staged, tmp_path):
    fact = charge_fact(staged, ALL_PRACTICES)
    loaded = load_fact(fact, str(tmp_path / "fact"))
    assert [(f.name, f.dataType) for f in loaded.schema] == [(f.name, f.dataType) for f in F_TRANSACTIONS]
    same_rows(loaded, warehouse_rows(fact))
    assert {r[0] for r in loaded.select("Practice_ID").distinct().collect()} == set(ALL_PRACTICES)
    assert {p.name for p in (tmp_path / "fact").glob("version-*/Practice_ID=*")} == {f"Practice_ID={p}" for p in ALL_PRACTICES}


def test_columns_are_bound_by_name(spark):
    row = warehouse_rows(small_fact(spark, [{"charge_id": "C"}])).first()
    assert (row.Guarantor_ID, row.Enc_ID, row.Charge_ID, row.Guar_Type) == ("G", "1", "C", "P")
    assert (row.Gross_Charges, row.Tot_Ins_Bal, row.Curr_Enc_Bal) == (dollars(1), dollars(3), dollars(1))


def test_a_load_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    load_fact(small_fact(spark, [{"charge_id": "A"}, {"charge_id": "B", "practice_id": "0002"}]), path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        load_fact(small_fact(spark, [{"charge_id": "C"}]), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [(r.Practice_ID, r.Charge_ID) for r in read_fact(spark, path).collect()] == [("0001", "C")]


def test_a_practice_filter_reads_its_folder_only(spark, staged, tmp_path):
    path = str(tmp_path / "fact")
    load_fact(charge_fact(staged, ALL_PRACTICES), path)
    one = read_fact(spark, path).where("Practice_ID = '0003'")
    assert "PartitionFilters: [isnotnull(Practice_ID" in one._jdf.queryExecution().executedPlan().toString()
    files = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
    assert files and all("Practice_ID=0003" in f for f in files)


def test_null_amounts_break_the_contract(spark):
    found = broken(small_fact(spark, [{"charge_id": "A", "amt": None}, {"charge_id": "B"}]))
    columns = "Gross_Charges COB1_Bal COB2_Bal COB3_Bal Pat_Bal Tot_Ins_Bal Curr_Enc_Bal".split()
    assert found == {("NOT NULL", c): 1 for c in columns}


def test_a_missing_guarantor_type_breaks_the_contract(spark):
    assert broken(small_fact(spark, [{"charge_id": "A", "source_id": "2"}])) == {("NOT NULL", "Guar_Type"): 1}


def test_a_charge_under_two_encounters_breaks_the_key(spark):
    charges = [{"charge_id": "A", "source_id": s} for s in ("1", "3")] + [{"charge_id": "B"}] * 2
    assert broken(small_fact(spark, charges)) == {("PRIMARY KEY", "Charge_ID"): 1}


def test_an_empty_fact_keeps_the_contract(spark):
    assert broken(small_fact(spark)) == {}


def test_a_broken_load_leaves_the_table_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    load_fact(small_fact(spark, [{"charge_id": "A"}]), path)
    with pytest.raises(ContractError, match="PRIMARY KEY Charge_ID: 1"):
        load_fact(small_fact(spark, [{"charge_id": "B", "source_id": s} for s in ("1", "3")]), path)
    assert [r.Charge_ID for r in read_fact(spark, path).collect()] == ["A"]
    assert len(list(Path(path).glob("version-*"))) == 1


def test_a_failed_write_leaves_the_table_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    load_fact(small_fact(spark, [{"charge_id": "A"}]), path)
    fact = small_fact(spark, [{"charge_id": "B"}])
    failing = fact.withColumn("chgamt", F.when(F.col("charge_id") == "B", F.raise_error("task")).otherwise(F.col("chgamt")))
    with pytest.raises(Exception, match="task"):
        load_fact(failing, path)
    assert [r.Charge_ID for r in read_fact(spark, path).collect()] == ["A"]


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "fact")
    for charge in "ABCD":
        load_fact(small_fact(spark, [{"charge_id": charge}]), path)
    assert [r.Charge_ID for r in read_fact(spark, path).collect()] == ["D"]
    assert len(list(Path(path).glob("version-*"))) == 2


def test_loads_at_a_time_leave_one_table(spark, tmp_path):
    """Four loads begin at the same version; one becomes the table and the others say so and leave nothing."""
    path = str(tmp_path / "fact")
    load_fact(small_fact(spark, [{"charge_id": "A"}]), path)
    begin = threading.Barrier(4)
    seen = warehouse._versions

    def at_once(session, folder, first=threading.local()):
        numbers = seen(session, folder)
        if not getattr(first, "done", False):
            first.done = True
            begin.wait()
        return numbers

    facts = {charge: small_fact(spark, [{"charge_id": charge}] * 3) for charge in "BCDE"}
    outcome = {}

    def load(charge):
        try:
            load_fact(facts[charge], path)
            outcome[charge] = "won"
        except LoadConflict:
            outcome[charge] = "lost"

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warehouse, "_versions", at_once)
        threads = [threading.Thread(target=load, args=(charge,)) for charge in facts]
        for thread in threads:
            thread.start()
        for thread in threads:
            thread.join()
    assert sorted(outcome.values()) == ["lost"] * 3 + ["won"]
    (winner,) = (charge for charge, result in outcome.items() if result == "won")
    assert [r.Charge_ID for r in read_fact(spark, path).collect()] == [winner]
    assert len(list(Path(path).glob("version-*"))) == 2


def test_a_number_that_was_cut_away_is_given_back(spark, tmp_path):
    path = str(tmp_path / "fact")
    for charge in "ABCD":
        load_fact(small_fact(spark, [{"charge_id": charge}]), path)
    warehouse.store_checked(warehouse_rows(small_fact(spark, [{"charge_id": "E"}])), f"{path}/version-slow")
    with pytest.raises(LoadConflict):
        warehouse.commit(spark, path, "version-slow", 2)
    assert [r.Charge_ID for r in read_fact(spark, path).collect()] == ["D"]
    assert not (tmp_path / "fact" / "version-slow").exists()
    assert [int(p.name) for p in sorted((tmp_path / "fact" / "_versions").iterdir())] == [3, 4]


def test_a_small_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "log" / "000000000007")
    assert create_file(spark, path, "one")
    assert not create_file(spark, path, "two")
    assert read_file(spark, path) == "one"
    assert file_names(spark, str(tmp_path / "log")) == ["000000000007"]
    assert file_names(spark, str(tmp_path / "nowhere")) == []


def test_leftovers_of_broken_loads_go(spark, tmp_path):
    path = str(tmp_path / "fact")
    load_fact(small_fact(spark, [{"charge_id": "A"}]), path)
    (tmp_path / "fact" / "version-broken").mkdir()
    assert warehouse.remove_leftovers(spark, path, hours=1) == []
    assert warehouse.remove_leftovers(spark, path, hours=-1) == ["version-broken"]
    assert [r.Charge_ID for r in read_fact(spark, path).collect()] == ["A"]


def test_a_table_that_was_never_loaded(spark, tmp_path):
    with pytest.raises(ValueError, match="no load"):
        read_fact(spark, str(tmp_path))


def test_the_contract_is_counted_while_writing(spark, tmp_path):
    """The same counts as from the stored rows, with the key as the only column read again."""
    charges = [{"charge_id": "A", "source_id": s, "amt": None} for s in ("1", "2")] + [{"charge_id": "B"}]
    fact = small_fact(spark, charges)
    read = []
    real = warehouse._repeated_keys

    def repeated(rows):
        counted = real(rows)
        read.append(counted._jdf.queryExecution().executedPlan().toString())
        return counted

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warehouse, "_repeated_keys", repeated)
        found = warehouse.store_checked(warehouse_rows(fact), str(tmp_path / "rows"))
    assert {(rule, column): n for rule, column, n in found if n} == broken(fact)
    assert len(found) == 19 and len(read) == 1
    assert "ReadSchema: struct<Charge_ID:string>" in read[0]


def test_nothing_is_counted_in_an_empty_table(spark, tmp_path):
    found = warehouse.store_checked(warehouse_rows(small_fact(spark)), str(tmp_path / "rows"))
    assert len(found) == 19 and not any(n for _, _, n in found)


def test_stored_copies_go_below_the_checkpoint_folder(spark):
    folder = shared_folder(spark)
    assert Path(folder).parent == Path(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) != folder


def test_a_practice_with_many_rows_is_split_over_files(spark, staged, tmp_path):
    """One practice holds nearly all rows; the rebalancing cuts it by size."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
        # As many input splits as a large table would have.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    fact = charge_fact(staged, ALL_PRACTICES)
    fact = fact.withColumn("practice_id", F.when(F.xxhash64("charge_id") % 50 != 0, "0001").otherwise("0002"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        load_fact(fact, str(tmp_path / "fact"))
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(list((tmp_path / "fact").glob("version-*/Practice_ID=0001/*.parquet"))) > 2
    assert len(list((tmp_path / "fact").glob("version-*/Practice_ID=0002/*.parquet"))) <= 2


def small_table(spark):
    return warehouse_rows(small_fact(spark, [{"charge_id": c, "source_id": s} for c, s in (("A", "1"), ("B", "3"))]))


def test_a_few_practices_are_written_where_they_are(spark, staged, tmp_path):
    """Each task leaves a file per practice, and the rows do not move for it; of unknown practices they do."""
    fact = charge_fact(staged, ["0001"]).localCheckpoint().repartition(4)
    for name, practices, files in (("few", 1, 4), ("many", 9, 1), ("unknown", None, 1)):
        same_rows(load_fact(fact, str(tmp_path / name), practices), warehouse_rows(fact))
        assert len(list((tmp_path / name).glob("version-*/Practice_ID=0001/*.parquet"))) == files


def test_rows_are_checked_without_folders_too(spark, tmp_path):
    rows = warehouse_rows(small_fact(spark, [{"charge_id": "A", "source_id": s, "amt": None} for s in "123"]))
    by_practice = warehouse.store_checked(rows, str(tmp_path / "folders"))
    assert warehouse.store_checked(rows, str(tmp_path / "plain"), by=()) == by_practice
    assert not list((tmp_path / "plain").glob("Practice_ID=*"))
    same_rows(spark.read.schema(F_TRANSACTIONS).parquet(str(tmp_path / "plain")), rows)


def test_only_what_can_be_null_is_counted(spark):
    rows = spark.sql("select 'C' as Charge_ID, cast(null as string) as Guar_Type, 'P' as Practice_ID")
    counted = rows.agg(*warehouse._possible_nulls(rows))
    assert counted.columns == ["Guar_Type"] and counted.first().Guar_Type == 1
    assert rows.drop("Guar_Type").agg(*warehouse._possible_nulls(rows.drop("Guar_Type"))).count() == 1


def test_keys_are_compared_where_hashes_meet(spark, tmp_path, monkeypatch):
    """A hash of two keys is no violation, and without repeated hashes the keys are not grouped."""
    rows = small_table(spark)
    grouped, real = [], warehouse._repeated_keys
    monkeypatch.setattr(warehouse, "_repeated_keys", lambda found: (grouped.append(1), real(found))[1])
    assert warehouse.store_checked(rows, str(tmp_path / "a"))[-1][2] == 0 and not grouped
    met = spark.sql("select 1L as violations")
    monkeypatch.setattr(warehouse, "_repeated_hashes", lambda found: met)
    assert warehouse.store_checked(rows, str(tmp_path / "b"))[-1][2] == 0 and grouped
