"""Every registered query against DuckDB, with columns, types and values."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, sql_rows
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from claimledger.sources.schemas import ENCOUNTER_BALANCES
from tests.conftest import SMALL


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE_SQL.items() <= contract.oracle_sql().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SMALL, name) == ""


def test_the_flawed_tables_break_the_contract(spark):
    found = {(r.rule, r.column_name): r.violations for r in QUERIES["flawed_fact_contract_violations"](spark, SMALL).collect()}
    broken = {column for (rule, column), count in found.items() if count}
    assert broken == {"Guar_Type", "Gross_Charges", "Curr_Enc_Bal", "Charge_ID"}


def test_headers_of_other_practices_would_change_the_encounter_sums(con):
    sql = ORACLE_SQL["flawed_encounter_trans_sums"]
    by_id = sql.replace("transactions h using (trans_id, practice_id)", "transactions h on h.trans_id = d.trans_id")
    assert by_id != sql and sql_rows(con, by_id) != sql_rows(con, sql)


@pytest.mark.parametrize("name", ["encounter_attributes", "charge_trans_sums", "encounter_balances", "charge_fact"])
def test_a_flawed_query_differs_from_the_plain_one(con, name):
    """Otherwise it could not fail where a rule is left out."""
    assert sql_rows(con, ORACLE_SQL[name]) != sql_rows(con, ORACLE_SQL[f"flawed_{name}"])


def test_fewer_practices_make_another_fact(con):
    everything = sql_rows(con, ORACLE_SQL["charge_fact"])[1]
    some = sql_rows(con, ORACLE_SQL["charge_fact_of_practices"])[1]
    assert 0 < len(some) < len(everything)


def test_entry_has_the_declared_columns(spark):
    wide = contract.entry(spark)
    assert [(f.name, f.dataType) for f in wide.schema] == [(f.name, f.dataType) for f in ENCOUNTER_BALANCES]
    assert len(wide.columns) == 73
