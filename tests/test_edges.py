"""Hand-made rows for the rules that the staged data cannot show."""

import datetime

import pytest

from claimledger.operators import joins
from claimledger.plans.charge_fact import charge_fact, charge_fact_sample, charge_transactions
from claimledger.plans.encounter_balances import encounter_balances
from claimledger.sources.staging import ALL_PRACTICES
from tests.conftest import dollars, make_billing

P1, P2 = "0001", "0002"


@pytest.fixture(autouse=True, scope="module")
def tiny(spark):
    """Cheap settings for plans over a handful of rows."""
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.codegen.wholeStage")}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def encounter(enc_id, guar_id="G", practice_id=P1, **more):
    return {"practice_id": practice_id, "enc_id": enc_id, "guar_id": guar_id, "guar_type": "P", **more}


def charge(charge_id="C", source_id="1", practice_id=P1, amt=100, cob1=0, cob2=0, cob3=0, pat=0):
    return {
        "practice_id": practice_id,
        "source_id": source_id,
        "charge_id": charge_id,
        "amt": amt,
        "cob1_amt": cob1,
        "cob2_amt": cob2,
        "cob3_amt": cob3,
        "pat_amt": pat,
    }


def detail(trans_id="X", charge_id="C", source_id="1", practice_id=P1, paid=0, adj=0, post_ind="Y"):
    return {
        "practice_id": practice_id,
        "trans_id": trans_id,
        "source_id": source_id,
        "charge_id": charge_id,
        "paid_amt": paid,
        "adj_amt": adj,
        "post_ind": post_ind,
    }


def header(trans_id="X", source="P", type=None, practice_id=P1):
    return {"practice_id": practice_id, "trans_id": trans_id, "source": source, "type": type}


def balances(spark, practices=(P1,), numbers=None, **tables):
    rows = encounter_balances(make_billing(spark, **tables), practices, numbers).collect()
    return {(r.practice_id, r.enc_id): r for r in rows}


def fact(spark, practices=(P1, P2), **tables):
    rows = charge_fact(make_billing(spark, **tables), practices).collect()
    return {(r.practice_id, r.enc_id, r.charge_id): r for r in rows}


def test_null_transaction_type_is_neither_adjustment_nor_refund(spark):
    tables = {
        "patient_encounter": [encounter("1")],
        "charges": [charge()],
        "trans_detail": [
            detail("N", adj=-5),
            detail("R", adj=-3),
            detail("A", adj=-2),
            detail("A", adj=-1, post_ind=None),
        ],
        "transactions": [header("N", type=None), header("R", type="R"), header("A", type="A")],
    }
    row = balances(spark, **tables)[P1, "1"]
    assert (row.enc_pat_adj, row.enc_pat_ref) == (dollars(-2), dollars(-3))
    row = fact(spark, **tables)[P1, "1", "C"]
    assert (row.chgpatadj, row.chgpatref) == (dollars(-2), dollars(-3))


def test_sources_other_than_patient_and_insurance_do_not_count(spark):
    tables = {
        "patient_encounter": [encounter("1")],
        "charges": [charge()],
        "trans_detail": [detail("T", paid=-4), detail("Z", paid=-9), detail("U", paid=-9)],
        "transactions": [header("T", source="T"), header("Z", source="Z"), header("U", source=None)],
    }
    row = balances(spark, **tables)[P1, "1"]
    assert (row.enc_ins_pmt, row.enc_pat_pmt) == (dollars(-4), dollars(0))


def test_unposted_payment_counts_for_the_encounter_but_not_for_the_charge(spark):
    tables = {
        "patient_encounter": [encounter("1")],
        "charges": [charge()],
        "trans_detail": [detail(paid=-7, post_ind="N")],
        "transactions": [header()],
    }
    assert balances(spark, **tables)[P1, "1"].enc_pat_pmt == dollars(-7)
    assert fact(spark, **tables)[P1, "1", "C"].chgpatpmt == dollars(0)


def test_a_transaction_id_in_two_practices(spark):
    tables = {
        "patient_encounter": [encounter("1")],
        "charges": [charge()],
        "trans_detail": [detail(paid=-10)],
        "transactions": [header(practice_id=P1), header(practice_id=P2)],
    }
    assert balances(spark, **tables)[P1, "1"].enc_pat_pmt == dollars(-10)
    row = fact(spark, **tables)[P1, "1", "C"]
    assert row.chgpatpmt == dollars(-20)
    assert row.chgencbal == dollars(80)


def test_headers_of_one_id_count_by_source_and_type(spark):
    tables = {
        "patient_encounter": [encounter("1")],
        "charges": [charge()],
        "trans_detail": [detail(paid=-10, adj=-1)],
        "transactions": [
            header(source="T", type="R"),
            header(source="T", type="A", practice_id=P2),
            header(source="P", type="A", practice_id="0003"),
            header(source="P", type="A", practice_id="0004"),
        ],
    }
    row = fact(spark, **tables)[P1, "1", "C"]
    assert (row.chginspmt, row.chgpatpmt) == (dollars(-20), dollars(-20))
    assert (row.chginsadj, row.chginsref) == (dollars(-1), dollars(-1))
    assert (row.chgpatadj, row.chgpatref) == (dollars(-2), dollars(0))


@pytest.mark.parametrize(
    ("status", "bucket", "bad_debt", "text"),
    [
        ("A", 0, 40, "Bad Debt"),
        ("B", 40, 0, "Billed"),
        ("H", 40, 0, "History"),
        ("R", 40, 0, "Rebill"),
        ("U", 40, 0, "Unbilled"),
        (None, 40, None, "Unbilled"),
    ],
)
def test_bad_debt_and_status(spark, status, bucket, bad_debt, text):
    row = balances(spark, patient_encounter=[encounter("1", enc_status=status)], charges=[charge(amt=100, pat=40)])[
        P1, "1"
    ]
    assert row.enc_pat_buc == dollars(bucket)
    assert row.enc_bad_debt_amt == dollars(bad_debt)
    assert row.enc_status_desc == text
    assert row.enc_bal == dollars(100)
    assert row.acct_self_buc == dollars(bucket)
    assert row.acct_bad_debt_amt == dollars(bad_debt or 0)


def test_encounter_without_charges_or_transactions_has_zeros(spark):
    row = balances(spark, patient_encounter=[encounter("1")])[P1, "1"]
    sums = "tot_chg ins_buc1 ins_buc2 ins_buc3 pat_buc ins_pmt ins_adj ins_ref pat_pmt pat_adj pat_ref".split()
    assert [row[f"enc_{s}"] for s in sums] == [dollars(0)] * 11
    assert row.enc_bal == row.acct_bal == dollars(0)


def test_null_amounts_stay_null_in_the_fact_but_not_in_the_encounter(spark):
    tables = {
        "patient_encounter": [encounter("1")],
        "charges": [charge(amt=None, cob1=None, cob2=1, cob3=1, pat=None)],
    }
    row = fact(spark, **tables)[P1, "1", "C"]
    assert (row.chgamt, row.chgencbal, row.chginsbal, row.chgpat) == (None, None, None, None)
    assert (row.chgcob2, row.chginspmt) == (dollars(1), dollars(0))
    assert balances(spark, **tables)[P1, "1"].enc_tot_chg == dollars(0)


def test_charge_lines_are_summed(spark):
    row = fact(
        spark,
        patient_encounter=[encounter("1")],
        charges=[charge(amt=1, cob1=1), charge(amt=2, cob2=2), charge(amt=None), charge(amt=4, cob3=4)],
    )[P1, "1", "C"]
    assert (row.chgamt, row.chginsbal) == (dollars(7), dollars(7))


def test_charge_under_two_encounters_has_its_transactions_twice(spark):
    tables = {
        "patient_encounter": [encounter("1"), encounter("2")],
        "charges": [charge(source_id="1"), charge(source_id="2")],
        "trans_detail": [detail(paid=-10)],
        "transactions": [header()],
    }
    rows = fact(spark, **tables)
    assert {k: r.chgpatpmt for k, r in rows.items()} == {
        (P1, "1", "C"): dollars(-10),
        (P1, "2", "C"): dollars(-10),
    }
    assert charge_transactions(make_billing(spark, **tables), [P1]).count() == 1


def test_transactions_attach_within_their_practice_only(spark):
    rows = fact(
        spark,
        patient_encounter=[encounter("1")],
        charges=[charge(practice_id=P1), charge(practice_id=P2)],
        trans_detail=[detail(practice_id=P2, paid=-10)],
        transactions=[header(practice_id=P2)],
    )
    assert rows[P1, "1", "C"].chgpatpmt == dollars(0)
    assert rows[P2, "1", "C"].chgpatpmt == dollars(-10)


def test_charges_without_encounter_or_guarantor_are_dropped(spark):
    rows = fact(
        spark,
        patient_encounter=[encounter("1"), encounter("2", guar_id=None), encounter("4", guar_type=None)],
        charges=[charge(source_id=s) for s in ("1", "2", "3", "4")],
    )
    assert {k[1] for k in rows} == {"1", "4"}
    assert rows[P1, "4", "C"].guar_type is None


def test_the_fact_is_limited_to_the_practices_named(spark):
    tables = {
        "patient_encounter": [encounter("1")],
        "charges": [charge(practice_id=p) for p in (P1, P2, "0003")],
    }
    assert {k[0] for k in fact(spark, practices=[P1, "0003"], **tables)} == {P1, "0003"}


def test_a_guarantor_brings_encounters_of_every_practice(spark):
    tables = {
        "patient_encounter": [
            encounter("1", enc_nbr=11),
            encounter("2", practice_id=P2, enc_nbr=12),
            encounter("3", guar_id="H", enc_nbr=13),
            encounter("4", guar_id="K", practice_id=P2, enc_nbr=11),
            encounter("5", guar_id=None, enc_nbr=11),
        ],
        "charges": [charge(amt=1), charge(source_id="2", practice_id=P2, amt=2), charge(source_id="3", amt=4)],
    }
    by_practice = balances(spark, **tables)
    assert set(by_practice) == {(P1, "1"), (P2, "2"), (P1, "3")}
    by_number = balances(spark, numbers=["11"], **tables)
    assert set(by_number) == {(P1, "1"), (P2, "2")}
    assert {r.acct_tot_chg for r in by_number.values()} == {dollars(3)}
    assert by_practice[P1, "3"].acct_tot_chg == dollars(4)


def test_charges_count_in_their_own_practice_only(spark):
    rows = balances(
        spark,
        practices=[P1, P2],
        patient_encounter=[encounter("1"), encounter("1", practice_id=P2, guar_id="H")],
        charges=[charge(amt=1), charge(practice_id=P2, amt=2)],
    )
    assert {k: r.enc_tot_chg for k, r in rows.items()} == {(P1, "1"): dollars(1), (P2, "1"): dollars(2)}
    assert rows[P2, "1"].guar_id == "H"


def test_encounter_numbers_must_be_numbers(spark):
    with pytest.raises(ArithmeticError):
        balances(spark, numbers=["x"], patient_encounter=[encounter("1")])


def test_names(spark):
    rows = balances(
        spark,
        patient_encounter=[
            encounter("1", person_id="none"),
            encounter("2", person_id="last"),
            encounter("3", person_id="first"),
            encounter("4", person_id="missing"),
            encounter("5"),
        ],
        person=[
            {"person_id": "none"},
            {"person_id": "last", "last_name": "Doe"},
            {"person_id": "first", "first_name": "Jo"},
        ],
    )
    assert [rows[P1, e].person_name for e in "12345"] == [", ", "Doe, ", ", Jo", None, None]


def test_guarantor_type_decides_where_the_name_comes_from(spark):
    rows = balances(
        spark,
        patient_encounter=[
            encounter("1", "G", guar_type="P"),
            encounter("2", "G", guar_type="E"),
            encounter("3", "H", guar_type="E"),
            encounter("4", "G", guar_type=None),
            encounter("5", "G", guar_type="Z"),
        ],
        person=[{"person_id": g, "last_name": "Doe", "first_name": "Jo"} for g in "GH"],
        employer_mstr=[{"employer_id": "G", "name": "Acme"}],
    )
    assert [rows[P1, e].guar_name for e in "12345"] == ["Doe, Jo", "Acme", None, None, None]


def test_list_types_are_patterns(spark):
    def item(list_type, key, text):
        return {"mstr_list_type": list_type, "mstr_list_item_id": key, "mstr_list_item_desc": text}

    row = balances(
        spark,
        patient_encounter=[encounter("1", patient_type_id="T")],
        encounter_payer=[{"enc_id": "1", "cob": 2, "payer_id": "Y"}],
        payer_mstr=[{"payer_id": "Y", "payer_name": "Yes", "financial_class": "F"}],
        mstr_lists=[
            item("patXtype", "T", "type"),
            item("pat_types", "T", "no"),
            item("finXclass", "F", "class"),
            item("fin_class ", "F", "no"),
        ],
    )[P1, "1"]
    assert row.pat_type_desc == "type"
    assert (row.payer2_name, row.payer2_fc_id, row.payer2_fin_class) == ("Yes", "F", "class")
    assert (row.payer1_id, row.payer1_name, row.payer3_fin_class) == (None, None, None)


def test_relationship(spark):
    rows = balances(
        spark,
        patient_encounter=[
            encounter("1", person_id="A"),
            encounter("2", person_id="B"),
            encounter("3", person_id="C"),
        ],
        person_relationship=[
            {"person_id": "G", "related_person_id": "A", "relation_code": "1"},
            {"person_id": "G", "related_person_id": "B", "relation_code": "2"},
            {"person_id": "C", "related_person_id": "G", "relation_code": "1"},
        ],
        code_tables=[
            {"code_type": "other", "code": "1", "description": "no"},
            {"code_type": "relation", "code": "1", "description": "child"},
        ],
    )
    found = [(rows[P1, e].relationship_id, rows[P1, e].relationship_desc) for e in "123"]
    assert found == [("1", "child"), ("2", None), (None, None)]


def test_duplicate_lookup_rows_do_not_add_rows(spark):
    rows = balances(
        spark,
        patient_encounter=[encounter("1", location_id="L", person_id="A")] * 3,
        encounter_payer=[{"enc_id": "1", "cob": 1, "payer_id": p} for p in ("Y", "X")],
        payer_mstr=[{"payer_id": "X", "payer_name": n} for n in ("b", "a")],
        accounts=[{"acct_id": a, "acct_nbr": 1, "guar_id": "G"} for a in ("a2", "a1")],
        practice=[{"practice_id": P1, "practice_name": n} for n in ("q", "p")],
        location_mstr=[{"location_id": "L", "location_name": n} for n in ("m", "l")],
        person=[{"person_id": "A", "last_name": n} for n in ("n", "m")],
        charges=[charge(amt=5)],
    )
    assert len(rows) == 1
    row = rows[P1, "1"]
    assert (row.payer1_id, row.payer1_name, row.acct_id, row.practice_name) == ("X", "a", "a1", "p")
    assert (row.location_name, row.person_name) == ("l", "m, ")
    assert row.acct_tot_chg == dollars(5)


def test_date_of_service_has_no_time_of_day(spark):
    late = datetime.datetime(2024, 2, 29, 23, 59, 59, 999000)
    row = balances(spark, patient_encounter=[encounter("1", enc_timestamp=late, pat_resp_date="02/30/24")])[P1, "1"]
    assert row.dos == datetime.date(2024, 2, 29)
    assert row.pat_resp_date == "02/30/24"


def test_sample_is_the_first_rows_by_key(spark):
    tables = make_billing(
        spark,
        patient_encounter=[encounter("1")],
        charges=[charge(charge_id=f"{n:03}") for n in range(150)],
    )
    sample = charge_fact_sample(charge_fact(tables, [P1])).collect()
    assert sorted(r.charge_id for r in sample) == [f"{n:03}" for n in range(100)]


def test_money_beyond_its_range_is_an_error(spark):
    tables = make_billing(
        spark,
        patient_encounter=[encounter("1")],
        charges=[charge(amt="900000000000000.0000")] * 2,
    )
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        charge_fact(tables, [P1]).collect()


def test_an_encounter_with_and_without_guarantor_keeps_its_charges(spark):
    tables = make_billing(
        spark,
        patient_encounter=[
            {"practice_id": "0001", "enc_id": "1", "guar_id": None, "guar_type": "P"},
            {"practice_id": "0002", "enc_id": "1", "guar_id": "G", "guar_type": "P"},
        ],
        charges=[{"practice_id": "0001", "source_id": "1", "charge_id": "C", "amt": 1}],
    )
    assert [(r.charge_id, r.guar_id) for r in charge_fact(tables, ALL_PRACTICES).collect()] == [("C", "G")]


def test_amounts_that_cancel_beyond_the_range(spark, monkeypatch):
    """The same rows give the same sum on the plain and on the sliced way."""
    lines = [("T1", 6e14), ("T1", 6e14), ("T2", -6e14), ("T2", -6e14)]
    tables = make_billing(
        spark,
        patient_encounter=[{"practice_id": "0001", "enc_id": "1", "guar_id": "G", "guar_type": "P"}],
        charges=[{"practice_id": "0001", "source_id": "1", "charge_id": "C", "amt": 1}],
        trans_detail=[
            {"practice_id": "0001", "trans_id": t, "source_id": "1", "charge_id": "C", "paid_amt": a, "post_ind": "Y"}
            for t, a in lines
        ],
        transactions=[{"practice_id": "0001", "trans_id": t, "source": "P"} for t in ("T1", "T2")],
    )
    plain = charge_fact(tables, ALL_PRACTICES).collect()
    monkeypatch.setattr(joins, "SLICE_ROWS", 1)
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    sliced = charge_fact(tables, ALL_PRACTICES).collect()
    assert plain == sliced
    assert plain[0].chgpatpmt == dollars(0)


def test_an_overflow_is_an_error_without_ansi_too(spark):
    charges = [{"practice_id": "0001", "source_id": "1", "charge_id": "C", "amt": 9e14}] * 3
    tables = make_billing(
        spark, patient_encounter=[{"practice_id": "0001", "enc_id": "1", "guar_id": "G", "guar_type": "P"}], charges=charges
    )
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
            charge_fact(tables, ALL_PRACTICES).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
