"""Sums that must hold on any data, checked on the staged tables at the middle size."""

import pytest
from pyspark.sql import functions as F

from claimledger.operators import measures
from claimledger.operators.lookups import chosen_guarantors
from claimledger.plans.charge_fact import charge_fact, charge_transactions
from claimledger.plans.encounter_balances import encounter_balances
from claimledger.sources.staging import ALL_PRACTICES, stage_billing


@pytest.fixture(scope="module")
def billing(spark):
    return stage_billing(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def wide(spark, billing, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "rows")
    encounter_balances(billing, ["0001"]).write.parquet(path)
    return spark.read.parquet(path)


def test_one_row_per_scoped_encounter(billing, wide):
    guarantors = chosen_guarantors(billing.patient_encounter, ["0001"]).rows
    scoped = billing.patient_encounter.join(guarantors, "guar_id", "left_semi").select("practice_id", "enc_id")
    assert wide.count() == scoped.distinct().count() == wide.select("practice_id", "enc_id").distinct().count()
    assert {r[0] for r in wide.select("practice_id").distinct().collect()} == set(ALL_PRACTICES)


def test_account_columns_are_the_same_on_all_rows_of_a_guarantor(wide):
    account = wide.select("guar_id", "acct_id", "acct_nbr", *measures.ACCOUNT_COLUMNS)
    assert account.distinct().count() == wide.select("guar_id").distinct().count()


def test_account_columns_are_sums_of_encounter_columns(wide):
    sources = {name: name.replace("acct_", "enc_") for name in measures.ACCOUNT_COLUMNS}
    sources["acct_self_buc"] = "enc_pat_buc"
    by_guarantor = wide.groupBy("guar_id").agg(
        *[(F.coalesce(F.sum(e), F.lit(0)) - F.first(a)).alias(a) for a, e in sources.items()]
    )
    off = [F.count_if(F.col(a) != 0).alias(a) for a in sources]
    assert set(by_guarantor.agg(*off).first()) == {0}


def test_totals_of_an_encounter_agree(wide):
    off = wide.where(
        (F.col("enc_bal") != F.col("enc_tot_chg") + F.col("enc_pmt_tot") + F.col("enc_ref_adj_amt"))
        | (F.col("enc_ref_adj_amt") != F.col("enc_adj_tot") + F.col("enc_ref_tot"))
        | (F.col("enc_pat_tot") + F.col("enc_ins_tot") != F.col("enc_pmt_tot") + F.col("enc_ref_adj_amt"))
    )
    assert off.count() == 0


def test_bad_debt_only_moves_money(billing, wide):
    before = measures.encounter_charge_sums(billing.charges).withColumnRenamed("enc_pat_buc", "before")
    rows = wide.join(before.select("practice_id", "enc_id", "before"), ["practice_id", "enc_id"])
    after = F.col("enc_pat_buc") + F.col("enc_bad_debt_amt")
    assert rows.where(F.col("enc_status").isNotNull() & (after != F.col("before"))).count() == 0
    assert rows.where(F.col("enc_status").isNull() & F.col("enc_bad_debt_amt").isNotNull()).count() == 0
    assert rows.where("enc_bad_debt_amt > 0").count() > 0


def test_the_fact_holds_every_charge_with_a_guarantor_once(billing):
    fact = charge_fact(billing, ALL_PRACTICES)
    owned = billing.patient_encounter.where("guar_id is not null").select(F.col("enc_id").alias("source_id"))
    charges = billing.charges.join(owned, "source_id", "left_semi")
    total = fact.agg(F.count(F.lit(1)), F.countDistinct("charge_id"), F.sum("chgamt")).first()
    want = charges.agg(F.countDistinct("charge_id"), F.countDistinct("charge_id"), F.sum("amt")).first()
    assert tuple(total) == tuple(want)


def test_posted_payments_are_all_in_the_charge_sums(billing):
    sums = charge_transactions(billing, ALL_PRACTICES).agg(F.sum(F.col("chginspmt") + F.col("chgpatpmt"))).first()[0]
    assert sums == billing.trans_detail.where("post_ind = 'Y'").agg(F.sum("paid_amt")).first()[0]
