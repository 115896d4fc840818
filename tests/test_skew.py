"""The jobs on skewed tables, with bounds so low that every join takes its large-and-hot way."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.compare import sql_rows, spark_rows
from checks.oracle import full_sql
from claimledger.operators import joins
from claimledger.plans.charge_fact import charge_fact, charge_transactions
from claimledger.plans.encounter_balances import encounter_balances
from claimledger.sources.staging import ALL_PRACTICES
from tests.conftest import same_rows

@pytest.fixture
def every_join_hot(monkeypatch, spark):
    monkeypatch.setattr(joins, "SLICE_ROWS", 100)
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def copies(df, count):
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(count)))).drop("copy")


def skewed(b):
    """A third of the rows under one guarantor, patient, location, payer, transaction and charge,
    and a third of the rows of each fact copies of one row."""
    third = F.xxhash64("enc_id") % 3 == 0
    third_of_lines = F.xxhash64("source_id", "charge_id") % 3 == 0
    encounters = b.patient_encounter.withColumns(
        {
            "guar_id": F.when(third, "1").otherwise(F.col("guar_id")),
            "person_id": F.when(third, "2").otherwise(F.col("person_id")),
            "location_id": F.when(third, "3").otherwise(F.col("location_id")),
        }
    )
    encounters = encounters.union(copies(encounters.orderBy("enc_id").limit(1), 700))
    lines = b.trans_detail.withColumn("trans_id", F.when(third_of_lines, "HOT").otherwise(F.col("trans_id")))
    lines = lines.union(copies(lines.where("trans_id = 'HOT'").orderBy("charge_id").limit(1), 2000))
    headers = b.transactions.union(
        b.practice.select("practice_id", F.lit("HOT"), F.lit("P"), F.lit("A"))
    ).union(b.practice.select("practice_id", F.lit("HOT"), F.lit("T"), F.lit("R")))
    charges = b.charges.withColumn("charge_id", F.when(third_of_lines, "HOT").otherwise(F.col("charge_id")))
    payers = b.encounter_payer.withColumn(
        "payer_id", F.when(F.xxhash64("enc_id", "cob") % 3 == 0, "1").otherwise(F.col("payer_id"))
    )
    relations = b.person_relationship.withColumn(
        "relation_code", F.when(F.xxhash64("person_id") % 3 == 0, "7").otherwise(F.col("relation_code"))
    )
    return replace(
        b,
        patient_encounter=encounters,
        trans_detail=lines,
        transactions=headers,
        charges=charges,
        encounter_payer=payers,
        person_relationship=relations,
    )


@pytest.fixture(scope="module")
def skewed_tables(spark, staged, tmp_path_factory):
    """The skewed tables, stored, so that each test reads the same rows."""
    root = tmp_path_factory.mktemp("skewed")
    tables = {}
    for name, df in vars(skewed(staged)).items():
        df.write.parquet(f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
    return type(staged)(**tables)


JOBS = {
    "balances": lambda b: encounter_balances(b, ALL_PRACTICES),
    "balances_of_one_practice": lambda b: encounter_balances(b, ["0001"]),
    "fact": lambda b: charge_fact(b, ALL_PRACTICES),
    "transactions": lambda b: charge_transactions(b, ALL_PRACTICES),
}


@pytest.fixture(scope="module")
def plain(spark, skewed_tables, tmp_path_factory):
    """Results at the real bounds, where nothing is sliced."""
    root = tmp_path_factory.mktemp("plain")
    for name, job in JOBS.items():
        job(skewed_tables).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in JOBS}


@pytest.mark.parametrize("name", list(JOBS))
def test_slicing_every_join_gives_the_same_rows(plain, every_join_hot, skewed_tables, name):
    result = JOBS[name](skewed_tables)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan
    same_rows(result, plain[name])


@pytest.mark.parametrize(
    ("name", "job"),
    [("encounter_balances", "balances"), ("charge_fact", "fact"), ("charge_trans_sums", "transactions")],
)
def test_sliced_jobs_match_sql(every_join_hot, skewed_tables, con, name, job):
    _, got = spark_rows(JOBS[job](skewed_tables))
    tables = {
        table: f"select * from read_parquet('{df.inputFiles()[0].rsplit('/', 1)[0]}/*.parquet')"
        for table, df in vars(skewed_tables).items()
    }
    _, want = sql_rows(con, full_sql(name, tables))
    assert len(got) == len(want)
    assert got == want
