"""Amounts in parts: exact, and short code for the JVM."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimledger.functions.expressions import amount_carried, amount_of_parts, amount_parts
from claimledger.plans.charge_fact import charge_fact
from claimledger.plans.encounter_balances import encounter_balances
from claimledger.sources.billing import read_billing
from claimledger.sources.schemas import MONEY
from claimledger.sources.staging import ALL_PRACTICES

LARGEST = Decimal("999999999999999.9999")
AMOUNTS = [Decimal(x) for x in ("0", "0.0001", "0.3", "99999.9999", "100000", "100000.0001", "1234567890123.4567")]
AMOUNTS = [None, LARGEST, -LARGEST, *AMOUNTS, *(-x for x in AMOUNTS)]
# The JVM compiles no method with more.
LONGEST = 8000


@pytest.fixture
def amounts(spark):
    return spark.createDataFrame(list(enumerate(AMOUNTS)), f"id int, amount {MONEY.simpleString()}")


def test_parts_give_the_amount_back(amounts):
    high, low = amount_parts(F.col("amount"))
    parted = amounts.select("id", "amount", high.alias("high"), low.alias("low"))
    back = parted.select("id", "amount", amount_of_parts(F.col("high"), F.col("low")).alias("back"))
    assert [r.back for r in back.orderBy("id").collect()] == [r.amount for r in back.orderBy("id").collect()]
    assert parted.where("abs(low) >= 1000000000").count() == 0


def test_sums_in_parts_are_exact_and_carry(amounts):
    many = amounts.where("abs(amount) < 99999999999999").crossJoin(amounts.sparkSession.range(30_000)).where("amount > 0")
    high, low = amount_parts(F.col("amount"))
    summed = many.select(high.alias("high"), low.alias("low"), "amount").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("amount").cast("decimal(38,4)").alias("want")
    )
    high, low = amount_carried(F.col("high"), F.col("low"))
    for parts in ((F.col("high"), F.col("low")), (high, low)):
        # Within the range after one part is taken off again.
        got = summed.select((parts[0] * 100_000 + parts[1] * F.lit(Decimal("0.0001"))).cast("decimal(38,4)"), "want").first()
        assert got[0] == got[1]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        summed.select(amount_of_parts(F.col("high"), F.col("low"))).collect()


@pytest.mark.parametrize("job", [encounter_balances, charge_fact])
def test_generated_code_is_short_enough_to_be_compiled(spark, stored, job):
    """Longer code runs interpreted, several times slower."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        code = job(read_billing(spark, stored), ALL_PRACTICES)._jdf.queryExecution().debug().codegenToSeq()
        sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sizes and max(sizes) < LONGEST, sizes
