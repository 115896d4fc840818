"""Recast the generic test tables (orders, lineitem, customer, ...) as billing tables.

The expressions follow the specification in ``FIXTURES.md``; each reads only the columns it needs.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimledger.sources.billing import Billing
from claimledger.sources.schemas import ACCOUNT_NUMBER, ENCOUNTER_NUMBER, MONEY

# The columns used of the test tables. Declared, so that reading needs no job to infer them.
TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string",
}

# The practices of the remainders -4 to 4.
PRACTICE_BY_REMAINDER = [str(remainder + 1).rjust(4, "0") for remainder in range(-4, 5)]

# Every practice the staged tables hold.
ALL_PRACTICES = ("0001", "0002", "0003", "0004", "0005")


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _practice(column: str) -> Column:
    """``lpad(key % 5 + 1, 4, '0')``, for remainders of negative keys too, looked up as it is needed on every row."""
    return F.element_at(F.lit(PRACTICE_BY_REMAINDER), (F.col(column) % 5 + 5).cast("int"))


def _charge_id() -> Column:
    return F.concat_ws("-", *[_text(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])


def _trans_id() -> Column:
    return F.concat_ws("-", _text(F.col("l_orderkey") % 5 + 1), _text("l_suppkey"), "l_linestatus", "l_returnflag")


def _patient_encounter(orders: DataFrame) -> DataFrame:
    key, customer, priority = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    status = (
        F.when(priority == "1-URGENT", "A")
        .when(priority == "2-HIGH", "B")
        .when(priority == "3-MEDIUM", "H")
        .when(priority == "4-NOT SPECIFIED", "R")
        .when(key % 2 == 0, "U")
    )
    return orders.select(
        _practice("o_orderkey").alias("practice_id"),
        _text(key).alias("enc_id"),
        key.cast(ENCOUNTER_NUMBER).alias("enc_nbr"),
        F.when(key % 97 != 0, _text(customer)).alias("guar_id"),
        F.when(customer % 4 == 0, "E").otherwise("P").alias("guar_type"),
        _text(F.when(key % 3 == 0, customer).otherwise(customer + 1)).alias("person_id"),
        status.alias("enc_status"),
        _text(key % 27).alias("location_id"),
        F.col("o_orderdate").alias("enc_timestamp"),
        _text(F.to_date("o_orderdate")).alias("pat_resp_date"),
        F.concat(F.lit("PT"), "o_orderstatus").alias("patient_type_id"),
    )


def _charges(lineitem: DataFrame) -> DataFrame:
    price, line = F.col("price"), F.col("l_linenumber")

    def bucket(*lines: int) -> Column:
        return F.when(line.isin(*lines), price).otherwise(F.lit(0).cast(MONEY))

    return lineitem.withColumn("price", F.col("l_extendedprice").cast(MONEY)).select(
        _practice("l_orderkey").alias("practice_id"),
        _text("l_orderkey").alias("source_id"),
        _charge_id().alias("charge_id"),
        price.alias("amt"),
        bucket(1, 2).alias("cob1_amt"),
        bucket(3, 4).alias("cob2_amt"),
        bucket(5).alias("cob3_amt"),
        bucket(6, 7).alias("pat_amt"),
    )


def _trans_detail(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        _practice("l_orderkey").alias("practice_id"),
        _trans_id().alias("trans_id"),
        _text("l_orderkey").alias("source_id"),
        _charge_id().alias("charge_id"),
        (-F.col("l_quantity")).cast(MONEY).alias("paid_amt"),
        (-F.col("l_discount")).cast(MONEY).alias("adj_amt"),
        F.when(F.col("l_linenumber") % 3 == 0, "N").otherwise("Y").alias("post_ind"),
    )


def _transactions(lineitem: DataFrame) -> DataFrame:
    # Distinct on the parts first: the ids are one-to-one with them, and dear to build per line.
    parts = lineitem.select(
        (F.col("l_orderkey") % 5).alias("l_orderkey"), "l_suppkey", "l_linestatus", "l_returnflag"
    ).distinct()
    return parts.select(
        _practice("l_orderkey").alias("practice_id"),
        _trans_id().alias("trans_id"),
        F.when(F.col("l_linestatus") == "F", "P").otherwise("T").alias("source"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("type"),
    )


def stage_billing(spark: SparkSession, sf_dir: str) -> Billing:
    def table(name: str) -> DataFrame:
        return spark.read.schema(TEST_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    orders, lineitem, customer = table("orders"), table("lineitem"), table("customer")
    nation, region, supplier = table("nation"), table("region"), table("supplier")
    customer_id = F.col("c_custkey")

    relations = nation.select(_text("n_nationkey").alias("code"), F.col("n_name").alias("description"))
    patient_types = (
        orders.where(F.col("o_orderstatus") != "P")
        .select("o_orderstatus")
        .distinct()
        .select(
            F.lit("pat_type").alias("mstr_list_type"),
            F.concat(F.lit("PT"), "o_orderstatus").alias("mstr_list_item_id"),
            F.concat(F.lit("Type "), "o_orderstatus").alias("mstr_list_item_desc"),
        )
    )
    classes = region.where(F.col("r_regionkey") < 4).select(
        F.lit("fin_class").alias("mstr_list_type"),
        F.concat(F.lit("FC"), _text("r_regionkey")).alias("mstr_list_item_id"),
        F.col("r_name").alias("mstr_list_item_desc"),
    )

    return Billing(
        patient_encounter=_patient_encounter(orders),
        accounts=customer.select(
            F.concat(F.lit("A"), _text("c_custkey")).alias("acct_id"),
            customer_id.cast(ACCOUNT_NUMBER).alias("acct_nbr"),
            _text("c_custkey").alias("guar_id"),
        ),
        encounter_payer=lineitem.where(F.col("l_linenumber") <= 4)
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_suppkey").alias("payer"))
        .select(
            _text("l_orderkey").alias("enc_id"),
            F.col("l_linenumber").alias("cob"),
            _text("payer").alias("payer_id"),
        ),
        charges=_charges(lineitem),
        trans_detail=_trans_detail(lineitem),
        transactions=_transactions(lineitem),
        person_relationship=customer.select(
            _text("c_custkey").alias("person_id"),
            _text(customer_id + 1).alias("related_person_id"),
            _text(customer_id % 30).alias("relation_code"),
        ),
        practice=region.select(_practice("r_regionkey").alias("practice_id"), F.col("r_name").alias("practice_name")),
        employer_mstr=customer.where(customer_id % 8 == 0).select(
            _text("c_custkey").alias("employer_id"), F.col("c_name").alias("name")
        ),
        person=customer.select(
            _text("c_custkey").alias("person_id"),
            F.when(customer_id % 11 != 0, F.col("c_name")).alias("last_name"),
            F.when(customer_id % 7 != 0, F.col("c_mktsegment")).alias("first_name"),
        ),
        code_tables=relations.select(F.lit("relation").alias("code_type"), "code", "description").union(
            relations.select(F.lit("other"), "code", F.lit("WRONG"))
        ),
        location_mstr=nation.select(_text("n_nationkey").alias("location_id"), F.col("n_name").alias("location_name")),
        mstr_lists=patient_types.union(classes),
        payer_mstr=supplier.select(
            _text("s_suppkey").alias("payer_id"),
            F.col("s_name").alias("payer_name"),
            F.concat(F.lit("FC"), _text(F.col("s_nationkey") % 5)).alias("financial_class"),
        ),
    )


def _every(column: str, count: int, rest: int = 0) -> Column:
    return F.col(column).cast("bigint") % count == rest


def flawed(billing: Billing) -> Billing:
    """The staged tables with what real exports hold and the plain ones lack.

    * transaction ids that occur in several practices (the practice is cut off them);
    * charge lines without an amount, and charge lines repeated under another encounter of the practice;
    * encounters repeated with another or no guarantor, status and location, and encounters without a guarantor type;
    * codes, people, places, payers and relationships that occur twice, one of them without a text;
    * list types that a LIKE pattern matches and equality does not.
    """
    null = F.lit(None).cast("string")
    encounters = billing.patient_encounter.withColumn(
        "guar_type", F.when(~_every("enc_id", 17), F.col("guar_type"))
    )
    repeated = encounters.where(_every("enc_id", 7)).withColumns(
        {
            "guar_id": F.when(_every("enc_id", 2), F.concat("guar_id", F.lit("0"))),
            "enc_status": F.when(_every("enc_id", 3), "A"),
            "location_id": null,
        }
    )
    lines = billing.charges.withColumn("amt", F.when(~_every("source_id", 19), F.col("amt")))
    moved = lines.where(_every("source_id", 23)).withColumn(
        "source_id", (F.col("source_id").cast("bigint") + 5).cast("string")
    )

    def short_ids(table: DataFrame) -> DataFrame:
        return table.withColumn("trans_id", F.substring("trans_id", 3, 100))

    def twice(table: DataFrame, **changed: Column) -> DataFrame:
        return table.union(table.withColumns(changed).select(*table.columns))

    def noted(column: str) -> Column:
        return F.concat(F.col(column), F.lit(" (old)"))

    patterns = billing.mstr_lists.where("mstr_list_type = 'pat_type'").select(
        F.lit("patXtype").alias("mstr_list_type"),
        F.lit("PTP").alias("mstr_list_item_id"),
        F.lit("Type by pattern").alias("mstr_list_item_desc"),
    )
    return Billing(
        **{
            **vars(billing),
            "patient_encounter": encounters.union(repeated),
            "charges": lines.union(moved),
            "trans_detail": short_ids(billing.trans_detail),
            "transactions": short_ids(billing.transactions),
            "accounts": twice(billing.accounts, acct_nbr=(F.col("acct_nbr") + 1).cast(ACCOUNT_NUMBER)),
            "practice": twice(billing.practice, practice_name=null),
            "employer_mstr": twice(billing.employer_mstr, name=null),
            "person": twice(billing.person, first_name=F.lit("Zoe")),
            "location_mstr": twice(billing.location_mstr, location_name=noted("location_name")),
            "mstr_lists": twice(
                billing.mstr_lists.union(patterns), mstr_list_item_desc=noted("mstr_list_item_desc")
            ),
            "payer_mstr": twice(billing.payer_mstr, payer_name=null),
            "person_relationship": twice(billing.person_relationship, relation_code=null),
            "code_tables": twice(billing.code_tables, description=null),
            "encounter_payer": twice(billing.encounter_payer, payer_id=null),
        }
    )
