"""Declared schemas of the inputs and outputs.

Fixed values: table names, column names, their order and their types are the data contract,
so they are spelled out here in full and used by name everywhere else.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT = StringType()
MONEY = DecimalType(19, 4)
ACCOUNT_NUMBER = DecimalType(12, 0)
ENCOUNTER_NUMBER = DecimalType(11, 0)


def _schema(columns: dict[str, DataType], nullable: bool = True) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind in columns.items()])


def _text(names: str) -> dict[str, DataType]:
    return dict.fromkeys(names.split(), TEXT)


def _money(names: str) -> dict[str, DataType]:
    return dict.fromkeys(names.split(), MONEY)


# The billing tables, with the columns the jobs read.
SOURCES: dict[str, StructType] = {
    "patient_encounter": _schema(
        {
            **_text("practice_id enc_id"),
            "enc_nbr": ENCOUNTER_NUMBER,
            **_text("guar_id guar_type person_id enc_status location_id"),
            "enc_timestamp": TimestampNTZType(),
            **_text("pat_resp_date patient_type_id"),
        }
    ),
    "accounts": _schema({"acct_id": TEXT, "acct_nbr": ACCOUNT_NUMBER, "guar_id": TEXT}),
    "encounter_payer": _schema({"enc_id": TEXT, "cob": IntegerType(), "payer_id": TEXT}),
    "charges": _schema(
        {
            **_text("practice_id source_id charge_id"),
            **_money("amt cob1_amt cob2_amt cob3_amt pat_amt"),
        }
    ),
    "trans_detail": _schema(
        {
            **_text("practice_id trans_id source_id charge_id"),
            **_money("paid_amt adj_amt"),
            "post_ind": TEXT,
        }
    ),
    "transactions": _schema(_text("practice_id trans_id source type")),
    "person_relationship": _schema(_text("person_id related_person_id relation_code")),
    "practice": _schema(_text("practice_id practice_name")),
    "employer_mstr": _schema(_text("employer_id name")),
    "person": _schema(_text("person_id last_name first_name")),
    "code_tables": _schema(_text("code_type code description")),
    "location_mstr": _schema(_text("location_id location_name")),
    "mstr_lists": _schema(_text("mstr_list_type mstr_list_item_id mstr_list_item_desc")),
    "payer_mstr": _schema(_text("payer_id payer_name financial_class")),
}

# One row per encounter: ids and descriptions, then money.
ENCOUNTER_BALANCES = _schema(
    {
        **_text("practice_id practice_name acct_id"),
        "acct_nbr": ACCOUNT_NUMBER,
        **_text(
            "guar_id guar_type guar_name person_id person_name relationship_id relationship_desc"
            " enc_id enc_status enc_status_desc"
        ),
        "enc_nbr": ENCOUNTER_NUMBER,
        "dos": DateType(),
        **_text(
            "pat_resp_date location_id location_name pat_type pat_type_desc"
            " payer1_id payer1_name payer1_fc_id payer1_fin_class"
            " payer2_id payer2_name payer2_fc_id payer2_fin_class"
            " payer3_id payer3_name payer3_fc_id payer3_fin_class"
        ),
        **_money(
            "enc_tot_chg enc_ins_bal enc_bal acct_tot_chg acct_ins_bal acct_bal"
            " enc_pat_pmt enc_ins_pmt enc_pat_adj enc_ins_adj enc_pat_ref enc_ins_ref"
            " enc_ins_tot enc_pat_tot enc_pmt_tot enc_ref_tot enc_adj_tot enc_ref_adj_amt"
            " acct_pat_pmt acct_ins_pmt acct_pat_adj acct_ins_adj acct_pat_ref acct_ins_ref"
            " acct_ins_tot acct_pat_tot acct_pmt_tot acct_ref_tot acct_adj_tot acct_ref_adj_amt"
            " enc_ins_buc1 enc_ins_buc2 enc_ins_buc3 enc_pat_buc"
            " acct_ins_buc1 acct_ins_buc2 acct_ins_buc3 acct_self_buc"
            " enc_bad_debt_amt acct_bad_debt_amt"
        ),
    }
)

# One row per charge, before its sums of transactions are attached.
CHARGES_SUMMED = _schema(
    {
        **_text("practice_id guar_id guar_type enc_id charge_id"),
        **_money("chgamt chgcob1 chgcob2 chgcob3 chgpat chginsbal"),
    }
)

# One row per charge, complete.
CHARGE_FACT = _schema(
    {
        **_text("practice_id guar_id guar_type enc_id charge_id"),
        **_money(
            "chgamt chgcob1 chgcob2 chgcob3 chgpat chginsbal"
            " chginspmt chgpatpmt chginsadj chgpatadj chginsref chgpatref chgencbal"
        ),
    }
)

# The warehouse table. Every column is required and Charge_ID is its key.
F_TRANSACTIONS = _schema(
    {
        **_text("Practice_ID Guarantor_ID Enc_ID Charge_ID Guar_Type"),
        **_money(
            "Gross_Charges COB1_Bal COB2_Bal COB3_Bal Pat_Bal Tot_Ins_Bal"
            " Ins_Pmt_Amt Pat_Pmt_Amt Ins_Adj_Amt Pat_Adj_Amt Ins_Ref_Amt Pat_Ref_Amt Curr_Enc_Bal"
        ),
    },
    nullable=False,
)
F_TRANSACTIONS_KEY = "Charge_ID"

# Warehouse column <- charge fact column. Bound by name: the two orders differ.
F_TRANSACTIONS_FROM = {
    "Practice_ID": "practice_id",
    "Guarantor_ID": "guar_id",
    "Enc_ID": "enc_id",
    "Charge_ID": "charge_id",
    "Guar_Type": "guar_type",
    "Gross_Charges": "chgamt",
    "COB1_Bal": "chgcob1",
    "COB2_Bal": "chgcob2",
    "COB3_Bal": "chgcob3",
    "Pat_Bal": "chgpat",
    "Tot_Ins_Bal": "chginsbal",
    "Ins_Pmt_Amt": "chginspmt",
    "Pat_Pmt_Amt": "chgpatpmt",
    "Ins_Adj_Amt": "chginsadj",
    "Pat_Adj_Amt": "chgpatadj",
    "Ins_Ref_Amt": "chginsref",
    "Pat_Ref_Amt": "chgpatref",
    "Curr_Enc_Bal": "chgencbal",
}


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns, order and types of ``schema``."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
