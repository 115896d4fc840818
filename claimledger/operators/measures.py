"""Money measures: sums of charges and of transactions, bad debt, totals and account sums."""

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimledger.functions.expressions import (
    BAD_DEBT_STATUS,
    amount_carried,
    amount_of_parts,
    amount_parts,
    money,
    zero_if_null,
)
from claimledger.operators.joins import KeyUse, Side, lookup

# Codes of the transaction tables.
INSURANCE = "T"
PATIENT = "P"
REFUND = "R"
POSTED = "Y"


@dataclass(frozen=True)
class TransactionMeasure:
    amount: str
    source: str
    refund: bool | None  # None: any type, NULL too


# Which amount of which transactions each measure adds up. An adjustment is anything
# typed other than refund; a NULL type is neither.
TRANSACTION_MEASURES = {
    "ins_pmt": TransactionMeasure("paid_amt", INSURANCE, None),
    "ins_adj": TransactionMeasure("adj_amt", INSURANCE, False),
    "ins_ref": TransactionMeasure("adj_amt", INSURANCE, True),
    "pat_pmt": TransactionMeasure("paid_amt", PATIENT, None),
    "pat_adj": TransactionMeasure("adj_amt", PATIENT, False),
    "pat_ref": TransactionMeasure("adj_amt", PATIENT, True),
}

# Each total and the columns it adds up.
TOTALS = {
    "pat_tot": ("pat_pmt", "pat_adj", "pat_ref"),
    "ins_tot": ("ins_pmt", "ins_adj", "ins_ref"),
    "ins_bal": ("ins_buc1", "ins_buc2", "ins_buc3"),
    "pmt_tot": ("ins_pmt", "pat_pmt"),
    "adj_tot": ("ins_adj", "pat_adj"),
    "ref_tot": ("ins_ref", "pat_ref"),
    "ref_adj_amt": ("ins_adj", "ins_ref", "pat_adj", "pat_ref"),
    "bal": ("pat_pmt", "pat_adj", "pat_ref", "ins_pmt", "ins_adj", "ins_ref", "tot_chg"),
}

# Encounter column -> charge column it sums.
ENCOUNTER_CHARGE_SUMS = {
    "enc_tot_chg": "amt",
    "enc_ins_buc1": "cob1_amt",
    "enc_ins_buc2": "cob2_amt",
    "enc_ins_buc3": "cob3_amt",
    "enc_pat_buc": "pat_amt",
}

# Account columns that are sums over the encounters of a guarantor; the account's totals follow
# from these by ``TOTALS``, exactly, as decimal addition does not round.
ACCOUNT_SUMS = {
    **{f"acct_{m}": f"enc_{m}" for m in ("tot_chg", "ins_buc1", "ins_buc2", "ins_buc3", *TRANSACTION_MEASURES)},
    "acct_self_buc": "enc_pat_buc",
    "acct_bad_debt_amt": "enc_bad_debt_amt",
}
ACCOUNT_COLUMNS = [*ACCOUNT_SUMS, *(f"acct_{t}" for t in TOTALS)]


def total_of(columns: Sequence[str]) -> Column:
    """The sum of several columns of a row; NULL if any of them is."""
    first, *others = [F.col(c) for c in columns]
    for other in others:
        first = first + other
    return money(first)


def with_totals(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumns(
        {f"{prefix}_{name}": total_of([f"{prefix}_{part}" for part in parts]) for name, parts in TOTALS.items()}
    )


def with_zeros(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: zero_if_null(F.col(c)) for c in columns})


def parts_of(names: Iterable[str]) -> list[str]:
    """The columns that hold amounts in parts."""
    return [f"{name}_{part}" for name in names for part in ("high", "low")]


def _as_parts(name: str, parts: tuple[Column, Column]) -> list[Column]:
    return [part.alias(column) for part, column in zip(parts, parts_of([name]), strict=True)]


def _parts(name: str) -> tuple[Column, Column]:
    high, low = parts_of([name])
    return F.col(high), F.col(low)


def in_parts(df: DataFrame, keys: Sequence[str], amounts: Iterable[str]) -> DataFrame:
    """``keys``, and the amounts in parts."""
    return df.select(*keys, *[part for amount in amounts for part in _as_parts(amount, amount_parts(F.col(amount)))])


def out_of_parts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Whole amounts in place of those in parts."""
    names = list(names)
    kept = [c for c in df.columns if c not in parts_of(names)]
    return df.select(*kept, *[amount_of_parts(*_parts(name)).alias(name) for name in names])


def charge_sums(charges: DataFrame, keys: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Sums of charge amounts by ``keys``, in one pass, pre-added before the shuffle."""
    summed = in_parts(charges, keys, sums.values()).groupBy(*keys).agg(*charge_part_sums(sums))
    return out_of_parts(summed, sums)


def charge_part_sums(sums: dict[str, str]) -> list[Column]:
    """Aggregations of charge amounts in parts: result -> amount."""
    pairs = zip(parts_of(sums), parts_of(sums.values()), strict=True)
    return [F.sum(amount).alias(name) for name, amount in pairs]


def header_weights(transactions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How often a detail line with these keys counts towards each measure: one row per key.

    A line counts once per matching header. Counting headers first gives the same sums as joining
    line to header, without multiplying rows when headers share a key.
    """
    refund, not_refund = F.col("type") == REFUND, F.col("type") != REFUND

    def counted(measure: TransactionMeasure) -> Column:
        wanted = F.col("source") == measure.source
        if measure.refund is not None:
            wanted = wanted & (refund if measure.refund else not_refund)
        return F.count_if(wanted).cast("int")

    return (
        transactions.where(F.col("source").isin(INSURANCE, PATIENT))
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[counted(measure).alias(f"{name}_count") for name, measure in TRANSACTION_MEASURES.items()])
    )


def transaction_sums(
    trans_detail: DataFrame,
    transactions: DataFrame,
    by: Sequence[str],
    header_keys: Sequence[str],
    unposted_payments: bool,
    names: dict[str, str],
    use: KeyUse,
) -> DataFrame:
    """The six transaction measures by ``by``, in one pass over details and headers.

    ``names`` gives each measure its column. The two jobs differ on purpose: ``header_keys`` is how a
    line finds its header, and ``unposted_payments`` says whether payments that are not posted count. ``use`` is that of
    the lines over their header keys.
    """
    parts = transaction_part_sums(trans_detail, transactions, by, header_keys, unposted_payments, names, use)
    return out_of_parts(parts, [names[name] for name in TRANSACTION_MEASURES])


def transaction_part_sums(
    trans_detail: DataFrame,
    transactions: DataFrame,
    by: Sequence[str],
    header_keys: Sequence[str],
    unposted_payments: bool,
    names: dict[str, str],
    use: KeyUse,
) -> DataFrame:
    """``transaction_sums`` in parts."""
    line = list(dict.fromkeys([*by, *header_keys]))
    posted = F.col("post_ind") == POSTED
    if not unposted_payments:
        trans_detail = trans_detail.where(posted)
    amounts = ["paid_amt", "adj_amt"]
    details = trans_detail.dropna(subset=list(header_keys)).select(
        *line, "paid_amt", F.when(posted, F.col("adj_amt")).alias("adj_amt")
    )
    details = in_parts(details, line, amounts)

    def collapse(lines: DataFrame) -> DataFrame:
        summed = lines.groupBy(*line).agg(*[F.sum(part).alias(part) for part in parts_of(amounts)])
        carried = [part for amount in amounts for part in _as_parts(amount, amount_carried(*_parts(amount)))]
        return summed.select(*line, *carried)

    headers = Side(header_weights(transactions, header_keys), transactions.select(*header_keys))
    hot = use.hot(*header_keys)
    matched = lookup(details, headers, header_keys, hot, spread=by, how="inner", collapse=collapse)

    def weighted(name: str, measure: TransactionMeasure) -> list[Column]:
        count, parts = F.col(f"{name}_count"), _parts(measure.amount)
        # Nearly every line has one header, which needs no multiplication.
        several = amount_carried(*[part * count for part in parts])
        values = [F.when(count == 1, part).when(count > 1, many) for part, many in zip(parts, several, strict=True)]
        return _as_parts(names[name], tuple(F.sum(value) for value in values))

    return matched.groupBy(*by).agg(*[part for n, m in TRANSACTION_MEASURES.items() for part in weighted(n, m)])


def encounter_charge_sums(charges: DataFrame) -> DataFrame:
    sums = charge_sums(charges, ["source_id", "practice_id"], ENCOUNTER_CHARGE_SUMS)
    return sums.withColumnRenamed("source_id", "enc_id")


def encounter_transaction_use(trans_detail: DataFrame) -> KeyUse:
    """How transaction lines spread over the headers of their practice."""
    header_keys = ["trans_id", "practice_id"]
    return KeyUse(trans_detail.select(*header_keys), header_keys)


def encounter_transaction_sums(
    trans_detail: DataFrame, transactions: DataFrame, use: KeyUse | None = None
) -> DataFrame:
    """Payments count whether posted or not; a header is found by transaction and practice."""
    header_keys = ["trans_id", "practice_id"]
    sums = transaction_sums(
        trans_detail,
        transactions,
        by=["source_id", "practice_id"],
        header_keys=header_keys,
        unposted_payments=True,
        names={name: f"enc_{name}" for name in TRANSACTION_MEASURES},
        use=use or encounter_transaction_use(trans_detail),
    )
    return sums.withColumnRenamed("source_id", "enc_id")


def with_sums(encounters: DataFrame, sums: DataFrame) -> DataFrame:
    """Attach sums by (enc_id, practice_id); an encounter without any gets zeros.

    Both sides hold one row per key, so no key can be hot.
    """
    # The id first, as joins sort by it: practices tell few rows apart.
    joined = encounters.join(sums, ["enc_id", "practice_id"], "left")
    return with_zeros(joined, [c for c in sums.columns if c not in ("practice_id", "enc_id")])


def with_bad_debt(encounters: DataFrame) -> DataFrame:
    """Move the patient bucket of a bad-debt encounter to its bad debt amount.

    Both columns are set at once, from the old values. With a NULL status neither arm applies: the
    bad debt stays NULL and the bucket stays.
    """
    status, bucket = F.col("enc_status"), F.col("enc_pat_buc")
    return encounters.withColumns(
        {
            "enc_bad_debt_amt": money(
                F.when(status == BAD_DEBT_STATUS, bucket).when(status != BAD_DEBT_STATUS, F.lit(0))
            ),
            "enc_pat_buc": money(F.when(status == BAD_DEBT_STATUS, F.lit(0)).otherwise(bucket)),
        }
    )


def account_sums(encounters: DataFrame) -> DataFrame:
    """The account columns per guarantor, one row each; pre-added before the shuffle, so a big guarantor is no burden.

    The totals are formed here, once per guarantor and not on every encounter of it.
    """
    sums = (
        encounters.where(F.col("guar_id").isNotNull())
        .groupBy("guar_id")
        .agg(*[money(F.sum(source)).alias(name) for name, source in ACCOUNT_SUMS.items()])
    )
    return with_totals(with_zeros(sums, list(ACCOUNT_SUMS)), "acct")


def with_account_columns(encounters: DataFrame) -> DataFrame:
    """Zeros for what is missing: an encounter without a guarantor has no account."""
    return with_zeros(encounters, ACCOUNT_COLUMNS)


def with_account_totals(encounters: DataFrame, use: KeyUse) -> DataFrame:
    """The 20 account columns on every encounter of the guarantor."""
    sums = Side(account_sums(encounters), use)
    found = lookup(encounters, sums, ["guar_id"], use.hot("guar_id"), spread=["practice_id", "enc_id"])
    return with_account_columns(found)
