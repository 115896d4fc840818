"""Column expressions of the billing rules. All are built-in functions and stay in the JVM."""

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from claimledger.sources.schemas import ENCOUNTER_NUMBER, MONEY

# Encounter status codes and their texts. Anything else, NULL too, is unbilled.
STATUS_TEXT = {
    "H": "History",
    "B": "Billed",
    "R": "Rebill",
    "A": "Bad Debt",
}
NO_STATUS_TEXT = "Unbilled"
BAD_DEBT_STATUS = "A"

# Guarantor types.
EMPLOYER = "E"
PERSON = "P"


def money(column: Column) -> Column:
    """The column as an amount. One beyond the range is an error in every session, not NULL and then zero."""
    return F.coalesce(column.try_cast(MONEY), _lost_unless_null(column))


def _lost_unless_null(column: Column) -> Column:
    lost = F.raise_error(F.lit(f"NUMERIC_VALUE_OUT_OF_RANGE: an amount does not fit {MONEY.simpleString()}"))
    return F.when(column.isNotNull(), lost)


# An amount is added up as two whole numbers, which is several times as fast as in decimals: hundred thousands of
# dollars, and the ten thousandths of a dollar below them. Sums of either fit for a billion lines of any amount.
HIGH_UNIT = 100_000
LOW_UNITS = HIGH_UNIT * 10**MONEY.scale


def amount_parts(amount: Column) -> tuple[Column, Column]:
    """The high and low part of an amount, exactly; both NULL for NULL."""
    near = amount.cast("double")
    # As a double such an amount is off by far less than half a unit.
    few = F.abs(near) < HIGH_UNIT
    high = F.when(few, F.lit(0).cast("bigint")).otherwise(F.call_function("div", amount, F.lit(HIGH_UNIT)))
    rest = F.when(few, near).otherwise((amount % HIGH_UNIT).cast("double"))
    return high, F.rint(rest * 10**MONEY.scale).cast("bigint")


def amount_carried(high: Column, low: Column) -> tuple[Column, Column]:
    """The same parts with a low part of less than one high unit."""
    units = F.lit(LOW_UNITS).cast("bigint")
    return high + F.call_function("div", low, units), low % units


def amount_of_parts(high: Column, low: Column) -> Column:
    """The amount of two parts or their sums."""
    # Short on purpose: code of over 8,000 bytes, for all columns of a row together, is not compiled by the JVM.
    few, many = low.cast(DecimalType(19, 0)), high.cast(DecimalType(19, 0)) * F.lit(LOW_UNITS)
    units = F.when(high == 0, few).otherwise(many + few)
    amount = units * F.lit(Decimal(1).scaleb(-MONEY.scale))
    return F.coalesce(amount.try_cast(MONEY), _lost_unless_null(high))


def zero_if_null(column: Column) -> Column:
    return money(F.coalesce(column, F.lit(0)))


def full_name(last: str, first: str) -> Column:
    """``Last, First`` with blanks for missing parts (``concat_ws`` would drop the comma)."""
    return F.concat(F.coalesce(F.col(last), F.lit("")), F.lit(", "), F.coalesce(F.col(first), F.lit("")))


def status_text(status: str) -> Column:
    text = None
    for code, label in STATUS_TEXT.items():
        hit = F.col(status) == code
        text = F.when(hit, label) if text is None else text.when(hit, label)
    return text.otherwise(NO_STATUS_TEXT)


def encounter_numbers(numbers: Iterable[str | int]) -> list[Column]:
    """Typed literals for an IN list over the decimal encounter number.

    Left as text, Spark would compare both sides as doubles.
    """
    return [F.lit(Decimal(str(n))).cast(ENCOUNTER_NUMBER) for n in numbers]
