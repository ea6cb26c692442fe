"""Text-to-type recipes.

Lenient casts turn bad text into NULL so the row can be classified later;
strict casts fail the job. Spark and SQL warehouses disagree on a few texts
("31.0" as an integer, "2025" as a date); these recipes take the warehouse
reading.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATIO = "decimal(18,4)"

_DATE_TEXT = (
    r"^[0-9]{4}(-[0-9]{1,2}-|/[0-9]{1,2}/)[0-9]{1,2}"
    r"([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}.*)?)?$"
)


def clean_text(text: Column) -> Column:
    """Trim spaces; blank becomes NULL. The casts below take text in this form:
    select the cleaned text first, so that each cast reads it as a column."""
    return F.nullif(F.trim(text), F.lit(""))


def lenient_date(text: Column) -> Column:
    """Year-month-day text to a date, anything else to NULL.

    Nearly all text is yyyy-mm-dd, which two position tests recognise at a
    fraction of the cost of the pattern.
    """
    plain = (
        (F.octet_length(text) == 10)
        & (F.instr(text, "-") == 5)
        & (F.locate("-", text, 6) == 8)
    )
    other = F.when(text.rlike(_DATE_TEXT), F.translate(text, "/", "-"))
    return F.when(plain, text.try_cast("date")).otherwise(other.try_cast("date"))


def lenient_int(text: Column) -> Column:
    """Numeric text to an integer, rounding half up; NULL when it does not fit."""
    decimal = text.try_cast("decimal(38,18)")
    return F.coalesce(text.try_cast("int"), F.round(decimal, 0).try_cast("int"))


def lenient_money(text: Column) -> Column:
    """Numeric text to a two-place decimal, NULL when it does not fit."""
    return text.try_cast(MONEY)


def _or_fail(value: Column, text: Column, kind: str) -> Column:
    """``value``, failing the job where there is text it could not be read from."""
    failure = F.raise_error(F.concat(F.lit(f"not {kind}: "), text))
    return F.coalesce(value, F.when(text.isNotNull(), failure))


def strict_date(text: Column) -> Column:
    return _or_fail(lenient_date(text), text, "a date")


def strict_int(text: Column) -> Column:
    return _or_fail(lenient_int(text), text, "an integer")


def strict_money(text: Column) -> Column:
    return _or_fail(lenient_money(text), text, "an amount")


def money(value: Column) -> Column:
    """Bring a widened sum or product back to two places."""
    return value.cast(MONEY)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Four-place quotient, NULL on a zero or missing base.

    24 digits hold any total and leave the quotient 14 places before rounding;
    wider operands would leave only six.
    """
    base = F.nullif(denominator.cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)"))
    return (numerator.cast("decimal(24,2)") / base).cast(RATIO)
