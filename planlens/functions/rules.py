"""Business rules as Column-returning functions.

Every rule takes keyword-only arguments: several columns share a type, and a
positional swap would compute the wrong answer without raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published vocabulary of the model.
ORDER_STATUSES = ("Shipped", "Open", "Cancelled")
DELIVERY_STATUSES = ("On Time", "Late", "Not Delivered", "Cancelled", "Unknown")
VARIANCE_FLAGS = ("NO_ACTUALS", "BELOW_PLAN", "AT_OR_ABOVE_PLAN", "NO_FORECAST")
CELL_PRIORITY = ("AT_OR_ABOVE_PLAN", "NO_FORECAST", "BELOW_PLAN", "NO_ACTUALS")
DEFECT_REASONS = (
    "AMBIGUOUS_DUPLICATE",
    "MISSING_ORDER_DATE",
    "MISSING_UNIT_PRICE",
    "INVALID_QUANTITY",
)
SOURCE_BATCHES = ("BATCH_A", "BATCH_B")
LATE_BATCH_PREFIX = "ORD9"
UNMAPPED = "UNMAPPED"
UNKNOWN = "Unknown"


def first_match(*arms: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The label of the first arm whose condition holds."""
    result = F
    for condition, label in arms:
        result = result.when(condition, F.lit(label))
    return result.otherwise(F.lit(otherwise)) if otherwise is not None else result


def ordinal(label: Column, order: tuple[str, ...]) -> Column:
    """Position of ``label`` in a fixed category order, for sorting; 0 if absent."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), label).cast("int")


def source_batch(*, order_id: Column) -> Column:
    late, early = SOURCE_BATCHES[1], SOURCE_BATCHES[0]
    return first_match((order_id.startswith(LATE_BATCH_PREFIX), late), otherwise=early)


def defect_reason(
    *, is_duplicate: Column, order_date: Column, unit_price: Column, quantity: Column
) -> Column:
    """The one reason a row is quarantined, NULL when it is clean.

    A duplicate outranks a gap: the repeated key is what has to be fixed upstream.
    """
    duplicate, no_date, no_price, bad_quantity = DEFECT_REASONS
    return first_match(
        (is_duplicate, duplicate),
        (order_date.isNull(), no_date),
        (unit_price.isNull(), no_price),
        (F.coalesce(quantity, F.lit(0)) <= 0, bad_quantity),
    )


def delivery_status(
    *, order_status: Column, order_date: Column, promised_date: Column, actual_date: Column
) -> Column:
    """Punctuality of one order.

    A cancelled order stays cancelled whatever its dates say, and a delivery
    before the order date makes the dates, not the revenue, untrustworthy. A
    delivery with no promise to hold it against counts as late.
    """
    return first_match(
        (order_status == "Cancelled", "Cancelled"),
        (actual_date.isNull(), "Not Delivered"),
        (actual_date < order_date, UNKNOWN),
        (actual_date <= promised_date, "On Time"),
        otherwise="Late",
    )


def variance_flag(*, plan: Column, actual: Column, order_count: Column) -> Column:
    """How a cell stands against plan. "No actuals" means no orders at all, so a
    cell whose orders were all cancelled is below plan."""
    return first_match(
        (plan.isNull(), "NO_FORECAST"),
        (order_count == 0, "NO_ACTUALS"),
        (actual >= plan, "AT_OR_ABOVE_PLAN"),
        otherwise="BELOW_PLAN",
    )


def freshness_verdict(
    *, hours: Column, warn_after: int = 30, error_after: int = 48
) -> Column:
    return first_match(
        (hours.isNull() | (hours > error_after), "error"),
        (hours > warn_after, "warn"),
        otherwise="pass",
    )
