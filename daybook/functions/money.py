"""Line values and their sums: exact in cents for prices that a decimal holds, doubles for others."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Twelve digits before the point, eight after. Leaves room to sum 10^8 of the largest lines.
EXACT = "decimal(20,8)"

VALUE = "purchase_value"
QUANTITY = "item_quantity"


def _exact() -> Column:
    """The value as a decimal; NULL where the decimal is not the value itself: too large, with
    more decimals, infinite, not a number."""
    exact = F.col(VALUE).try_cast(EXACT)
    return F.when(exact.cast("double") == F.col(VALUE), exact)


def line_value() -> Column:
    """Value times quantity as a decimal, where a decimal holds the value."""
    return _exact() * F.col(QUANTITY)


def wide_line_value() -> Column:
    """Value times quantity as a double, only where no decimal holds the value."""
    return F.when(_exact().isNull(), F.col(VALUE) * F.col(QUANTITY))


def line_total() -> Column:
    """Value times quantity, whichever of both has it."""
    return F.coalesce(line_value().cast("double"), wide_line_value())


def to_total(exact: Column, wide: Column) -> Column:
    """Join both sums into one amount, rounded half up to cents. NULL if there is neither."""
    return F.when(wide.isNull(), F.round(exact, 2).cast("double")).otherwise(
        F.round(F.coalesce(exact.cast("double"), F.lit(0.0)) + wide, 2)
    )


def total() -> Column:
    """Sum of line values. Lines without an exact value are added as doubles beside the exact
    ones, so none is left out. A group of NULL lines has a NULL total."""
    return to_total(F.sum(line_value()), F.sum(wide_line_value()))
