"""Money expressions.

Amounts stay decimal from the scan to the final sum, so a result does not
depend on the order in which partitions are added.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column) -> Column:
    return value.cast("decimal(12,2)")


def net_amount(total: Column, discount_rate: Column) -> Column:
    return money(total) * (F.lit(1) - discount_rate.cast("decimal(4,2)"))


def rounded_unit_price(total: Column, quantity: Column) -> Column:
    """Price per piece to the cent, half up, in integer arithmetic.

    Null for a quantity of zero. Both inputs are non-negative.
    """
    cents = (money(total) * 100).cast("bigint")
    pieces = quantity.cast("bigint")
    twice = F.nullif(pieces * 2, F.lit(0).cast("bigint"))
    per_piece = F.call_function("div", cents * 2 + pieces, twice)
    return per_piece.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)")


def repaired_sales(sales: Column, quantity: Column, price: Column) -> Column:
    """Sales, recomputed where missing, not positive or inconsistent.

    A comparison with a missing price is null, so then the value is kept.
    """
    expected = quantity * F.abs(price)
    wrong = sales.isNull() | (sales <= 0) | (sales != expected)
    return F.when(wrong, expected).otherwise(sales).cast("int")


def repaired_price(sales: Column, quantity: Column, price: Column) -> Column:
    """Price, derived from the sales as delivered where missing or not positive."""
    divisor = F.when(quantity != 0, quantity).otherwise(1)
    wrong = price.isNull() | (price <= 0)
    return F.when(wrong, sales / divisor).otherwise(price).cast("int")


def mean(total: Column, count: Column) -> Column:
    """Mean from an additive pair; null for an empty group."""
    return F.try_divide(total.cast("double"), count)
