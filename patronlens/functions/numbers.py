"""Money and rounding.

Money is summed as whole cents in a bigint, which stays in generated code and gives the
same result in any order; decimals appear only in stored and reported columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from patronlens.schemas import MONEY


def line_cents(quantity: Column, price: Column) -> Column:
    """quantity x price in cents, halves to even on the binary product as numpy rounds."""
    return F.rint(quantity * price * F.lit(100.0)).cast("bigint")


def to_money(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def to_big_money(cents: Column) -> Column:
    """Money column for totals over many customers (wider than the stored type)."""
    return (cents.cast("decimal(24,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(26,2)")


def to_cents(money: Column) -> Column:
    return (money * F.lit(100).cast("decimal(3,0)")).cast("bigint")


def decimal_mean(total: Column, count: Column, digits: int) -> Column:
    """total / count with halves away from zero, as NUMERIC rounding does; null when count is 0."""
    return F.round(total.cast("decimal(24,0)")
                   / F.nullif(count, F.lit(0)).cast("decimal(12,0)"), digits)


def money_mean(cents: Column, count: Column, digits: int = 2) -> Column:
    """Mean of money given its cents, to 1 or 2 digits."""
    if digits == 2:
        return to_big_money(decimal_mean(cents, count, 0))
    return decimal_mean(cents, count * F.lit(100), digits)


def float_round(value: Column, digits: int) -> Column:
    """Scale, round halves to even, scale back: the rounding numpy applies to floats."""
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)
