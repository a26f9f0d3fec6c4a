"""Text normalisation and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_upper(text: Column) -> Column:
    """Remove all leading and trailing white space (not only blanks), then upper-case."""
    return F.upper(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))


def product_label(code: Column, description: Column, width: int) -> Column:
    return F.concat(code, F.lit("  "), F.substring(description, 1, width))


def first_word(text: Column) -> Column:
    return F.split(text, " ").getItem(0)


def compact_money(value: Column, symbol: str = "£") -> Column:
    """1234567 -> £1.2M, 4321 -> £4.3K, 12 -> £12."""
    number = value.cast("double")
    return (F.when(number >= 1_000_000, F.format_string(f"{symbol}%.1fM", number / 1_000_000))
            .when(number >= 1_000, F.format_string(f"{symbol}%.1fK", number / 1_000))
            .otherwise(F.format_string(f"{symbol}%,.0f", number)))
