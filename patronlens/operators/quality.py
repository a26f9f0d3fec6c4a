"""Integrity checks that stand in for the warehouse's declared constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def orphans(child: DataFrame, parent: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Distinct non-null key values of `child` that `parent` lacks, with the rows affected.

    Counted per key before the anti join, so a heavy key is one row in it."""
    keys = [key] if isinstance(key, str) else list(key)
    used = child.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_affected"))
    return used.join(parent.select(*keys), keys, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many nulls each of the columns holds."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
