"""Stored views: named definitions over the warehouse's tables, made when they are read, so
that filters on them reach the tables' files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from patronlens.plans import history

Read = Callable[[str], DataFrame]


def segment_monthly(read: Read) -> DataFrame:
    """Size and means of every segment in every period."""
    return history.monthly_means(read("rfm_snapshot"))


def segment_migration(read: Read) -> DataFrame:
    """Customers by the segments of a period and of the next one they appear in."""
    return history.moves(read("rfm_snapshot"))


VIEWS: dict[str, Callable[[Read], DataFrame]] = {
    "vw_segment_monthly": segment_monthly,
    "vw_segment_migration": segment_migration,
}
