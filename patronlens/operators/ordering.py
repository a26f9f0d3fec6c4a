"""Positions in a global order without a single-task window.

The rows are range-partitioned, the number of the slice is written next to them, and the
slices' totals (one small row each) give every slice the position at which it starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronlens.staging import stage

SLICE = "_slice"


def in_slices(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """`df` range-partitioned by `order` and written, with each row's slice number. The
    slice is part of the written row, so later reads and retries all see the same one."""
    ranged = df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id())
    return stage(ranged, label)


def slice_starts(sliced: DataFrame, weight: Column, groups: Sequence[str] = (),
                 extra: Sequence[Column] = ()) -> DataFrame:
    """Per slice (and group): its total weight and the weight of all slices before it.
    One row per slice and group, so the window below only ever sees that many rows."""
    totals = sliced.groupBy(*groups, SLICE).agg(F.sum(weight).alias("slice_weight"), *extra)
    before = (Window.partitionBy(*groups).orderBy(SLICE)
              .rowsBetween(Window.unboundedPreceding, -1))
    return totals.withColumn(
        "start", F.coalesce(F.sum("slice_weight").over(before), F.lit(0).cast("bigint")))


def number_rows(df: DataFrame, key: str, name: str, after: int = 0) -> DataFrame:
    """Number the rows after+1, after+2, ... in order of the unique column `key`."""
    sliced = in_slices(df, [key], "numbered")
    starts = slice_starts(sliced, F.lit(1)).select(SLICE, "start")
    within = Window.partitionBy(SLICE).orderBy(key)
    numbered = (sliced.join(F.broadcast(starts), SLICE)  # one row per slice
                .withColumn(name, F.lit(after) + F.col("start") + F.row_number().over(within)))
    return numbered.select(name, *df.columns)


def order_statistics(df: DataFrame, groups: Sequence[str], value: str,
                     ranks: Sequence[str]) -> DataFrame:
    """The values at given positions (from 0) of each group's ascending order, exactly.

    `ranks` are SQL expressions of `n`, the group's number of values. One row per group:
    n, v_min, v_max and at_0, at_1, ... for the ranks. `groups` must have few distinct
    values (periods, metrics, segments).

    Equal values are first counted together, so a heavy value is one row; the distinct
    values are ordered by slices of a global order."""
    counted = (df.filter(F.col(value).isNotNull())
               .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("weight")))
    placed = _place_sliced(counted, groups, value, ranks)
    picks = [F.expr(f"max(CASE WHEN {rank} >= first AND {rank} < first + weight THEN `{value}` END)"
                    f" AS at_{i}") for i, rank in enumerate(ranks)]
    return placed.groupBy(*groups).agg(
        F.max("n").alias("n"), F.max("v_min").alias("v_min"), F.max("v_max").alias("v_max"),
        *picks)


def quantile_ranks(fractions: Sequence[tuple[int, int]]) -> list[str]:
    """Ranks of the two neighbours of each k/d quantile, for `scaled_quantile`."""
    ranks = []
    for k, d in fractions:
        low = f"((n - 1) * {k}) div {d}"
        ranks += [f"({low})", f"({low} + cast(((n - 1) * {k}) % {d} > 0 as bigint))"]
    return ranks


def scaled_quantile(i: int, k: int, d: int) -> Column:
    """d times the linearly interpolated k/d quantile, an exact integer; the i-th of the
    fractions given to `quantile_ranks`."""
    rest = f"((n - 1) * {k}) % {d}"
    return F.expr(f"at_{2 * i} * ({d} - {rest}) + at_{2 * i + 1} * ({rest})")


def _place_sliced(counted: DataFrame, groups: Sequence[str], value: str,
                  ranks: Sequence[str]) -> DataFrame:
    """Only the slices that hold a wanted rank are ordered. A slice has about the distinct
    values divided by the shuffle partitions, so set the partitions for the data."""
    sliced = in_slices(counted, [*groups, value], "ordered")
    starts = slice_starts(sliced, F.col("weight"), groups,
                          (F.min(value).alias("low"), F.max(value).alias("high")))
    whole = Window.partitionBy(*groups)
    starts = (starts.withColumn("n", F.sum("slice_weight").over(whole))
              .withColumn("v_min", F.min("low").over(whole))
              .withColumn("v_max", F.max("high").over(whole)))
    holds_one = " OR ".join(
        f"({rank} >= start AND {rank} < start + slice_weight)" for rank in ranks)
    wanted = (starts.filter(holds_one)
              .select(*groups, SLICE, "start", "n", "v_min", "v_max"))
    before = (Window.partitionBy(*groups, SLICE).orderBy(value)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (sliced.join(F.broadcast(wanted), [*groups, SLICE])  # at most one slice a rank
            .withColumn("first", F.col("start")
                        + F.coalesce(F.sum("weight").over(before), F.lit(0))))
