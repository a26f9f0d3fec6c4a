"""Product ranking per segment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronlens import schemas as S
from patronlens.functions import dates, numbers

WEIGHTED = "recency_weighted"
BLOCK = 12  # periods whose sums stand side by side in a row


def sales_with_segment(lines: DataFrame, segments: DataFrame, period: str,
                       inclusive_end: bool = False) -> DataFrame:
    """Every sale up to the period's cutoff with its customer's segment."""
    limit = dates.timestamp_literal(dates.cutoff(period, inclusive_end))
    sold = lines.filter((F.col("amount_cents") > 0) & (F.col("invoice_date") <= limit))
    return sold.join(segments.select("customer_id", "segment"), "customer_id")


def _metric(segment: Column) -> Column:
    by_segment = None
    for name, metric in S.SEGMENT_METRIC.items():
        by_segment = (F.when(segment == name, F.lit(metric)) if by_segment is None
                      else by_segment.when(segment == name, F.lit(metric)))
    return by_segment


def _limits(periods: Sequence[str], inclusive_end: bool) -> list[Column]:
    return [dates.timestamp_literal(dates.cutoff(p, inclusive_end)) for p in periods]


def _place(periods: Sequence[str]) -> Column:
    return (F.array_position(F.lit(list(periods)), F.col("period")) - 1).cast("int")


def _runs(members: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Customers' stretches of periods in one segment: customer_id, segment, begin, end (places
    in `periods`, end exclusive)."""
    by_time = Window.partitionBy("customer_id").orderBy("at")
    fresh = F.coalesce((F.lag("segment").over(by_time) != F.col("segment"))
                       | (F.lag("at").over(by_time) != F.col("at") - 1), F.lit(True))
    return (members.select("customer_id", "segment", _place(periods).alias("at"))
            .withColumn("fresh", fresh.cast("int"))
            .withColumn("run", F.sum("fresh").over(by_time))
            .groupBy("customer_id", "run", "segment")
            .agg(F.min("at").alias("begin"), (F.max("at") + 1).alias("end")))


def _entry(periods: Sequence[str], inclusive_end: bool) -> Column:
    """Place of the first period whose cutoff is not before the sale."""
    return sum(((F.col("invoice_date") > limit).cast("int")
                for limit in _limits(periods, inclusive_end)), F.lit(0))


def _running_totals(sold: DataFrame, runs: DataFrame, periods: Sequence[str],
                    inclusive_end: bool) -> DataFrame:
    """Cents and units per (period, segment, product) of all sales up to each period by the
    customers who are then in the segment.

    Sales are reduced to the period in which they enter, customers to their runs of periods
    in one segment. A sale adds to a segment's total where both begin and is taken off where
    the run ends, so a row is repeated once per run of its customer, not once per period."""
    runs = runs.filter(_metric(F.col("segment")) != WEIGHTED)
    entered = (sold.withColumn("entry", _entry(periods, inclusive_end))
               .groupBy("customer_id", "stock_code", "entry")
               .agg(F.sum("amount_cents").alias("cents"), F.sum("quantity").alias("units"),
                    F.count(F.lit(1)).alias("lines")))
    values = ("cents", "units", "lines")
    begin, end = F.greatest("begin", "entry"), F.col("end")
    changes = (entered.join(runs, "customer_id").filter(F.col("entry") < end)
               .select("segment", "stock_code", F.explode(F.array(
                   F.struct(begin.alias("at"), *values),
                   F.struct(end.alias("at"), *[(-F.col(v)).alias(v) for v in values]))).alias("c"))
               .groupBy("segment", "stock_code", "c.at")
               .agg(*[F.sum(f"c.{v}").alias(v) for v in values])
               .filter(F.col("at") < len(periods)))
    in_order = Window.partitionBy("segment", "stock_code").orderBy("at")
    until = F.lead("at", 1, len(periods)).over(in_order)
    totals = changes.select("segment", "stock_code", "at", until.alias("until"),
                            *[F.sum(v).over(in_order).alias(v) for v in values])
    return (totals.filter(F.col("lines") > 0)
            .select("segment", "stock_code", "cents", "units",
                    F.explode(F.sequence("at", F.col("until") - 1)).alias("at"))
            .select(F.get(F.lit(list(periods)), F.col("at")).alias("period"), "segment",
                    "stock_code", F.when(_metric(F.col("segment")) == "revenue", F.col("cents"))
                    .otherwise(F.col("units")).alias("total"),
                    F.lit(None).cast("double").alias("weight")))


def _time_of_day(ts: Column) -> Column:
    return ts - ts.cast("date").cast("timestamp_ntz")


def weighted_intervals(sold: DataFrame, runs: DataFrame, periods: Sequence[str],
                       times: Sequence[dt.timedelta], inclusive_end: bool) -> DataFrame:
    """Numbers of sales per (segment, product, day, time class) and the periods [begin, end)
    in which they count for the segment.

    Sales are first reduced to day histograms per customer and product: the age of a sale in
    whole days depends on its date and on which of the `times` of day (those of the
    segments' latest sales) it comes after, its time class. Customers are reduced to their
    runs, so the number of rows does not depend on the number of periods."""
    ts = F.col("invoice_date")
    after = F.size(F.filter(F.array(*[F.lit(t) for t in times]), lambda t: t < _time_of_day(ts)))
    weighted = runs.filter(_metric(F.col("segment")) == WEIGHTED)
    entered = (sold.select("customer_id", "stock_code", ts.cast("date").alias("day"),
                           after.alias("time_class"),
                           _entry(periods, inclusive_end).alias("entry"))
               .groupBy("customer_id", "stock_code", "day", "time_class", "entry")
               .agg(F.count(F.lit(1)).alias("sales")))
    return (entered.join(weighted, "customer_id").filter(F.col("entry") < F.col("end"))
            .groupBy("segment", "stock_code", "day", "time_class",
                     F.greatest("begin", "entry").alias("begin"), "end")
            .agg(F.sum("sales").alias("sales")))


def _weighted_totals(sold: DataFrame, members: DataFrame, runs: DataFrame,
                     periods: Sequence[str], inclusive_end: bool) -> DataFrame:
    """Sums of 1 / (1 + days before the segment's latest sale) per (period, segment, product).

    The periods of an interval are summed side by side, BLOCK of them in one row, in place of
    a row for each."""
    # the segment's latest sale is the latest of its customers' latest sales; at most two rows
    # a period come to the driver
    latest = {(r.segment, r.at): r.latest for r in members.filter(
        _metric(F.col("segment")) == WEIGHTED).groupBy("segment", _place(periods).alias("at")).agg(
        F.max("last_purchase").alias("latest")).collect()}
    times = sorted({x - dt.datetime.combine(x.date(), dt.time.min) for x in latest.values()})
    intervals = weighted_intervals(sold, runs, periods, times, inclusive_end)
    if not latest:
        return intervals.limit(0).select(
            F.lit("").alias("period"), "segment", "stock_code",
            F.lit(None).cast("bigint").alias("total"), F.lit(None).cast("double").alias("weight"))

    blocks = -(-len(periods) // BLOCK)

    def by_period(kind: str, value: Callable[[dt.datetime], object]) -> Column:
        """The segment's values for all places, from its literal."""
        found = None
        for segment in sorted({s for s, _ in latest}):
            known = [latest.get((segment, at)) for at in range(blocks * BLOCK)]
            literal = F.array(*[F.lit(None if x is None else value(x)).cast(kind) for x in known])
            found = (F.when(F.col("segment") == segment, literal) if found is None
                     else found.when(F.col("segment") == segment, literal))
        return found

    def time_class(x: dt.datetime) -> int:
        return times.index(x - dt.datetime.combine(x.date(), dt.time.min))

    first, last = F.expr(f"`begin` div {BLOCK}"), F.expr(f"(`end` - 1) div {BLOCK}")
    rows = intervals.select("*", F.explode(F.sequence(first, last)).alias("block"))
    rows = rows.withColumn("days", F.slice(by_period("date", lambda x: x.date()),
                                           F.col("block") * BLOCK + 1, BLOCK))
    rows = rows.withColumn("classes", F.slice(by_period("int", time_class),
                                              F.col("block") * BLOCK + 1, BLOCK))
    sums = []
    for i in range(min(BLOCK, len(periods))):
        at = F.col("block") * BLOCK + i
        age = (F.datediff(F.get("days", F.lit(i)), F.col("day"))
               - (F.col("time_class") > F.get("classes", F.lit(i))).cast("int"))
        sums.append(F.sum(F.when((F.col("begin") <= at) & (at < F.col("end")),
                                 F.col("sales") / (1 + age))).alias(f"w{i}"))
    summed = rows.groupBy("segment", "stock_code", "block").agg(*sums)
    names = F.array(*[f"w{i}" for i in range(len(sums))])
    return (summed.select("segment", "stock_code", "block",
                          F.posexplode(names).alias("i", "weight"))
            .filter(F.col("weight").isNotNull())
            .select(F.get(F.lit(list(periods)), (F.col("block") * BLOCK + F.col("i")).cast("int"))
                    .alias("period"), "segment", "stock_code",
                    F.lit(None).cast("bigint").alias("total"), "weight"))


def recommend(lines: DataFrame, segmented: DataFrame, periods: Sequence[str],
              top_n: int = S.TOP_RECOMMENDATIONS, inclusive_end: bool = False) -> DataFrame:
    """The best `top_n` products of every segment and period, scored 0-100 of the segment's best.

    `segmented` needs customer_id, period, segment and last_purchase. The ranked sum depends
    on the segment: revenue, units sold, or sales weighted by 1 / (1 + days before the
    segment's latest sale). Sums are partial before the shuffle on (period, segment,
    product), so neither a heavy product nor a large segment lands in one task whole."""
    periods = sorted(set(periods))
    members = segmented.filter(F.col("period").isin(periods)).select(
        "customer_id", "period", "segment", "last_purchase")
    sold = lines.filter((F.col("amount_cents") > 0)
                        & (F.col("invoice_date") <= _limits(periods, inclusive_end)[-1])).select(
        "customer_id", "stock_code", "invoice_date", "amount_cents",
        F.col("quantity").cast("bigint").alias("quantity"))
    metric = F.col("metric")
    runs = _runs(members, periods)
    totals = (_running_totals(sold, runs, periods, inclusive_end)
              .unionByName(_weighted_totals(sold, members, runs, periods, inclusive_end))
              .withColumn("metric", _metric(F.col("segment"))))
    best = totals.groupBy("period", "segment").agg(
        F.max("total").alias("best_total"), F.max("weight").alias("best_weight"))
    scaled = totals.join(F.broadcast(best), ["period", "segment"])  # one row per period, segment

    def share(value: str) -> Column:
        return F.when(F.col(f"best_{value}") > 0, numbers.float_round(
            F.col(value) / F.col(f"best_{value}").cast("double") * F.lit(100.0), 2)).otherwise(
            F.col(value).cast("double"))

    revenue = F.round(F.col("total").cast("decimal(22,0)") * F.lit(100).cast("decimal(3,0)")
                      / F.col("best_total").cast("decimal(20,0)"), 2).cast("double")
    score = (F.when(metric == "revenue", revenue)
             .when(metric == WEIGHTED, share("weight"))
             .otherwise(share("total")))
    place = F.row_number().over(Window.partitionBy("period", "segment").orderBy(
        F.col("score").desc(), F.col("stock_code")))
    return (scaled.withColumn("score", score).withColumn("rank", place)
            .filter(F.col("rank") <= top_n)
            .select("segment", "stock_code", F.col("score").cast(S.SCORE).alias("score"),
                    "rank", "period"))


def describe(recommended: DataFrame, products: DataFrame) -> DataFrame:
    """Add the product description; the recommended side is the short one."""
    named = products.select("stock_code", "description")
    return recommended.join(named, "stock_code").select(
        "segment", "stock_code", "description", "score", "rank", "period")
