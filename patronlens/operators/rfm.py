"""Recency, frequency and monetary value per customer, for one cutoff or for many."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronlens.functions import dates


def sold_until(lines: DataFrame, limit: dt.datetime | None) -> DataFrame:
    """Lines with a positive amount, up to the cutoff if there is one."""
    kept = lines.filter(F.col("amount_cents") > 0)
    if limit is not None:
        kept = kept.filter(F.col("invoice_date") <= dates.timestamp_literal(limit))
    return kept


def customer_totals(lines: DataFrame) -> DataFrame:
    """Last purchase, number of invoices and spend per customer.

    The distinct count is computed on (customer, invoice) first, so a customer who owns a
    large share of all lines is spread over many tasks."""
    return lines.groupBy("customer_id").agg(
        F.max("invoice_date").alias("last_purchase"),
        F.count_distinct("invoice_no").alias("frequency"),
        F.sum("amount_cents").alias("monetary_cents"))


def compute_rfm(lines: DataFrame, reference_date: str | dt.datetime | None = None) -> DataFrame:
    """One row per customer: recency (whole days before the reference), frequency, spend.

    The reference is one day after midnight of a text date; a datetime is used as it is;
    without one it is a day after the latest sale, time of day included."""
    totals = customer_totals(lines)
    if reference_date is None:
        # the latest sale is the latest of the customers' latest sales
        latest = totals.agg((F.max("last_purchase") + F.expr("interval '1' day")).alias("reference"))
        reference: Column = latest.scalar()
    elif isinstance(reference_date, str):
        reference = dates.timestamp_literal(
            dt.datetime.fromisoformat(reference_date) + dt.timedelta(days=1))
    else:
        reference = dates.timestamp_literal(reference_date)
    return totals.select(
        "customer_id",
        dates.whole_days_between(reference, F.col("last_purchase")).alias("recency"),
        "frequency", "monetary_cents", "last_purchase")


def period_rfm(lines: DataFrame, period: str, inclusive_end: bool = False) -> DataFrame:
    """`compute_rfm` for one period: cutoff and reference follow from the period."""
    limit = dates.cutoff(period, inclusive_end)
    return (compute_rfm(sold_until(lines, limit), dates.period_end(period).isoformat())
            .withColumn("period", F.lit(period)))


def backfill_rfm(lines: DataFrame, periods: Sequence[str],
                 inclusive_end: bool = False) -> DataFrame:
    """`period_rfm` for every period of the list in one pass over the lines.

    Each line enters at the first period whose cutoff is not before it. Customers are
    reduced to what changed per period (latest sale, spend, invoices not seen earlier), and
    running totals over these few rows give the state at each period. No line is repeated
    per period."""
    periods = sorted(set(periods))
    limits = [dates.timestamp_literal(dates.cutoff(p, inclusive_end)) for p in periods]
    sold = lines.filter((F.col("amount_cents") > 0) & (F.col("invoice_date") <= limits[-1]))
    entry = F.when(F.col("invoice_date") <= limits[0], F.lit(0))
    for i, limit in enumerate(limits[1:], start=1):
        entry = entry.when(F.col("invoice_date") <= limit, F.lit(i))

    invoices = (sold.withColumn("idx", entry)
                .groupBy("customer_id", "invoice_no", "idx")
                .agg(F.max("invoice_date").alias("last_purchase"),
                     F.sum("amount_cents").alias("cents")))
    first_seen = F.min("idx").over(Window.partitionBy("customer_id", "invoice_no"))
    changes = (invoices.withColumn("new_invoice", (F.col("idx") == first_seen).cast("bigint"))
               .groupBy("customer_id", "idx")
               .agg(F.max("last_purchase").alias("last_purchase"),
                    F.sum("cents").alias("cents"),
                    F.sum("new_invoice").alias("invoices")))

    by_customer = Window.partitionBy("customer_id").orderBy("idx")
    so_far = by_customer.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_change = F.lead("idx").over(by_customer)
    states = changes.select(
        "customer_id",
        F.max("last_purchase").over(so_far).alias("last_purchase"),
        F.sum("invoices").over(so_far).alias("frequency"),
        F.sum("cents").over(so_far).alias("monetary_cents"),
        F.col("idx").alias("from"),
        F.coalesce(next_change - 1, F.lit(len(periods) - 1)).alias("to"))
    # a state holds from the period that made it to the one before the next change
    states = states.withColumn("idx", F.explode(F.sequence("from", "to")))
    names = F.array(*[F.lit(p) for p in periods])
    ends = F.array(*[F.lit(dates.period_end(p)) for p in periods])
    reference = (F.get(ends, F.col("idx")).cast("timestamp_ntz") + F.expr("interval '1' day"))
    return states.select(
        "customer_id",
        dates.whole_days_between(reference, F.col("last_purchase")).alias("recency"),
        "frequency", "monetary_cents", "last_purchase",
        F.get(names, F.col("idx")).alias("period"))
