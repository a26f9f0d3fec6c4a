"""Mergeable monthly reductions and the running state they are folded into.

A month of lines is reduced to its (customer, invoice) pairs, its lines per (customer,
country) and its first uses of (code, description). These tables depend on nothing but the
month, so a month can be loaded again. The running state after a period is the state of an
earlier period plus the reductions of the months between: sums, least and greatest values,
and for the distinct counts the pairs not seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronlens import schemas as S
from patronlens.functions import dates


def month_invoices(lines: DataFrame) -> DataFrame:
    """(period, customer, invoice) with the times of its lines, and time and cents of those
    that count as purchases: they name a product and have an amount."""
    bought = F.col("stock_code").isNotNull() & (F.col("amount_cents") > 0)
    return lines.groupBy("period", "customer_id", "invoice_no").agg(
        F.min("invoice_date").alias("first_order"), F.max("invoice_date").alias("last_order"),
        F.max(F.when(bought, F.col("invoice_date"))).alias("last_purchase"),
        F.coalesce(F.sum(F.when(bought, F.col("amount_cents"))), F.lit(0)).alias("cents"),
        F.max(F.coalesce(bought, F.lit(False))).alias("paid"))


def month_countries(lines: DataFrame) -> DataFrame:
    country = F.col("country") if "country" in lines.columns else F.lit(None).cast("string")
    return (lines.withColumn("country", country).filter(F.col("country").isNotNull())
            .groupBy("period", "customer_id", "country").agg(F.count(F.lit(1)).alias("lines")))


def month_products(lines: DataFrame) -> DataFrame:
    text = F.col("description") if "description" in lines.columns else F.lit(None).cast("string")
    return (lines.filter(F.col("stock_code").isNotNull()).withColumn("description", text)
            .groupBy("period", "stock_code", "description")
            .agg(F.min("invoice_date").alias("first_use")))


def fold_customers(state: DataFrame, months: DataFrame, earlier: DataFrame) -> DataFrame:
    """The customers' state after `months` (their invoices). `earlier` has the (customer,
    invoice, paid) rows of the months already in `state`, at least those whose invoice also
    occurs in `months`."""
    new = months.groupBy("customer_id", "invoice_no").agg(
        F.min("first_order").alias("first_order"), F.max("last_order").alias("last_order"),
        F.max("last_purchase").alias("last_purchase"), F.sum("cents").alias("cents"),
        F.max("paid").alias("paid"))
    seen = earlier.groupBy("customer_id", "invoice_no").agg(F.max("paid").alias("was_paid"))
    was_paid = F.coalesce("was_paid", F.lit(False))
    delta = (new.join(seen, ["customer_id", "invoice_no"], "left").groupBy("customer_id").agg(
        F.min("first_order").alias("first_order"), F.max("last_order").alias("last_order"),
        F.count_if(F.col("was_paid").isNull()).alias("total_orders"),
        F.max("last_purchase").alias("last_purchase"),
        F.count_if(F.col("paid") & ~was_paid).alias("frequency"),
        F.sum("cents").alias("monetary_cents")))
    return state.select(delta.columns).unionByName(delta).groupBy("customer_id").agg(
        F.min("first_order").alias("first_order"), F.max("last_order").alias("last_order"),
        F.sum("total_orders").alias("total_orders"), F.max("last_purchase").alias("last_purchase"),
        F.sum("frequency").alias("frequency"), F.sum("monetary_cents").alias("monetary_cents"))


def fold_countries(state: DataFrame, months: DataFrame) -> DataFrame:
    columns = ["customer_id", "country", "lines"]
    return (state.select(columns).unionByName(months.select(columns))
            .groupBy("customer_id", "country").agg(F.sum("lines").alias("lines")))


def fold_products(state: DataFrame, months: DataFrame) -> DataFrame:
    columns = ["stock_code", "description", "first_use"]
    return (state.select(columns).unionByName(months.select(columns))
            .groupBy("stock_code", "description").agg(F.min("first_use").alias("first_use")))


def customers(state: DataFrame, countries: DataFrame) -> DataFrame:
    """`dims.dim_customer` of all lines in the state."""
    usual = Window.partitionBy("customer_id").orderBy(F.desc("lines"), "country")
    country = (countries.withColumn("place", F.row_number().over(usual)).filter("place = 1")
               .select("customer_id", "country"))
    return state.join(country, "customer_id", "left").select(
        "customer_id", F.coalesce("country", F.lit(S.UNKNOWN_COUNTRY)).alias("country"),
        "first_order", "last_order", "total_orders")


def products(state: DataFrame) -> DataFrame:
    """`dims.dim_product` of all lines in the state."""
    return state.groupBy("stock_code").agg(
        F.min_by("description", F.struct("first_use", "description")).alias("description"))


def rfm_of(state: DataFrame, period: str) -> DataFrame:
    """`rfm.period_rfm` of all purchases in the state of that period."""
    reference: Column = (F.lit(dates.period_end(period)).cast("timestamp_ntz")
                         + F.expr("interval '1' day"))
    return state.filter(F.col("last_purchase").isNotNull()).select(
        "customer_id", dates.whole_days_between(reference, F.col("last_purchase")).alias("recency"),
        "frequency", "monetary_cents", "last_purchase", F.lit(period).alias("period"))
