"""Dimension tables derived from cleaned lines (warehouse column names)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronlens import schemas as S
from patronlens.functions import dates


def _country(lines: DataFrame) -> Column:
    return F.col("country") if "country" in lines.columns else F.lit(None).cast("string")


def dim_customer(lines: DataFrame) -> DataFrame:
    """Most frequent country (ties: smallest; none: 'Unknown'), first and last order,
    number of invoices.

    Lines are reduced to (customer, invoice) and to (customer, country) before anything
    meets on the customer alone; of the countries, the most frequent first one stays."""
    named = lines.withColumn("country", _country(lines))
    orders = (named.groupBy("customer_id", "invoice_no").agg(
                  F.min("invoice_date").alias("first_order"),
                  F.max("invoice_date").alias("last_order"))
              .groupBy("customer_id").agg(
                  F.min("first_order").alias("first_order"),
                  F.max("last_order").alias("last_order"),
                  F.count("invoice_no").alias("total_orders")))
    usual = Window.partitionBy("customer_id").orderBy(F.desc("lines"), "country")
    country = (named.filter(F.col("country").isNotNull()).groupBy("customer_id", "country")
               .agg(F.count(F.lit(1)).alias("lines"))
               .withColumn("place", F.row_number().over(usual)).filter("place = 1")
               .select("customer_id", "country"))
    return orders.join(country, "customer_id", "left").select(
        "customer_id", F.coalesce("country", F.lit(S.UNKNOWN_COUNTRY)).alias("country"),
        "first_order", "last_order", "total_orders")


def dim_product(lines: DataFrame) -> DataFrame:
    """One row per stock code with its earliest description (same time: the smaller text).

    Lines are first folded to (code, description) with a fixed-width minimum, which hashes
    and combines before the shuffle; only these few rows are compared as structs."""
    coded = lines.filter(F.col("stock_code").isNotNull())
    if "description" not in lines.columns:
        return coded.select("stock_code").distinct()
    first_use = coded.groupBy("stock_code", "description").agg(
        F.min("invoice_date").alias("first_use"))
    return first_use.groupBy("stock_code").agg(
        F.min_by("description", F.struct("first_use", "description")).alias("description"))


def dim_date(lines: DataFrame) -> DataFrame:
    """Every calendar day between the first and the last sale."""
    span = lines.agg(F.min("invoice_date").cast("date").alias("from"),
                     F.max("invoice_date").cast("date").alias("to"))
    day = F.col("full_date")
    return (span.filter(F.col("from").isNotNull())
            .select(F.explode(F.sequence("from", "to", F.expr("interval '1' day"))).alias("full_date"))
            .select(dates.date_key(day).alias("date_key"), "full_date",
                    F.year(day).alias("year"), F.quarter(day).alias("quarter"),
                    F.month(day).alias("month"), F.date_format(day, "MMMM").alias("month_name"),
                    F.weekofyear(day).alias("week"), F.weekday(day).alias("day_of_week"),
                    F.date_format(day, "EEEE").alias("day_name"),
                    (F.weekday(day) >= 5).alias("is_weekend")))


def dim_geography(lines: DataFrame) -> DataFrame:
    """Distinct countries; empty when the source has no such column."""
    return (lines.select(_country(lines).alias("country"))
            .filter(F.col("country").isNotNull()).distinct())
