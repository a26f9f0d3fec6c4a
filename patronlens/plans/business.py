"""Reports over sales lines (natural keys, `amount_cents`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from patronlens import schemas as S
from patronlens.functions import dates, numbers, text


def _per_group(lines: DataFrame, keys: dict[str, Column], customers: bool = True) -> DataFrame:
    """Cents, units, orders and customers per group.

    Lines are reduced once to (group, invoice, customer); what is left is reduced to one row
    per (group, invoice) and one per (group, customer), so nothing is repeated for the two distinct
    counts and a heavy group meets as partial counts only."""
    names = list(keys)
    units = F.col("quantity").cast("bigint") if "quantity" in lines.columns else F.lit(0)
    base = (lines.groupBy(*[c.alias(n) for n, c in keys.items()], "invoice_no", "customer_id")
            .agg(F.sum("amount_cents").alias("cents"), F.sum(units).alias("units_sold")))
    sums = (F.sum("cents").alias("cents"), F.sum("units_sold").alias("units_sold"))
    orders = (base.groupBy(*names, "invoice_no").agg(*sums).groupBy(*names)
              .agg(*sums, F.count("invoice_no").alias("orders")))
    if not customers:
        return orders
    buyers = (base.groupBy(*names, "customer_id").agg(F.lit(1).alias("one")).groupBy(*names)
              .agg(F.count("customer_id").alias("customers")))
    same = [F.col(f"o.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]
    return orders.alias("o").join(buyers.alias("b"), same).select("o.*", "b.customers")


def _revenue() -> Column:
    return numbers.to_big_money(F.col("cents")).alias("revenue")


def monthly_overview(lines: DataFrame) -> DataFrame:
    """Orders, customers, revenue and average order value per calendar month."""
    day = F.col("invoice_date").cast("date")
    return (_per_group(lines, {"year": F.year(day), "month": F.month(day)})
            .select("year", "month",
                    F.concat_ws("-", F.col("year").cast("string"),
                                F.lpad(F.col("month").cast("string"), 2, "0")).alias("ym"),
                    "orders", "customers", _revenue(),
                    numbers.money_mean(F.col("cents"), F.col("orders")).alias("aov"))
            .orderBy("year", "month"))


def overview_kpis(monthly: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Totals over the chosen years' months; `customers` adds up the monthly counts and
    `avg_aov` is the plain mean of the monthly values."""
    chosen = monthly if years is None else monthly.filter(F.col("year").isin(list(years)))
    return chosen.agg(F.sum("revenue").cast("decimal(26,2)").alias("revenue"),
                      F.sum("orders").alias("orders"), F.sum("customers").alias("customers"),
                      numbers.money_mean(
                          F.sum(F.col("aov") * 100).cast("decimal(24,0)"),
                          F.count("aov")).alias("avg_aov"))


def year_list(monthly: DataFrame) -> DataFrame:
    return monthly.select("year").distinct().orderBy("year")


def top_products(lines: DataFrame, products: DataFrame, limit: int = S.TOP_PRODUCTS,
                 label_width: int = 24) -> DataFrame:
    """Best-selling products. Descriptions are looked up for the winners only."""
    best = (_per_group(lines, {"stock_code": F.col("stock_code")})
            .orderBy(F.col("cents").desc(), "stock_code").limit(limit))
    return (products.join(best, "stock_code")
            .select("stock_code", "description", _revenue(), "units_sold", "orders", "customers",
                    text.product_label(F.col("stock_code"), F.col("description"),
                                       label_width).alias("label"))
            .orderBy(F.col("revenue").desc(), "stock_code"))


def by_country(lines: DataFrame) -> DataFrame:
    return (_per_group(lines.filter(F.col("country").isNotNull()),
                       {"country": F.col("country")})
            .select("country", "customers", _revenue(), "orders")
            .orderBy(F.col("revenue").desc(), "country"))


def top_countries(lines: DataFrame, limit: int = S.TOP_COUNTRIES) -> DataFrame:
    return by_country(lines).limit(limit)


def by_weekday(lines: DataFrame) -> DataFrame:
    """Orders and revenue per weekday, Monday (0) first."""
    day = F.col("invoice_date").cast("date")
    return (_per_group(lines, {"day_of_week": F.weekday(day)}, customers=False)
            .withColumn("day_name", F.date_format(
                F.date_add(F.lit("2024-01-01").cast("date"), F.col("day_of_week")), "EEEE"))
            .select("day_name", "day_of_week", "orders", _revenue())
            .orderBy("day_of_week"))


def cohort_new_customers(dim_customer: DataFrame) -> DataFrame:
    """Customers by the month of their first order (one row per customer in the input)."""
    return (dim_customer.filter(F.col("first_order").isNotNull())
            .groupBy(dates.month_name(F.col("first_order")).alias("cohort_month"))
            .agg(F.count("customer_id").alias("new_customers"))
            .orderBy("cohort_month"))


def kpi_summary(dim_customer: DataFrame, dim_product: DataFrame, lines: DataFrame,
                customer_rfm: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row of headline figures over the warehouse tables."""
    figures = [
        dim_customer.agg(F.count(F.lit(1)).alias("customers")),
        dim_product.agg(F.count(F.lit(1)).alias("products")),
        lines.groupBy("invoice_no").agg(F.sum("amount_cents").alias("cents")).agg(
            F.count("invoice_no").alias("orders"),
            F.coalesce(F.sum("cents"), F.lit(0)).alias("cents")),
        customer_rfm.agg(F.count(F.lit(1)).alias("rfm_count")),
        snapshots.select("period").distinct().agg(  # one row per period
            F.count("period").alias("periods"), F.max("period").alias("latest_period")),
    ]
    # five one-row tables side by side: stacked, then folded into one row
    stacked = figures[0]
    for figure in figures[1:]:
        stacked = stacked.unionByName(figure, allowMissingColumns=True)
    folded = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return folded.select("customers", "products", "orders", _revenue(), "rfm_count", "periods",
                         "latest_period",
                         text.compact_money(F.col("cents") / 100.0).alias("revenue_label"))
