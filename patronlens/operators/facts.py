"""Sales facts: staging projection and key lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from patronlens import schemas as S
from patronlens.functions import dates

UNKNOWN_GEO_KEY = 0


def staging_facts(lines: DataFrame) -> DataFrame:
    """The columns the fact table is made of, still with natural keys."""
    country = F.col("country") if "country" in lines.columns else F.lit(S.UNKNOWN_COUNTRY)
    also = [c for c in ("period",) if c in lines.columns]
    return lines.select(
        *also, "invoice_no", "customer_id", "stock_code",
        dates.date_key(F.col("invoice_date")).alias("date_key"),
        country.alias("country"), "quantity", "unit_price", "total_amount", "invoice_date")


def resolve_keys(staged: DataFrame, customers: DataFrame, products: DataFrame,
                 geography: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fact rows with surrogate keys, and the columns to `keep`. Rows without customer, product or date drop out; an
    unknown country gets key 0.

    No side is hinted: a dimension is broadcast when its known size allows it and joined
    by shuffle, with skewed keys split, when it does not."""
    return (staged
            .filter(F.col("date_key").isNotNull())
            .join(customers.select("customer_id", "customer_key"), "customer_id")
            .join(products.select("stock_code", "product_key"), "stock_code")
            .join(geography.select("country", "geo_key"), "country", "left")
            .select(*keep, "invoice_no",
                    F.col("customer_key").cast("bigint").alias("customer_key"),
                    F.col("product_key").cast("bigint").alias("product_key"),
                    F.col("date_key").cast("int").alias("date_key"),
                    F.coalesce(F.col("geo_key").cast("bigint"),
                               F.lit(UNKNOWN_GEO_KEY).cast("bigint")).alias("geo_key"),
                    F.col("quantity").cast("int").alias("quantity"),
                    F.col("unit_price").cast(S.UNIT_PRICE).alias("unit_price"),
                    F.col("total_amount").cast(S.MONEY).alias("total_amount"),
                    F.col("invoice_date").cast("timestamp_ntz").alias("invoice_date")))


def fact_lines(facts: DataFrame, customers: DataFrame, products: DataFrame | None = None,
               geography: DataFrame | None = None) -> DataFrame:
    """Stored facts back under natural keys, as scoring, ranking and reports read them."""
    lines = facts.join(customers.select("customer_key", "customer_id"), "customer_key")
    columns = ["invoice_no", "customer_id", "quantity", "invoice_date",
               (F.col("total_amount") * F.lit(100).cast("decimal(3,0)")).cast("bigint")
               .alias("amount_cents")]
    if products is not None:
        lines = lines.join(products.select("product_key", "stock_code"), "product_key")
        columns.append("stock_code")
    if geography is not None:
        lines = lines.join(geography.select("geo_key", "country"), "geo_key")
        columns.append("country")
    return lines.select(*columns)
