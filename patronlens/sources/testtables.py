"""The driver's tables as raw invoice lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from patronlens import schemas as S
from patronlens.staging import source_version


_schemas: dict[tuple, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read once per process and state of the table."""
    path = f"{sf_dir}/{name}.parquet"
    key = (path, source_version(spark, path))
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def retail_lines(spark: SparkSession, sf_dir: str, country: bool = False) -> DataFrame:
    """Order lines as invoice lines; returned lines play the cancelled invoices.

    Joins carry no hints: small sides are broadcast by their known size, others shuffled.
    Left joins keep every line, cleaning decides what goes. The customer and nation tables
    are only joined when the country is asked for."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    joined = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
              .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left"))
    columns = [
        F.concat(F.when(F.col("l_returnflag") == "R", F.lit("C")).otherwise(F.lit("")),
                 F.col("o_orderkey").cast("string")).alias(S.INVOICE),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias(S.PRODUCT),
        F.col("p_name").alias(S.DESCRIPTION),
        F.col("l_quantity").alias(S.QUANTITY),
        F.col("o_orderdate").alias(S.DATE),
        F.col("p_retailprice").alias(S.PRICE),
        F.col("o_custkey").alias(S.CUSTOMER),
    ]
    if country:
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        joined = (joined.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
                  .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"))
        columns.append(F.col("n_name").alias(S.COUNTRY))
    return joined.select(*columns)


def purchase_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as one-line invoices; their times of day reach past midnight cutoffs."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return events.select(
        F.col("event_id").cast("string").alias(S.INVOICE),
        F.concat(F.lit("E"), F.pmod("event_id", F.lit(100)).cast("string")).alias(S.PRODUCT),
        F.lit(1.0).alias(S.QUANTITY), F.col("ts").alias(S.DATE),
        F.col("value").alias(S.PRICE), F.col("user_id").alias(S.CUSTOMER))
