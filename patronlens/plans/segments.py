"""Reports over the latest scores: one row per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from patronlens import schemas as S
from patronlens.functions import numbers
from patronlens.operators.ordering import order_statistics, quantile_ranks, scaled_quantile


def _cents() -> Column:
    return numbers.to_cents(F.col("monetary"))


def _mean(total: str, count: str = "customers") -> Column:
    return F.col(total) / F.col(count).cast("double")


def _totals(customers: DataFrame, *keys: str) -> DataFrame:
    return customers.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("recency").cast("bigint")).alias("recency_sum"),
        F.sum("frequency").alias("frequency_sum"), F.sum(_cents()).alias("cents"))


def segment_distribution(customers: DataFrame) -> DataFrame:
    """Customers per segment and their share in percent (1 digit)."""
    counts = customers.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n")).scalar()
    return (counts.withColumn("pct", numbers.float_round(
                F.col("n") / whole.cast("double") * F.lit(100.0), 1))
            .orderBy(F.col("n").desc(), "segment"))


def segment_summary(customers: DataFrame) -> DataFrame:
    """Size, mean recency, frequency and spend, and revenue per segment, all to 1 digit."""
    return (_totals(customers, "segment")
            .select("segment", "customers",
                    numbers.float_round(_mean("recency_sum"), 1).alias("avg_recency"),
                    numbers.float_round(_mean("frequency_sum"), 1).alias("avg_frequency"),
                    numbers.money_mean(F.col("cents"), F.col("customers"), 1).alias("avg_monetary"),
                    F.round(numbers.to_big_money(F.col("cents")), 1).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), "segment"))


def segment_share(customers: DataFrame) -> DataFrame:
    """Each segment's share of customers and of revenue (fractions, 6 digits)."""
    totals = _totals(customers, "segment").select("segment", "customers", "cents")
    whole = totals.agg(F.sum("customers").alias("customers"), F.sum("cents").alias("cents"))

    def share(value: str) -> Column:
        return numbers.float_round(
            F.col(value) / whole.select(value).scalar().cast("double"), 6)

    return totals.select("segment", "customers", share("customers").alias("customer_share"),
                         numbers.to_big_money(F.col("cents")).alias("revenue"),
                         share("cents").alias("revenue_share"))


def segment_scores_long(customers: DataFrame) -> DataFrame:
    """Mean r/f/m score per segment (2 digits), one row per indicator."""
    means = customers.groupBy("segment").agg(*[
        numbers.float_round(F.sum(c) / F.count(c).cast("double"), 2).alias(name)
        for c, name in (("r_score", "Recency"), ("f_score", "Frequency"),
                        ("m_score", "Monetary"))])
    return means.unpivot(["segment"], ["Recency", "Frequency", "Monetary"], "indicator", "value")


def segment_detail(customers: DataFrame, dim_customer: DataFrame, segment: str,
                   limit: int | None = None) -> DataFrame:
    """A segment's customers by spend, with their country; `limit` keeps the first rows."""
    chosen = customers.filter(F.col("segment") == segment).select(
        "customer_id", "recency", "frequency", "monetary", "rfm_score")
    order = [F.col("monetary").desc(), F.col("customer_id")]
    countries = dim_customer.select("customer_id", "country")
    if limit is not None:
        chosen = chosen.orderBy(*order).limit(limit)
        # where `limit` is small, its rows are broadcast by size and the countries only filtered
        countries = countries.join(chosen.select("customer_id"), "customer_id", "left_semi")
    return chosen.join(countries, "customer_id", "left").select(
        "customer_id", "recency", "frequency", "monetary", "rfm_score", "country").orderBy(*order)


def segment_kpis(customers: DataFrame, segment: str) -> DataFrame:
    """Size and means of one segment: recency to 0, frequency and spend to 1 digit."""
    chosen = customers.filter(F.col("segment") == segment)
    return _totals(chosen).select(
        "customers", numbers.float_round(_mean("recency_sum"), 0).alias("avg_recency"),
        numbers.float_round(_mean("frequency_sum"), 1).alias("avg_frequency"),
        numbers.money_mean(F.col("cents"), F.col("customers"), 1).alias("avg_monetary"))


def segment_names(customers: DataFrame) -> DataFrame:
    return customers.select("segment").distinct().orderBy("segment")


def _spend(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "segment", _cents().alias("cents"))


def _p95(spend: DataFrame) -> DataFrame:
    """95th percentile of spend per segment, linear between neighbours: one row a segment."""
    found = order_statistics(spend, ["segment"], "cents",
                             quantile_ranks([(19, 20)]))
    return found.select("segment", F.col("v_max").alias("top"),
                        scaled_quantile(0, 19, 20).alias("p95_x20"))


def monetary_outliers(customers: DataFrame) -> DataFrame:
    """Per segment: p95 of spend, the largest spend, whether it exceeds 1.5 x p95, and the
    number of customers above p95."""
    spend = _spend(customers)
    limits = F.broadcast(_p95(spend))  # one row per segment
    return (spend.join(limits, "segment").groupBy("segment")
            .agg(F.max("p95_x20").alias("p95_x20"), F.max("top").alias("top"),
                 F.count_if(F.col("cents") * 20 > F.col("p95_x20")).alias("above"))
            .select("segment", (F.col("p95_x20") / 2000.0).alias("p95"),
                    numbers.to_money(F.col("top")).alias("max_monetary"),
                    (F.col("top") * 40 > F.col("p95_x20") * 3).alias("has_outlier"),
                    F.col("above").alias("customers_above_p95")))


def monetary_histogram(customers: DataFrame, bins: int = S.HISTOGRAM_BINS) -> DataFrame:
    """Spend per segment in equal bins on [0, 1.1 x p95]; bin bins+1 holds what lies beyond
    the shown range, so the counts add up to all customers."""
    spend = _spend(customers)
    limits = F.broadcast(_p95(spend))  # one row per segment
    # bin = floor(cents / (1.1 * p95 / bins)) in whole numbers; p95 is kept times 20
    place = F.least(F.expr(f"(cents * {200 * bins}) div (p95_x20 * 11)"), F.lit(bins))
    return (spend.join(limits, "segment")
            .groupBy("segment", (place + 1).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("customers")))


def monetary_boxplot(customers: DataFrame) -> DataFrame:
    """Five-number summary of spend per segment, and the outermost values within 1.5
    interquartile ranges of the box."""
    spend = _spend(customers)
    quarters = [(1, 4), (2, 4), (3, 4)]
    found = order_statistics(spend, ["segment"], "cents", quantile_ranks(quarters))
    box = found.select("segment", F.col("n").alias("customers"), "v_min", "v_max",
                       *[scaled_quantile(i, *quarter).alias(f"q{i + 1}_x4")
                         for i, quarter in enumerate(quarters)])
    box = F.broadcast(box)  # one row per segment
    reach = F.col("q3_x4") - F.col("q1_x4")
    inside = (F.col("cents") * 8 >= F.col("q1_x4") * 2 - reach * 3) & (
        F.col("cents") * 8 <= F.col("q3_x4") * 2 + reach * 3)
    within = F.when(inside, F.col("cents"))
    return (spend.join(box, "segment").groupBy("segment")
            .agg(*[F.max(c).alias(c) for c in (
                    "customers", "v_min", "v_max", "q1_x4", "q2_x4", "q3_x4")],
                 F.min(within).alias("fence_low"), F.max(within).alias("fence_high"))
            .select("segment", "customers", numbers.to_money(F.col("v_min")).alias("min"),
                    (F.col("q1_x4") / 400.0).alias("q1"), (F.col("q2_x4") / 400.0).alias("median"),
                    (F.col("q3_x4") / 400.0).alias("q3"),
                    numbers.to_money(F.col("v_max")).alias("max"),
                    numbers.to_money(F.col("fence_low")).alias("lower_fence"),
                    numbers.to_money(F.col("fence_high")).alias("upper_fence")))
