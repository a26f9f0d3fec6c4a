"""Reports over the period-partitioned history (period, customer_id unique)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronlens import schemas as S
from patronlens.functions import numbers, text


def monthly_means(snapshots: DataFrame) -> DataFrame:
    """Size, mean recency, frequency, spend and revenue per period and segment."""
    n = F.col("customer_count")
    return (snapshots.groupBy("period", "segment")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 F.sum(F.col("recency").cast("bigint")).alias("recency_sum"),
                 F.sum("frequency").alias("frequency_sum"),
                 F.sum(numbers.to_cents(F.col("monetary"))).alias("cents"))
            .select("period", "segment", "customer_count",
                    numbers.decimal_mean(F.col("recency_sum"), n, 1).alias("avg_recency"),
                    numbers.decimal_mean(F.col("frequency_sum"), n, 1).alias("avg_frequency"),
                    numbers.money_mean(F.col("cents"), n).alias("avg_monetary"),
                    numbers.to_big_money(F.col("cents")).alias("total_revenue")))


def segment_monthly(snapshots: DataFrame) -> DataFrame:
    """`monthly_means` in order of periods, the segments with most revenue first."""
    return monthly_means(snapshots).orderBy("period", F.col("total_revenue").desc(), "segment")


def segment_timeseries(snapshots: DataFrame) -> DataFrame:
    return (snapshots.groupBy("period", "segment")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(numbers.to_cents(F.col("monetary"))).alias("cents"))
            .select("period", "segment", "n",
                    numbers.to_big_money(F.col("cents")).alias("revenue"))
            .orderBy("period", "segment"))


def segment_trend(snapshots: DataFrame, segment: str) -> DataFrame:
    """One segment's row of `segment_monthly` for every period."""
    return segment_monthly(snapshots.filter(F.col("segment") == segment)).orderBy("period")


def segment_stats(snapshots: DataFrame, period: str) -> DataFrame:
    n = F.col("customers")
    return (snapshots.filter(F.col("period") == period).groupBy("segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.sum(numbers.to_cents(F.col("monetary"))).alias("cents"),
                 F.sum("frequency").alias("frequency_sum"))
            .select("segment", "customers", numbers.money_mean(F.col("cents"), n).alias("avg_monetary"),
                    numbers.decimal_mean(F.col("frequency_sum"), n, 2).alias("avg_orders")))


def moves(snapshots: DataFrame) -> DataFrame:
    """Customers who changed segment between a period and the next one they appear in.

    `lead` over a customer's few periods replaces the lookup of the next period."""
    by_customer = Window.partitionBy("customer_id").orderBy("period")
    both = snapshots.select(
        F.col("period").alias("period_from"), F.col("segment").alias("segment_from"),
        F.lead("period").over(by_customer).alias("period_to"),
        F.lead("segment").over(by_customer).alias("segment_to"))
    return (both.filter(F.col("segment_from") != F.col("segment_to"))
            .groupBy("period_from", "period_to", "segment_from", "segment_to")
            .agg(F.count(F.lit(1)).alias("customer_count")))


def segment_migration(snapshots: DataFrame) -> DataFrame:
    """`moves` in order of periods, the largest first."""
    return moves(snapshots).orderBy("period_from", "period_to", F.col("customer_count").desc(),
                                    "segment_from", "segment_to")


def migration_pair(snapshots: DataFrame, period_from: str, period_to: str) -> DataFrame:
    """Customers by their segments in two periods, unchanged ones included.

    Both periods are read in one scan and folded per customer instead of joined."""
    # places in the list of segments instead of names: whole numbers are aggregated by hash
    place = F.array_position(F.lit(list(S.SEGMENTS)), F.col("segment"))

    def at(period: str) -> Column:
        return F.max(F.when(F.col("period") == period, place))

    both = (snapshots.filter(F.col("period").isin(period_from, period_to))
            .groupBy("customer_id")
            .agg(at(period_from).alias("from_seg"), at(period_to).alias("to_seg")))
    return (both.dropna(subset=["from_seg", "to_seg"]).groupBy("from_seg", "to_seg")
            .agg(F.count(F.lit(1)).alias("customers"))
            .withColumns({c: F.get(F.lit(list(S.SEGMENTS)), F.col(c).cast("int") - 1)
                          for c in ("from_seg", "to_seg")})
            .orderBy(F.col("customers").desc(), "from_seg", "to_seg"))


def migration_matrix(pairs: DataFrame) -> DataFrame:
    """The 9 x 9 grid in segment order, missing moves as 0; `pairs` has at most 81 rows."""
    spark = pairs.sparkSession
    grid = pairs.groupBy("from_seg").pivot("to_seg", list(S.SEGMENTS)).agg(F.sum("customers"))
    rows = spark.createDataFrame(list(enumerate(S.SEGMENTS)), "position int, from_seg string")
    return (rows.join(grid, "from_seg", "left").na.fill(0, list(S.SEGMENTS))
            .orderBy("position").select("from_seg", *S.SEGMENTS))


def top_migrations(pairs: DataFrame, limit: int = S.TOP_MOVES) -> DataFrame:
    return (pairs.filter(F.col("from_seg") != F.col("to_seg"))
            .orderBy(F.col("customers").desc(), "from_seg", "to_seg").limit(limit))


def customer_growth(snapshots: DataFrame) -> DataFrame:
    """Customers in the first and in the last period, and the difference."""
    counts = snapshots.groupBy("period").agg(F.count(F.lit(1)).alias("customers"))
    return (counts.agg(F.count(F.lit(1)).alias("periods"), F.min("period").alias("first_period"),
                       F.max("period").alias("last_period"),
                       F.min_by("customers", "period").alias("first_customers"),
                       F.max_by("customers", "period").alias("last_customers"))
            .withColumn("growth", F.col("last_customers") - F.col("first_customers")))


def period_list(snapshots: DataFrame, newest_first: bool = False) -> DataFrame:
    order = F.col("period").desc() if newest_first else F.col("period")
    return snapshots.select("period").distinct().orderBy(order)


def journey_candidates(snapshots: DataFrame, minimum: int = S.JOURNEY_MIN_PERIODS,
                       limit: int = S.JOURNEY_CANDIDATES) -> DataFrame:
    """Customers seen in at least `minimum` periods, most periods first. A customer has one
    row per period, so counting rows counts periods."""
    return (snapshots.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_periods"))
            .filter(F.col("n_periods") >= minimum)
            .orderBy(F.col("n_periods").desc(), "customer_id").limit(limit))


def customer_journey(snapshots: DataFrame, customer_id: str) -> DataFrame:
    """One customer's rows in order of period, with the chart's label and both of its
    possible heights: the score sum and spend / 100."""
    return (snapshots.filter(F.col("customer_id") == customer_id)
            .select("period", "segment", "recency", "frequency", "monetary",
                    "r_score", "f_score", "m_score",
                    (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total"),
                    (numbers.to_cents(F.col("monetary")) / 10000.0).alias("monetary_per_100"),
                    text.first_word(F.col("segment")).alias("label"))
            .orderBy("period"))


def journey_latest(snapshots: DataFrame) -> DataFrame:
    """Every customer's number of periods, current segment and latest spend."""
    # month, place of the segment and cents in whole numbers, aggregated by hash
    month = (F.substring("period", 1, 4).cast("int") * 100
             + F.substring("period", 6, 2).cast("int"))
    place = F.array_position(F.lit(list(S.SEGMENTS)), F.col("segment"))
    last = (snapshots.select("customer_id", month.alias("month"), place.alias("place"),
                             numbers.to_cents(F.col("monetary")).alias("cents"))
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("n_periods"), F.max("month").alias("month"),
                 F.max_by("place", "month").alias("place"),
                 F.max_by("cents", "month").alias("cents")))
    return last.select(
        "customer_id", "n_periods",
        F.format_string("%04d-%02d", F.expr("month div 100"), F.expr("month % 100"))
        .alias("latest_period"),
        F.get(F.lit(list(S.SEGMENTS)), F.col("place").cast("int") - 1).alias("current_segment"),
        numbers.to_money(F.col("cents")).alias("latest_monetary"))


def reco_period(recommendations: DataFrame, period: str, label_width: int = 28) -> DataFrame:
    return (recommendations.filter(F.col("period") == period)
            .select("segment", "stock_code", "description", "score", "rank",
                    text.product_label(F.col("stock_code"), F.col("description"),
                                       label_width).alias("label"))
            .orderBy("segment", "rank"))


def reco_compare(recommendations: DataFrame, period: str, rows: int = S.COMPARE_ROWS,
                 width: int = 26) -> DataFrame:
    """The first products of every segment with a shortened description."""
    return (recommendations.filter((F.col("period") == period) & (F.col("rank") <= rows))
            .select("segment", "rank", "stock_code",
                    F.substring("description", 1, width).alias("short_description"), "score")
            .orderBy("segment", "rank"))


def run_log(log: DataFrame) -> DataFrame:
    """Runs with their duration, newest first."""
    return (log.select("period", "status", "rows_loaded", "started_at",
                       (F.col("finished_at") - F.col("started_at")).alias("duration"))
            .orderBy(F.col("started_at").desc()))
