"""Scores 1..n from data-dependent thresholds, and the segment rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from patronlens import schemas as S
from patronlens.functions import dates, numbers
from patronlens.operators.ordering import order_statistics
from patronlens.staging import stage

# metric -> (integer column, units per whole, small values are best)
METRICS = {
    "recency": ("recency", 1, True),
    "frequency": ("frequency", 1, False),
    "monetary": ("monetary_cents", 100, False),
}


def _bin_fractions(bins: int) -> list[float]:
    """0, 1/bins, ..., 1 as evenly spaced floats: multiples of the float 1/bins, so with five
    bins the fourth is 0.6000000000000001. The binning this follows uses these very floats;
    their noise decides whether two quantiles coincide."""
    return [k * (1.0 / bins) for k in range(bins)] + [1.0]


def rfm_thresholds(rfm: DataFrame, bins: int = S.SCORE_BINS) -> DataFrame:
    """Bin edges per period and metric: one row each.

    method "quantile": equal-count bins on linearly interpolated quantiles
    (`quantile_edges`). As soon as two quantiles coincide the metric switches to "width":
    equally wide bins between the extremes (`width_edges`). Both are in units of the metric.
    `edges` are the edges in force as integers: x lies above an edge when x > edges[i]."""
    long = rfm.select("period", F.inline(F.array(*[
        F.struct(F.lit(metric).alias("metric"), F.lit(float(units)).alias("unit"),
                 F.col(column).cast("bigint").alias("v"))
        for metric, (column, units, _) in METRICS.items()])))
    fractions = _bin_fractions(bins)
    lows = [f"cast(floor(cast(n - 1 as double) * {q!r}D) as bigint)" for q in fractions]
    highs = [f"least({low} + 1, n - 1)" for low in lows]
    found = order_statistics(long, ["period", "metric", "unit"], "v", [*lows, *highs])
    unit = F.col("unit")
    found = found.select(
        "period", "metric", "unit", "n", (F.col("v_min") / unit).alias("low"),
        (F.col("v_max") / unit).alias("high"),
        *[F.expr("array(" + ", ".join(f"at_{at + k} / unit" for k in range(bins + 1)) + ")")
          .alias(name) for name, at in (("lows", 0), ("highs", bins + 1))])

    def between(q: Column, i: Column) -> Column:
        """The quantile between its two neighbours, from the nearer one."""
        place, low, high = (F.col("n") - 1) * q, F.get("lows", i), F.get("highs", i)
        part = place - F.floor(place)
        return F.when(part < 0.5, low + (high - low) * part).otherwise(
            high - (high - low) * (F.lit(1.0) - part))

    # a constant column is widened by a thousandth on both sides
    slack = F.when(F.col("low") < F.col("high"), F.lit(0.0)).when(
        F.col("low") == 0, F.lit(0.001)).otherwise(F.lit(0.001) * F.abs("low"))
    bottom, top = F.col("low") - F.col("slack"), F.col("high") + F.col("slack")
    edges = found.withColumns({
        "quantiles": F.transform(F.lit(fractions), between), "slack": slack}).select(
        "period", "metric", "unit", "n",
        F.when(F.size(F.array_distinct("quantiles")) == bins + 1, F.lit("quantile"))
        .otherwise(F.lit("width")).alias("method"),
        F.slice("quantiles", 2, bins - 1).alias("quantile_edges"),
        F.transform(F.lit([float(k) for k in range(1, bins)]), lambda k: (
            k * ((top - bottom) / F.lit(float(bins))) + bottom)).alias("width_edges"))

    def whole(edge: Column) -> Column:
        """The largest integer whose value in units does not exceed the edge."""
        near = F.floor(edge * unit)
        return (F.when((near + 1) / unit <= edge, near + 1)
                .when(near / unit > edge, near - 1).otherwise(near)).cast("bigint")

    in_force = F.when(F.col("method") == "quantile", F.col("quantile_edges")).otherwise(
        F.col("width_edges"))
    return edges.select("period", "metric", "n", "method", "quantile_edges", "width_edges",
                        F.transform(in_force, whole).alias("edges"))


def _score(metric: str, bins: int) -> Column:
    column, _, small_is_best = METRICS[metric]
    above = " + ".join(f"int({column} > {metric}_edges[{i}])" for i in range(bins - 1))
    return F.expr(f"{bins} - ({above})" if small_is_best else f"1 + {above}")


def segment_name(r: int, f: int, m: int) -> str:
    """The first rule whose three ranges hold the scores, else the default segment."""
    for name, *ranges in S.SEGMENT_RULES:
        lows, highs = ranges[0::2], ranges[1::2]
        if all(low <= s <= high for low, s, high in zip(lows, (r, f, m), highs)):
            return name
    return S.DEFAULT_SEGMENT


def segment_of(r: str, f: str, m: str, bins: int = S.SCORE_BINS) -> Column:
    """Segment of the score triple in three columns. The rules are settled per triple when
    the plan is built, so a row costs one lookup in a constant array instead of a chain of
    range checks."""
    marks = range(1, bins + 1)
    names = ", ".join(f"'{segment_name(i, j, k)}'" for i in marks for j in marks for k in marks)
    return F.expr(f"get(array({names}), (({r} - 1) * {bins} + {f} - 1) * {bins} + {m} - 1)")


def score_rfm(rfm: DataFrame, thresholds: DataFrame, bins: int = S.SCORE_BINS) -> DataFrame:
    """r/f/m scores, their concatenation and their sum."""
    edges = thresholds.groupBy("period").pivot("metric", list(METRICS)).agg(F.first("edges"))
    edges = edges.withColumnsRenamed({m: f"{m}_edges" for m in METRICS})
    scored = rfm.join(F.broadcast(edges), "period").select(  # one row per period
        *rfm.columns, _score("recency", bins).alias("r_score"),
        _score("frequency", bins).alias("f_score"), _score("monetary", bins).alias("m_score"))
    return scored.withColumns({
        "rfm_score": F.expr("concat(r_score, f_score, m_score)"),
        "rfm_total": F.expr("r_score + f_score + m_score")})


def assign_segment(scored: DataFrame, bins: int = S.SCORE_BINS) -> DataFrame:
    return scored.withColumn("segment", segment_of("r_score", "f_score", "m_score", bins))


def score_and_segment(rfm: DataFrame, bins: int = S.SCORE_BINS) -> DataFrame:
    """Scored and segmented customers of every period in `rfm`. The input is used for the
    thresholds and again for the scores, so it is written once first; so are the thresholds,
    three rows a period, which every later use of the result would find again."""
    base = stage(rfm, "rfm")
    edges = stage(rfm_thresholds(base, bins), "thresholds")
    return assign_segment(score_rfm(base, edges, bins), bins)


def as_snapshot(segmented: DataFrame) -> DataFrame:
    """Rows of the period-partitioned history table."""
    return segmented.select(
        F.last_day(F.to_date(F.concat("period", F.lit("-01")))).alias("snapshot_date"),
        "customer_id", "recency", "frequency",
        numbers.to_money(F.col("monetary_cents")).alias("monetary"),
        "r_score", "f_score", "m_score", "rfm_score", "segment", "period")


def as_latest(segmented: DataFrame, calculated_at: Column | None = None) -> DataFrame:
    """Rows of the latest-scores table, one per customer."""
    stamp = F.localtimestamp() if calculated_at is None else calculated_at
    return segmented.select(
        "customer_id", "recency", "frequency",
        numbers.to_money(F.col("monetary_cents")).alias("monetary"),
        "r_score", "f_score", "m_score", "rfm_score", "rfm_total", "segment", "period",
        stamp.alias("calculated_at"))
