"""Scores and segments against pandas and the golden table; history against single runs."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens import schemas as S
from patronlens.operators import ordering, recommend, rfm, scoring
from patronlens.plans import history, segments

GOLDEN = """
1 1 HI HI HI HI AR
1 2 HI HI AR AR AR
1 3 HI HI AR AR AR
1 4 HI HI AR AR AR
1 5 HI HI AR AR AR
2 1 AS AS NA NA AR
2 2 AS AS NA NA AR
2 3 HI HI NA NA AR
2 4 HI HI NA NA AR
2 5 HI HI NA NA AR
3 1 PR PR PL PL HI
3 2 AS AS LO LO LO
3 3 HI HI LO LO LO
3 4 HI HI LO LO LO
3 5 HI HI LO LO LO
4 1 PR PR PL LO LO
4 2 HI HI LO CH CH
4 3 HI HI LO CH CH
4 4 HI HI LO CH CH
4 5 HI HI LO CH CH
5 1 RC RC PL LO CH
5 2 HI HI LO CH CH
5 3 HI HI LO CH CH
5 4 HI HI LO CH CH
5 5 HI HI LO CH CH
"""
SHORT = dict(CH="Champions", LO="Loyal Customers", PL="Potential Loyalist", RC="Recent Customers",
             PR="Promising", NA="Customers Needing Attention", AS="About to Sleep", AR="At Risk",
             HI="Hibernating")


def lines(spark, rows):
    """rows: (customer, invoice, timestamp text, cents, stock code, quantity)"""
    return (spark.createDataFrame(
        rows, "customer_id string, invoice_no string, t string, amount_cents bigint, "
              "stock_code string, quantity double")
        .withColumn("invoice_date", F.col("t").cast("timestamp_ntz")).drop("t"))


def example(spark):
    return lines(spark, [
        ("ann", "10", "2014-03-30", 12500, "A", 1.0), ("ann", "11", "2014-05-12", 30000, "A", 2.0),
        ("bo", "12", "2013-06-03", 4000, "B", 1.0), ("cy", "13", "2014-02-20", 21000, "A", 1.0),
        ("cy", "14", "2014-04-01", 7000, "B", 3.0), ("cy", "15", "2014-05-12", 18000, "C", 1.0)])


def random_lines(spark, seed=3, n=900, customers=60):
    """Sales over 14 months with times of day; a third belongs to one customer, invoices
    are shared by several lines and some reach over a month end."""
    rng = random.Random(seed)
    start, rows = dt.datetime(2010, 12, 1), []
    for i in range(n):
        customer = "big" if i % 3 == 0 else f"c{int(rng.paretovariate(0.7)) % customers}"
        moment = start + dt.timedelta(minutes=rng.randrange(60 * 24 * 425))
        if i % 11 == 0:  # last day of a month, after midnight
            moment = dt.datetime(2011, 1 + i % 12, 28, 10) + dt.timedelta(days=4)
            moment = moment.replace(day=1, hour=10) - dt.timedelta(days=1)
        rows.append((customer, f"{customer}-{rng.randrange(40)}", str(moment),
                     rng.randrange(0, 5000), f"P{int(rng.paretovariate(0.8)) % 25}",
                     float(rng.randrange(1, 9))))
    return lines(spark, rows)


def test_example_scores_and_segments(spark):
    totals = rfm.compute_rfm(example(spark), "2014-06-10").withColumn("period", F.lit("p"))
    found = {r.customer_id: (r.recency, r.frequency, r.monetary_cents, r.rfm_score, r.segment)
             for r in scoring.score_and_segment(totals).collect()}
    assert found == {"ann": (30, 2, 42500, "533", "Loyal Customers"),
                     "bo": (373, 1, 4000, "111", "Hibernating"),
                     "cy": (30, 3, 46000, "555", "Champions")}


def test_reference_date_rules_and_floored_days(spark):
    df = lines(spark, [("a", "1", "2011-11-01 10:00:00", 100, "A", 1.0)])

    def recency(reference):
        return rfm.compute_rfm(df, reference).collect()[0].recency

    assert recency("2011-12-01") == 30
    assert recency(dt.datetime(2011, 12, 2)) == 30
    assert recency(dt.datetime(2011, 11, 1)) == -1
    assert recency(None) == 1


def test_golden_segment_table(spark):
    expected = {}
    for row in GOLDEN.split("\n"):
        if row:
            r, f, *names = row.split()
            for m, name in enumerate(names, start=1):
                expected[int(r), int(f), m] = SHORT[name]
    df = spark.createDataFrame(list(expected), "r int, f int, m int")
    found = {(x.r, x.f, x.m): x.s for x in df.withColumn(
        "s", scoring.segment_of("r", "f", "m")).collect()}
    assert found == expected and len(found) == 125


def expected_scores(values, units, small_is_best, bins=5):
    """Counts for each value how many inner bin edges it exceeds; edges from numpy."""
    found = np.array(values, float) / units
    fractions = np.linspace(0, 1, bins + 1)
    edges = np.percentile(found, fractions * 100)
    if (np.diff(edges) == 0).any():  # two quantiles coincide: equally wide bins
        edges = found.min() + fractions * (found.max() - found.min())
    if found.min() == found.max():
        scores = np.full(len(found), (bins + 1) // 2)
    else:
        scores = 1 + (found[:, None] > edges[None, 1:-1]).sum(axis=1)
    return (bins + 1 - scores if small_is_best else scores).tolist()


def score_cases():
    rng = random.Random(11)
    cases = [list(range(1, 11)), [1, 1, 1, 1, 2, 3, 10], [7, 7, 7], [0, 0], [5], [1, 2],
             [1, 2, 3, 4, 5, 6], [-1, 0, 3, 400]]
    for _ in range(60):
        top = rng.choice([3, 10, 100, 100000])
        cases.append([rng.randrange(top) for _ in range(rng.randrange(1, 60))])
    return cases


def test_scores_equal_counted_edges(spark):
    """On columns with and without ties."""
    cases = score_cases()
    data = [(f"{c:03d}", str(i), v, v, v) for c, values in enumerate(cases)
            for i, v in enumerate(values)]
    df = spark.createDataFrame(
        data, "period string, customer_id string, recency int, frequency bigint, monetary_cents bigint")
    scored = scoring.score_rfm(df, scoring.rfm_thresholds(df))
    found = {(r.period, int(r.customer_id)): (r.r_score, r.f_score, r.m_score)
             for r in scored.collect()}
    for c, values in enumerate(cases):
        expected = list(zip(expected_scores(values, 1, True), expected_scores(values, 1, False),
                            expected_scores(values, 100, False)))
        assert [found[f"{c:03d}", i] for i in range(len(values))] == expected, values


def test_quantiles_equal_the_built_in(spark):
    rng = random.Random(5)
    data = [(f"g{i % 3}", 7 if i % 2 else rng.randrange(100000)) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, v bigint")
    found = ordering.order_statistics(df, ["g"], "v", ordering.quantile_ranks([(19, 20)]))
    ours = {r.g: r.q / 20 for r in found.select(
        "g", ordering.scaled_quantile(0, 19, 20).alias("q")).collect()}
    built_in = {r.g: r.q for r in df.groupBy("g").agg(
        F.percentile("v", F.lit(0.95)).alias("q")).collect()}
    assert ours == pytest.approx(built_in)


@pytest.mark.parametrize("inclusive", [False, True])
def test_backfill_equals_single_runs(spark, inclusive):
    sales = random_lines(spark)
    periods = ["2010-12", "2011-01", "2011-02", "2011-05", "2011-06", "2011-12"]
    columns = ["period", "customer_id", "recency", "frequency", "monetary_cents", "last_purchase"]
    many = {tuple(r) for r in rfm.backfill_rfm(sales, periods, inclusive).select(*columns).collect()}
    single = {tuple(r) for p in periods
              for r in rfm.period_rfm(sales, p, inclusive).select(*columns).collect()}
    assert many == single


def test_history_invariants_and_next_period(spark):
    sales = random_lines(spark, seed=8)
    periods = ["2011-01", "2011-03", "2011-04"]
    snapshots = scoring.as_snapshot(scoring.score_and_segment(rfm.backfill_rfm(sales, periods))).cache()
    rows = snapshots.collect()
    assert len({(r.period, r.customer_id) for r in rows}) == len(rows)
    assert all(r.snapshot_date == dt.date(2011, int(r.period[5:]), {1: 31, 3: 31, 4: 30}[
        int(r.period[5:])]) for r in rows)
    by = {p: {r.customer_id: r.segment for r in rows if r.period == p} for p in periods}
    pairs = history.migration_pair(snapshots, "2011-01", "2011-04")
    both = set(by["2011-01"]) & set(by["2011-04"])
    assert sum(r.customers for r in pairs.collect()) == len(both)
    grid = history.migration_matrix(pairs).collect()
    assert [r.from_seg for r in grid] == list(S.SEGMENTS)
    assert sum(sum(r[1:]) for r in grid) == len(both)
    expected = {}
    for p, q in zip(periods, periods[1:]):
        for c, s in by[p].items():
            if c in by[q] and by[q][c] != s:
                key = (p, q, s, by[q][c])
                expected[key] = expected.get(key, 0) + 1
    moves = {tuple(r)[:4]: r.customer_count for r in history.segment_migration(snapshots).collect()}
    assert moves == expected
    snapshots.unpersist()


def test_recommendations_equal_brute_force(spark):
    sales = random_lines(spark, seed=21)
    periods = ["2011-06", "2011-12"]
    segmented = scoring.score_and_segment(rfm.backfill_rfm(sales, periods))
    found = recommend.recommend(sales, segmented, periods, top_n=4).collect()
    data = [r.asDict() for r in sales.collect()]
    members = {(r.period, r.customer_id): r.segment for r in segmented.collect()}
    for period in periods:
        limit = dt.datetime(2011, int(period[5:]), {6: 30, 12: 31}[int(period[5:])])
        for segment in S.SEGMENTS:
            sold = [d for d in data if d["amount_cents"] > 0 and d["invoice_date"] <= limit
                    and members.get((period, d["customer_id"])) == segment]
            sums, metric = {}, S.SEGMENT_METRIC[segment]
            latest = max((d["invoice_date"] for d in sold), default=None)
            for d in sold:
                value = {"revenue": d["amount_cents"], "frequency": d["quantity"],
                         "recency_weighted": 1 / (1 + (latest - d["invoice_date"]).days)}[metric]
                sums[d["stock_code"]] = sums.get(d["stock_code"], 0) + value
            best = max(sums.values(), default=0)
            expected = sorted(((round(v / best * 100, 2), k) for k, v in sums.items()),
                              key=lambda x: (-x[0], x[1]))[:4]
            got = sorted((r for r in found if r.period == period and r.segment == segment),
                         key=lambda r: r["rank"])
            assert [r["rank"] for r in got] == list(range(1, len(expected) + 1))
            assert [r.stock_code for r in got] == [code for _, code in expected]
            assert [float(r.score) for r in got] == pytest.approx([v for v, _ in expected], abs=0.011)
            if got:
                assert float(got[0].score) == 100


def test_histogram_and_outliers_cover_everyone(spark):
    sales = random_lines(spark, seed=4)
    latest = scoring.as_latest(scoring.score_and_segment(rfm.period_rfm(sales, "2011-12")))
    sizes = {r.segment: r.n for r in segments.segment_distribution(latest).collect()}
    bins = segments.monetary_histogram(latest).groupBy("segment").agg(F.sum("customers").alias("n"))
    assert {r.segment: r.n for r in bins.collect()} == sizes


def test_numbering_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(f"{i * 7919 % 500:04d}",) for i in range(500)], "k string")
    rows = ordering.number_rows(df, "k", "nr", after=10).collect()
    assert [r.nr for r in sorted(rows, key=lambda r: r.k)] == list(range(11, 511))
