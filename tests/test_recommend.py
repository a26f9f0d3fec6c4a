"""Recency-weighted product sums over many periods against a sum over single sales."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from patronlens.functions import dates
from patronlens.operators import recommend

PERIODS = dates.period_range("2005-01", "2009-12")
SLEEPY, NEEDY = "About to Sleep", "Customers Needing Attention"


def world(seed=8, sales=700, customers=25):
    rng = random.Random(seed)
    begin = dt.datetime(2004, 12, 1)
    sold = [(str(rng.randrange(customers)), f"P{rng.randrange(6)}",
             begin + dt.timedelta(minutes=rng.randrange(60 * 24 * 1860)), 100, 1)
            for _ in range(sales)]
    sold += sold[:40]  # repeated lines count again
    members = []
    for c in range(customers):
        segment = rng.choice([SLEEPY, NEEDY, "Champions"])
        for p in PERIODS:
            if rng.random() < 0.06:
                segment = rng.choice([SLEEPY, NEEDY, "Champions"])
            if rng.random() < 0.95:
                until = dates.cutoff(p)
                bought = [t for who, _, t, *_ in sold if who == str(c) and t <= until]
                if bought:
                    members.append((str(c), p, segment, max(bought)))
    return sold, members


def frames(spark, sold, members):
    lines = spark.createDataFrame(sold, "customer_id string, stock_code string, invoice_date "
                                        "timestamp_ntz, amount_cents long, quantity long")
    return lines, spark.createDataFrame(
        members, "customer_id string, period string, segment string, last_purchase timestamp_ntz")


def test_weights_of_sixty_periods(spark):
    sold, members = world()
    lines, segmented = frames(spark, sold, members)
    runs = recommend._runs(segmented, PERIODS)
    found = {(r.period, r.segment, r.stock_code): r.weight for r in recommend._weighted_totals(
        lines, segmented, runs, PERIODS, False).collect()}
    want = defaultdict(float)
    for p in PERIODS:
        for segment in (SLEEPY, NEEDY):
            own = {c: last for c, period, s, last in members if (period, s) == (p, segment)}
            if own:
                latest = max(own.values())
                for who, code, at, *_ in sold:
                    if who in own and at <= dates.cutoff(p):
                        want[p, segment, code] += 1 / (1 + (latest - at).days)
    assert found == pytest.approx(dict(want)) and len({k[0] for k in found}) == 60


def test_joined_rows_do_not_grow_with_the_periods(spark):
    sold, _ = world(sales=300)
    first = [s for s in sold if s[2] <= dates.cutoff(PERIODS[11])]
    counts = []
    for periods in (PERIODS[:12], PERIODS):
        members = [(c, p, SLEEPY, first[0][2]) for c in map(str, range(25)) for p in periods]
        lines, segmented = frames(spark, first, members)
        rows = recommend.weighted_intervals(lines, recommend._runs(segmented, periods), periods,
                                            [dt.timedelta(0)], False)
        counts.append(rows.count())
    assert counts[0] == counts[1] <= len(first)


def test_no_weighted_member(spark):
    sold, members = world(sales=50)
    lines, segmented = frames(spark, sold, [(c, p, "Champions", t) for c, p, _, t in members])
    ranked = recommend.recommend(lines, segmented, PERIODS[:3])
    assert {r.segment for r in ranked.collect()} <= {"Champions"}
