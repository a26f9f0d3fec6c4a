"""Months loaded one by one against all months at once, and what a month costs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from patronlens import schemas as S
from patronlens.functions import dates
from patronlens.operators import dims, rfm, states
from patronlens.plans import periods
from patronlens.sources.warehouse import Warehouse, read_sql

MONTHS = dates.period_range("2010-12", "2011-06")
SCHEMA = ("invoice_no string, customer_id string, stock_code string, description string, country string, "
          "quantity double, unit_price double, invoice_date timestamp_ntz, amount_cents long, "
          "total_amount decimal(14,2)")


def sales(spark, n=6000, seed=4, customers=40, first=dt.datetime(2010, 11, 20), days=220):
    """Invoice numbers grow with time; some invoices, customers and products span months."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        at = first + dt.timedelta(minutes=int(days * 1440 * i / n) + rng.randrange(3000))
        code = f"P{rng.randrange(15)}" if rng.random() < 0.95 else None
        cents = rng.choice([0, 120, 999, 4550]) if i % 7 else 0
        rows.append((f"{100000 + i // 3}", str(rng.randrange(customers)), code,
                     rng.choice(["A THING", f"{code} OLD", f"{code} NEW"]),
                     rng.choice(["UK", "UK", "FRANCE", "SPAIN", None]), 1.0, cents / 100, at, cents,
                     None))
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("total_amount", (F.col("amount_cents") / 100).cast("decimal(14,2)")).withColumn(
        "period", dates.entry_period(F.col("invoice_date"))).filter(F.col("period").between(
            MONTHS[0], MONTHS[-1]))


def rows_of(df, *drop):
    df = df.drop("created_at", "updated_at", *drop)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def rows_read(spark, run):
    """Rows that all stages of `run` read from files."""
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway

    def stages():
        none = gateway.new_array(spark.sparkContext._jvm.double, 0)
        found = store.stageList(None, False, False, none, None)
        return {found.apply(i).stageId(): found.apply(i).inputRecords() for i in range(found.size())}

    before = set(stages())
    run()
    return sum(n for s, n in stages().items() if s not in before)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """The same sales loaded a month at a time, and rows read per month."""
    store = Warehouse(spark, str(tmp_path_factory.mktemp("monthly")))
    lines, read = sales(spark).cache(), []
    for month in MONTHS:
        own = lines.filter(F.col("period") == month)
        read.append(rows_read(spark, lambda: periods.load_lines(store, own, [month], month)))
    return store, lines, read


def test_dimensions_equal_those_of_all_lines(spark, loaded):
    store, lines, _ = loaded
    assert rows_of(store.read("dim_customer"), "customer_key") == rows_of(dims.dim_customer(lines))
    assert rows_of(store.read("dim_product"), "product_key") == rows_of(dims.dim_product(lines))
    assert rows_of(store.read("dim_date")) == rows_of(dims.dim_date(lines))
    known = rows_of(dims.dim_geography(lines))
    assert rows_of(store.read("dim_geography").filter("geo_key > 0"), "geo_key") == known


def test_state_after_each_month_equals_a_full_backfill(spark, loaded):
    store, lines, _ = loaded
    sold = lines.filter(F.col("stock_code").isNotNull())
    want = rows_of(rfm.backfill_rfm(sold, MONTHS))
    got = []
    for month in MONTHS:
        state = store.read("state_customer").filter(F.col("period") == month)
        got += rows_of(states.rfm_of(state, month))
    assert sorted(got, key=repr) == want


def test_a_month_costs_a_month(loaded):
    """Rows read by the last months' loads are those of the early ones."""
    *_, read = loaded
    assert max(read[-2:]) <= 1.3 * max(read[1:3]), read


def test_a_month_loaded_again_changes_nothing(spark, loaded):
    store, lines, _ = loaded
    tables = ("dim_customer", "dim_product", "dim_date", "dim_geography", "state_customer",
              "state_country", "state_product", "fact_sales")
    before = {t: rows_of(store.read(t)) for t in tables}
    periods.load_lines(store, lines.filter(F.col("period") == MONTHS[-1]), [MONTHS[-1]], MONTHS[-1])
    assert {t: rows_of(store.read(t)) for t in tables} == before
    # an older month: later states are out of date and are made again by the next load
    periods.load_lines(store, lines.filter(F.col("period") == MONTHS[2]), [MONTHS[2]], MONTHS[2])
    assert store.periods("state_customer") == MONTHS[:3]
    periods.load_lines(store, lines.filter(F.col("period") == MONTHS[-1]), [MONTHS[-1]], MONTHS[-1])
    after = {t: rows_of(store.read(t)) for t in tables}
    for table in ("dim_customer", "dim_product", "fact_sales"):
        assert after[table] == before[table]
    last = [r for r in before["state_customer"] if MONTHS[-1] in r]
    assert [r for r in after["state_customer"] if MONTHS[-1] in r] == last


def test_stored_views(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    day = dt.date(2011, 1, 31)
    rows = [(day, c, 5, 2, 10.0, 5, 5, 5, "555", s, p) for c, s, p in (
        ("1", "Champions", "2011-01"), ("1", "At Risk", "2011-03"), ("2", "Promising", "2011-01"),
        ("2", "Promising", "2011-02"), ("3", "Champions", "2011-01"))]
    names = [f.name for f in S.TABLES["rfm_snapshot"]]
    store.replace_periods("rfm_snapshot", spark.createDataFrame(rows, names),
                          ["2011-01", "2011-02", "2011-03"])
    store.register_views()
    moved = read_sql(spark, "SELECT * FROM vw_segment_migration WHERE period_from = :p", {"p": "2011-01"})
    assert [tuple(r) for r in moved.collect()] == [("2011-01", "2011-03", "Champions", "At Risk", 1)]
    size = read_sql(spark, "SELECT customer_count, total_revenue FROM vw_segment_monthly "
                           "WHERE period = :p AND segment = :s", {"p": "2011-01", "s": "Champions"})
    assert [(r[0], float(r[1])) for r in size.collect()] == [(2, 20.0)]
    plan = read_sql(spark, "SELECT * FROM vw_segment_monthly WHERE period = '2011-02'")
    assert "PartitionFilters: [isnotnull(period" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_customers_history_skips_row_groups(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    day = dt.date(2011, 1, 31)
    many = spark.range(0, 60_000).select(
        F.lit(day).alias("snapshot_date"), F.col("id").cast("string").alias("customer_id"),
        *[F.lit(1).alias(n) for n in ("recency", "frequency", "monetary", "r_score", "f_score", "m_score")],
        F.lit("111").alias("rfm_score"), F.lit("Hibernating").alias("segment"))
    months = ["2011-01", "2011-02"]
    rows = many.withColumn("period", F.explode(F.array(*map(F.lit, months))))
    store.replace_periods("rfm_snapshot", rows, months)
    one = store.read("rfm_snapshot").filter(F.col("customer_id") == "31234")
    read = rows_read(spark, lambda: one.select("period", "segment").collect())
    assert one.count() == 2 and 0 < read <= 60_000  # of 120,000


HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def test_unreadable_lines_are_counted_whatever_is_used(spark, tmp_path):
    from patronlens.operators import clean
    from patronlens.sources import files

    source = tmp_path / "in.csv"
    source.write_text(HEADER + "1,A,a,1,1/5/2011 8:00,2.0,7,UK\n2,A,a,1,someday,2.0,7,UK\n"
                      "3,A,a,1,1/6/2011 8:00,2.0,who,UK\n4,,a,1,1/7/2011 8:00,2.0,8,UK\n"
                      "C5,A,a,1,1/7/2011 8:00,2.0,8,UK\n")
    raw = files.extract_data(spark, str(source))
    with pytest.raises(Exception, match="unreadable date: someday"):
        clean.clean_sales(raw.filter("InvoiceNo = '2'")).select("Quantity").collect()
    with pytest.raises(Exception, match="unreadable customer id: who"):
        clean.clean_sales(raw.filter("InvoiceNo = '3'")).select("Quantity").count()

    store = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(ValueError, match="1 lines with an unreadable date, 1 with an unreadable customer"):
        periods.run_period(spark, str(source), store.root, 2011, 1)
    assert store.periods("fact_sales") == []
    found = periods.run_period(spark, str(source), store.root, 2011, 1, on_bad="quarantine")
    assert found["rows_loaded"] == 1
    kept = {(r.reason.split(":")[0], r.line.split('"')[3]) for r in store.read("quarantine").collect()}
    assert kept == {("unreadable date", "2"), ("unreadable customer id", "3"), ("no product", "4")}
    assert {r.customer_id for r in store.read("dim_customer").collect()} == {"7", "8"}
