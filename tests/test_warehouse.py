"""Merges, period runs, reruns and the run log."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from patronlens import schemas as S, staging
from patronlens.operators import facts, quality
from patronlens.plans import business, history, periods
from patronlens.sources import files, warehouse
from patronlens.sources.warehouse import Warehouse, merge

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    rng, rows = random.Random(1), []
    for i in range(400):
        customer = 100 if i % 3 == 0 else 101 + rng.randrange(40)
        day = dt.date(2010, 12, 1) + dt.timedelta(days=rng.randrange(150))
        if i % 20 == 0:
            day = dt.date(2011, 1, 31)
        code = f"P{rng.randrange(12)}"
        rows.append(f"{'C' if i % 29 == 0 else ''}{i // 2},{code},item {code} ,{rng.randrange(1, 9)},"
                    f"{day.month}/{day.day}/{day.year} {rng.randrange(24)}:15,"
                    f"{rng.randrange(1, 900) / 100},{'' if i % 31 == 0 else customer},"
                    f"{rng.choice(['UK', 'France', ''])}\n")
    path = tmp_path_factory.mktemp("source") / "data.csv"
    path.write_text(HEADER + "".join(rows))
    return str(path)


def content(store, table, drop=("created_at", "updated_at", "calculated_at")):
    df = store.read(table).drop(*drop)
    return sorted(df.select(*sorted(df.columns)).collect(), key=repr)


def test_merge_updates_listed_columns_only(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, u string, v string")
    source = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z")], "k int, u string, v string")
    assert {tuple(r) for r in merge(target, source, ["k"], ["u"]).collect()} == {
        (1, "a", "x"), (2, "B", "y"), (3, "C", "Z")}
    assert {tuple(r) for r in merge(target, source, ["k"]).collect()} == {
        (1, "a", "x"), (2, "b", "y"), (3, "C", "Z")}
    stamped = merge(target, source.drop("v"), ["k"], ["u", "v"], {"v": F.lit("now")})
    assert {tuple(r) for r in stamped.collect()} == {(1, "a", "x"), (2, "B", "now"), (3, "C", "now")}


def test_upsert_counts_and_empty_input(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    empty = spark.createDataFrame([], "stock_code string, description string")
    assert store.upsert_keyed("dim_product", "product_key", empty) == 0
    first = spark.createDataFrame([("B", "b"), ("A", "a")], empty.schema)
    assert store.upsert_keyed("dim_product", "product_key", first) == 2
    second = spark.createDataFrame([("B", "b2"), ("0", "zero")], empty.schema)
    assert store.upsert_keyed("dim_product", "product_key", second, ("description",)) == 2
    assert {(r.product_key, r.stock_code, r.description) for r in store.read("dim_product").collect()} == {
        (1, "A", "a"), (2, "B", "b2"), (3, "0", "zero")}


def test_period_run_is_repeatable_and_matches_backfill(spark, tmp_path, source):
    months = ["2011-01", "2011-02"]
    store = Warehouse(spark, str(tmp_path / "a"))
    for month in months:
        result = periods.run_period(spark, source, store.root, 2011, int(month[5:]))
        assert result["status"] == "success" and result["rows_loaded"] > 0
    tables = [t for t in S.TABLES if t not in ("pipeline_log", "dim_customer", "fact_sales")]
    before = {t: content(store, t) for t in (*tables, "dim_customer", "fact_sales")}
    periods.run_period(spark, source, store.root, 2011, 2)
    assert {t: content(store, t) for t in before} == before

    # rerunning an older month leaves the latest scores alone
    periods.run_period(spark, source, store.root, 2011, 1)
    assert content(store, "customer_rfm") == before["customer_rfm"]

    other = Warehouse(spark, str(tmp_path / "b"))
    periods.run_backfill(spark, source, other.root, months)
    for table in ("rfm_snapshot", "customer_rfm", "product_recommendation"):
        assert content(other, table) == before[table], table
    assert other.read("fact_sales").count() == len(before["fact_sales"])

    for table, key in S.KEYS.items():
        assert quality.duplicate_keys(store.read(table), key).count() == 0, table
    sold = store.read("fact_sales")
    for table, key in (("dim_customer", "customer_key"), ("dim_product", "product_key"),
                       ("dim_date", "date_key"), ("dim_geography", "geo_key")):
        assert quality.orphans(sold, store.read(table), key).count() == 0, table

    # sales of the last January day after midnight belong to the February load
    late = sold.filter(F.col("invoice_date").between("2011-01-31 00:00:01", "2011-01-31 23:59:59"))
    assert {r.period for r in late.select("period").distinct().collect()} == {"2011-02"}

    store.register_views()
    top = warehouse.read_sql(spark, """
        SELECT stock_code, SUM(total_amount) AS revenue FROM fact_sales f
        JOIN dim_product p ON f.product_key = p.product_key WHERE f.date_key >= :start
        GROUP BY stock_code ORDER BY revenue DESC, stock_code LIMIT 3""", {"start": 20101201})
    report = business.top_products(
        facts.fact_lines(sold, store.read("dim_customer"), store.read("dim_product")),
        store.read("dim_product"), limit=3)
    assert [tuple(r) for r in top.collect()] == [(r.stock_code, r.revenue) for r in report.collect()]

    log = history.run_log(store.read("pipeline_log")).collect()
    assert len(log) == 4 and all(r.status == "success" and r.duration.total_seconds() > 0 for r in log)
    assert [r.started_at for r in log] == sorted((r.started_at for r in log), reverse=True)

    january = sold.filter(F.col("date_key").between(20110101, 20110131)).count()
    total = sold.count()
    store.delete_sales_of_month(2011, 1)
    assert store.read("fact_sales").count() == total - january > 0

    out = str(tmp_path / "export")
    chosen = history.reco_period(store.read("product_recommendation"), "2011-02").drop("label")
    files.export_csv(chosen, out)
    assert spark.read.csv(out, header=True).count() == chosen.count() > 0


def test_failed_run_is_logged_and_raised(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("InvoiceNo,StockCode\n1,A\n")
    store = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(ValueError, match="missing required columns"):
        periods.run_period(spark, str(bad), store.root, 2011, 1)
    row = store.read("pipeline_log").collect()[0]
    assert row.status == "failed" and "missing" in row.error_msg and row.rows_loaded == 0


def test_replaced_period_without_rows_is_emptied(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    rows = [("s", "A", "a", 1.0, 1, "2011-01"), ("s", "B", "b", 1.0, 1, "2011-02")]
    df = spark.createDataFrame(rows, "segment string, stock_code string, description string, "
                                     "score double, rank int, period string")
    store.replace_periods("product_recommendation", df, ["2011-01", "2011-02"])
    store.replace_periods("product_recommendation", df.filter("period = '2011-02'"), ["2011-01"])
    assert store.periods("product_recommendation") == ["2011-02"]
    assert [r.stock_code for r in store.read("product_recommendation").collect()] == ["B"]


def test_statements_with_parameters(spark):
    warehouse.execute_sql(spark, "CREATE TABLE notes (id INT, said STRING) USING parquet")
    try:
        warehouse.execute_sql(spark, "INSERT INTO notes VALUES (:id, :said), (2, 'b')",
                              {"id": 1, "said": "a"})
        found = warehouse.read_sql(spark, "SELECT said FROM notes WHERE id = :id", {"id": 1})
        assert [r.said for r in found.collect()] == ["a"]
        assert spark.table("notes").count() == 2  # the statement ran once
    finally:
        warehouse.execute_sql(spark, "DROP TABLE notes")


def staged_files(spark):
    folder = pathlib.Path(staging.shared_dir(spark)) / "patronlens"
    return {p for p in folder.rglob("*.parquet")} if folder.exists() else set()


def test_a_run_leaves_no_staged_tables(spark, tmp_path, source):
    before = staged_files(spark)
    periods.run_period(spark, source, str(tmp_path / "w"), 2011, 1)
    assert staged_files(spark) <= before


def test_failed_replace_keeps_the_old_table(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    old = spark.createDataFrame([(1, "UK")], S.TABLES["dim_geography"])
    store.replace("dim_geography", old)
    with pytest.raises(Exception):
        store.replace("dim_geography", old.withColumn(
            "country", F.raise_error(F.lit("broken")).cast("string")))
    assert [tuple(r) for r in store.read("dim_geography").collect()] == [(1, "UK")]
    store.replace("dim_geography", old.withColumn("country", F.lit("FR")))
    assert [r.country for r in store.read("dim_geography").collect()] == ["FR"]


def test_shared_tables_follow_their_sources(spark, tmp_path):
    folder = str(tmp_path / "in")

    def shared():
        key = staging.source_version(spark, folder)
        return staging.stage_once(spark, key, "n", lambda: spark.read.parquet(f"{folder}/t")).count()

    spark.range(3).write.parquet(f"{folder}/t")
    assert shared() == shared() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{folder}/t")
    assert shared() == 5
