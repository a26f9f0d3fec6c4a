"""Source files, cleaning and dates on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from patronlens.functions import dates, numbers, text
from patronlens.operators import clean, dims
from patronlens.sources import files

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
COLUMNS = ("InvoiceNo string, StockCode string, Description string, Quantity string, "
           "InvoiceDate string, UnitPrice string, CustomerID string, Country string")


def raw(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def line(invoice="1", code="A", description="X", quantity="1", date="12/1/2010 8:26",
         price="1.0", customer="7", country="UK"):
    return (invoice, code, description, quantity, date, price, customer, country)


def write(path, text_or_bytes):
    data = text_or_bytes if isinstance(text_or_bytes, bytes) else text_or_bytes.encode()
    path.write_bytes(data)
    return str(path)


def test_csv_is_read_as_text_and_validated(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER
                 + "700001,LAMP-3,DESK LAMP,2,3/9/2012 14:05,19.90,C-12,Norway\n")
    df = files.extract_data(spark, path)
    files.validate_schema(df)
    assert df.count() == 1
    assert {kind for _, kind in df.dtypes} == {"string"}


def test_csv_quotes_missing_markers_and_latin1(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", HEADER + '1,A,"said ""so"", twice",1,12/1/2010 8:26,2,7,Öland\n')
    write(folder / "b.csv", (HEADER + "2,B,café,1,12/1/2010 8:26,2,NaN,UK\n").encode("latin-1"))
    df = files.extract_data(spark, f"{folder}/*.csv")
    found = {r.InvoiceNo: r for r in df.collect()}
    assert found["1"].Description == 'said "so", twice'
    assert found["1"].Country == "Öland"
    assert found["2"].Description == "café"
    assert found["2"].CustomerID is None


def test_unknown_extension_and_missing_columns_are_rejected(spark):
    with pytest.raises(ValueError):
        files.extract_data(spark, "/tmp/x.json")
    with pytest.raises(ValueError, match="CustomerID"):
        files.validate_schema(spark.createDataFrame([("1",)], "InvoiceNo string"))


def test_csv_columns_by_name_and_rejects(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder / "a.csv", HEADER + "1,A,x,1,12/1/2010 8:26,2,7,UK\n1,A,short\n")
    write(folder / "b.csv", "CustomerID,InvoiceNo,StockCode,Quantity,InvoiceDate,UnitPrice\n"
          + "8,2,B,3,12/2/2010 8:26,4\n8,2,B,3,12/2/2010 8:26,4,too,long\n\n")
    write(folder / "c.csv", ("Country," + HEADER.replace(",Country", "")
                             + "Perú,3,C,y,5,12/3/2010 8:26,6,9\n").encode("latin-1"))
    path = f"{folder}/*.csv"
    found = {r.InvoiceNo: r for r in files.extract_data(spark, path).collect()}
    assert set(found) == {"1", "2", "3"}
    assert (found["2"].CustomerID, found["2"].Quantity, found["2"].UnitPrice) == ("8", "3", "4")
    assert found["2"].Country is None and found["3"].Country == "Perú"
    rejects = files.rejected_lines(spark, path).collect()
    assert sorted(r.line for r in rejects) == ["1,A,short", "8,2,B,3,12/2/2010 8:26,4,too,long"]
    assert {r.file.rsplit("/", 1)[1] for r in rejects} == {"a.csv", "b.csv"}


def test_cleaning_keeps_only_sound_lines(spark):
    df = clean.clean_sales(raw(spark, [
        line("80", "A", "kettle", "4", "5/7/2013 17:40", "12.25", "31"),
        line("C81", "B", "mug", "5", "5/7/2013 17:41", "8.0", "32"),
        line("82", "C", "plate", "-3", "5/8/2013 9:12", "6.5", "33"),
        line("83", "D", "bowl", "2", "5/8/2013 9:13", "0.0", "34"),
        line("84", "E", "bowl", "x", "5/8/2013 9:13", "7.0", "34"),
        line("85", "F", "bowl", "1", "5/8/2013 9:13", "7.0", None),
        line("c86", "G", " \t pot\n", "1", "2013-05-08 09:14:00", "7.0", "35.0"),
        line(None, "H", None, "1", "5/8/2013 9:15", "7.0", "36"),
    ]))
    rows = {r.StockCode: r for r in df.collect()}
    assert set(rows) == {"A", "G", "H"}
    assert float(rows["A"].total_amount) == 49.00
    assert rows["A"].InvoiceDate == dt.datetime(2013, 5, 7, 17, 40)
    assert rows["G"].CustomerID == "35" and rows["G"].Description == "POT"
    assert rows["H"].InvoiceNo == "nan" and rows["H"].Description == "NAN"
    products = dims.dim_product(clean.transactions(df))
    assert products.count() == products.select("stock_code").distinct().count()


def test_clean_stats_counts_what_clean_sales_drops(spark):
    df = raw(spark, [line(), line(invoice="C1"), line(customer=None)])
    stats = clean.clean_stats(df).collect()[0]
    assert tuple(stats) == (3, 1, 2, 66.7)
    assert clean.clean_sales(df).count() == stats.rows_after


def test_bad_dates_raise_or_become_null(spark):
    df = raw(spark, [line(date="soon"), line()])
    with pytest.raises(Exception, match="unreadable date"):
        clean.clean_sales(df).collect()
    assert clean.clean_sales(df, on_bad="null").filter("InvoiceDate IS NULL").count() == 1


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_date_forms(spark, zone):
    forms = {"12/1/2010 8:26": dt.datetime(2010, 12, 1, 8, 26),
             "2010-12-01 08:26:00": dt.datetime(2010, 12, 1, 8, 26),
             "2010-12-01": dt.datetime(2010, 12, 1), "1/2/2011": dt.datetime(2011, 1, 2),
             "13/2/2011 7:05:09": dt.datetime(2011, 2, 13, 7, 5, 9),
             "3/13/2011 2:30": dt.datetime(2011, 3, 13, 2, 30), "soon": None, "1/2": None}
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(f,) for f in forms], "t string")
        found = {r.t: r.p for r in df.select("t", dates.parse_timestamp(F.col("t")).alias("p")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == forms


def test_month_cutoff_is_month_end_midnight(spark):
    df = raw(spark, [line("1", date="8/9/2012 17:45"), line("2", date="9/29/2012 6:20"),
                     line("3", date="9/30/2012 0:00"), line("4", date="9/30/2012 0:01"),
                     line("5", date="10/2/2012 23:59"), line("6", date="11/30/2012 13:30")])

    def kept(**options):
        return {r.InvoiceNo for r in clean.filter_by_month(df, 2012, 9, **options).collect()}

    assert kept() == {"1", "2", "3"}
    assert kept(inclusive_end=True) == {"1", "2", "3", "4"}
    periods = {r.InvoiceNo: r.p for r in clean.filter_by_month(df, 2012, 12).select(
        "InvoiceNo", dates.entry_period(F.col("InvoiceDate")).alias("p")).collect()}
    assert periods == {"1": "2012-08", "2": "2012-09", "3": "2012-09", "4": "2012-10",
                       "5": "2012-10", "6": "2012-12"}


def test_amount_rounding_follows_the_binary_product(spark):
    values = {1.015: 101, 0.125: 12, 2.675: 268, 0.285: 28}
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = {r.v: r.c for r in df.select(
        "v", numbers.line_cents(F.lit(1.0), F.col("v")).alias("c")).collect()}
    assert found == values


def test_text_helpers(spark):
    df = spark.createDataFrame([(1234567.0,), (4321.0,), (12.0,)], "v double")
    assert [r[0] for r in df.select(text.compact_money(F.col("v"))).collect()] == [
        "£1.2M", "£4.3K", "£12"]


def test_dimensions(spark):
    lines = clean.transactions(clean.clean_sales(raw(spark, [
        line("1", "A", "old", date="1/1/2011 9:00", country="UK"),
        line("1", "B", "b", date="1/1/2011 9:00", country="FR"),
        line("2", "A", "new", date="1/3/2011 9:00", customer="8", country=None)])))
    customers = {r.customer_id: r for r in dims.dim_customer(lines).collect()}
    assert customers["7"].country == "FR" and customers["7"].total_orders == 1
    assert customers["8"].country == "Unknown"
    assert {tuple(r) for r in dims.dim_product(lines).collect()} == {("A", "OLD"), ("B", "B")}
    days = dims.dim_date(lines).orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20110101, 20110102, 20110103]
    assert (days[0].week, days[0].day_name, days[0].day_of_week, days[0].is_weekend) == (
        52, "Saturday", 5, True)
    assert dims.dim_geography(lines).count() == 2
    assert dims.dim_geography(lines.drop("country")).count() == 0
    assert {r.country for r in dims.dim_customer(lines.drop("country")).collect()} == {"Unknown"}
