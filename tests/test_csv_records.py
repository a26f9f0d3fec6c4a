"""Quoted line breaks, wherever blocks of a file begin, against the pandas reader."""

import io
import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronlens.operators import clean
from patronlens.sources import files


def read(spark, path):
    df = files.extract_csv(spark, str(path))
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def by_pandas(text):
    df = pd.read_csv(io.StringIO(text), dtype=str, keep_default_na=False)
    return sorted(tuple(r) for r in df[sorted(df.columns)].itertuples(index=False))


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def sample(rows, seed=1):
    rng = random.Random(seed)
    out = ["Id,Name,Country"]
    for i in range(rows):
        name = rng.choice(["plain", "two\nlines", "a, b", 'say "x"', "three\n\nlines\n", 'end"\nquote',
                           '",\n"', "x" * 50])
        country = rng.choice(["UK", "New\nLand", 'Q"\n'])
        out.append(",".join([f"{i}", quoted(name) if name != "plain" else name,
                             quoted(country) if country != "UK" else country]))
    return "\n".join(out) + "\n"


@pytest.mark.parametrize("block", ["64m", "700", "97"])
def test_breaks_across_borders_of_blocks(spark, tmp_path, block):
    text = sample(60)
    (tmp_path / "a.csv").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert read(spark, tmp_path / "a.csv") == by_pandas(text)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_literal_quotes_and_rejects(spark, tmp_path):
    text = ('A,B\n1,6" plate\n2,ok\n3,"a\nb"\n4,x"y"\n5,"never\nclosed\n')
    (tmp_path / "a.csv").write_text(text)
    assert read(spark, tmp_path / "a.csv") == [("1", '6" plate'), ("2", "ok"), ("3", "a\nb"), ("4", 'x"y"')]
    assert [r.line for r in files.rejected_lines(spark, str(tmp_path / "a.csv")).collect()] == [
        '5,"never\nclosed']


def test_stray_quotes_do_not_swallow_a_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "RECORD_LINES", 5)
    body = "".join(f"{i},r{i}\n" for i in range(30))
    (tmp_path / "a.csv").write_text('A,B\n0,"stray\n' + body + '31,"x"\n32,"y\nz"\n')
    assert ("32", "y\nz") in read(spark, tmp_path / "a.csv")
    assert files.rejected_lines(spark, str(tmp_path / "a.csv")).count() == 32


def test_many_headers_in_one_pass(spark, tmp_path):
    names = ["A", "B", "C", "D", "E"]
    want = []
    for i in range(24):
        own = names[i % 5:] + names[:i % 5] + ([f"X{i}"] if i % 2 else [])
        (tmp_path / f"f{i}.csv").write_text(",".join(own) + "\n" + ",".join(f"{n}{i}" for n in own) + "\n")
        want.append(tuple(f"{n}{i}" for n in names))
    df = files.extract_csv(spark, str(tmp_path / "*.csv"))
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(want)
    scans = df._jdf.queryExecution().optimizedPlan().toString().count("Relation [value")
    assert scans == 1  # beside the one that found the headers


def test_too_many_headers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "HEADERS", 3)
    for i in range(5):
        (tmp_path / f"f{i}.csv").write_text(f"{i},a\n{i},b\n")
    with pytest.raises(ValueError, match="different headers"):
        files.extract_csv(spark, str(tmp_path / "*.csv"))


def test_records_are_parsed_once(spark, tmp_path):
    """Whatever reads the fields, each record is parsed by one expression."""
    (tmp_path / "a.csv").write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '1,A,"two\nlines",1,12/1/2010 8:26,2,7,UK\n')
    found = clean.transactions(clean.clean_sales(files.extract_csv(spark, str(tmp_path / "a.csv"))))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv") == 1
    assert [(r.description, r.amount_cents) for r in found.collect()] == [("TWO\nLINES", 200)]


def test_lines_with_one_quote_do_what_the_patterns_say(spark):
    lines = ["".join(x) for n in range(7) for x in itertools.product('a,"', repeat=n)]
    text = F.col("line")
    outside = text.rlike(files._OPENS).cast("int")
    inside = F.when(~text.rlike(files._CLOSES), 1).otherwise(
        F.regexp_replace(text, files._REST, "").rlike(files._OPENS).cast("int"))
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select(
        "line", *files._effect("line"), outside.alias("outside"), inside.alias("inside")).collect()
    assert len(rows) == len(lines)
    for r in rows:
        assert r.set_to == (r.outside if r.outside == r.inside else None), r.line
        assert r.turns == (r.outside > r.inside), r.line


def test_many_short_records_beside_a_long_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "RECORD_LINES", 6)
    body = "".join(f'{i},"x\ny{i}"\n' for i in range(700))
    (tmp_path / "a.csv").write_text("A,B\n" + body + '700,"' + "\n" * 7 + 'z"\n' + body)
    found = read(spark, tmp_path / "a.csv")
    assert found == sorted([(f"{i}", f"x\ny{i}") for i in range(700)] * 2)
    assert files.rejected_lines(spark, str(tmp_path / "a.csv")).count() == 2  # the blank ones go
