"""Table versions: readers, crashes, conflicts and how much a merge rewrites."""

import pathlib

import pytest
from pyspark.sql import functions as F

from patronlens import schemas as S
from patronlens.sources.versions import Versions
from patronlens.sources.warehouse import Warehouse

GEO = "dim_geography"


def countries(spark, pairs):
    return spark.createDataFrame(pairs, S.TABLES[GEO])


def content(store, table=GEO):
    return sorted(tuple(r) for r in store.read(table).collect())


def files_of(store, table):
    return {str(p) for p in pathlib.Path(store.path(table)).rglob("*.parquet")}


def reco(spark, rows):
    return spark.createDataFrame(rows, "segment string, stock_code string, description string, "
                                       "score double, rank int, period string")


def test_a_reader_stays_with_its_version(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    store.replace(GEO, countries(spark, [(1, "UK")]))
    reader = store.read(GEO)
    store.replace(GEO, countries(spark, [(2, "FR")]))
    assert [tuple(r) for r in reader.collect()] == [(1, "UK")]  # its files are still there
    assert content(store) == [(2, "FR")]
    store.replace(GEO, countries(spark, [(3, "DE")]))
    assert content(store) == [(3, "DE")]
    manifests = {p.name for p in (tmp_path / GEO / "versions").iterdir() if p.suffix == ".json"}
    assert manifests == {"v000000000002.json", "v000000000003.json"}
    held = spark.read.parquet(*{str(pathlib.Path(f).parent) for f in files_of(store, GEO)})
    assert {r.country for r in held.collect()} == {"FR", "DE"}  # the oldest one is gone


@pytest.mark.parametrize("step", ["write", "publish", "_rename"])
@pytest.mark.parametrize("change", ["replace", "merge", "periods"])
def test_a_crash_leaves_the_old_table(spark, tmp_path, monkeypatch, step, change):
    store = Warehouse(spark, str(tmp_path))
    table = "product_recommendation" if change == "periods" else GEO

    def apply(name):
        if change == "replace":
            store.replace(GEO, countries(spark, [(1, name)]))
        elif change == "merge":
            store.upsert(GEO, countries(spark, [(1, "UK"), (len(name), name)]), ("geo_key",))
        else:
            store.replace_periods(table, reco(spark, [("s", name, name, 1.0, 1, "2011-01")]), ["2011-01"])

    apply("UK")
    before = content(store, table)
    real = getattr(Versions, step)

    def broken(self, *args, **kwargs):
        if step == "write":  # the files are complete, but nobody hears of them
            real(self, *args, **kwargs)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Versions, step, broken)
        with pytest.raises(OSError):
            apply("Chile")
    assert content(store, table) == before
    apply("Chile")
    assert any("Chile" in row for row in content(store, table))


def test_a_crash_after_publishing_keeps_the_new_table(spark, tmp_path, monkeypatch):
    store = Warehouse(spark, str(tmp_path))
    store.replace(GEO, countries(spark, [(1, "UK")]))

    def broken(self, kept):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Versions, "_forget_before", broken)
        with pytest.raises(OSError):
            store.replace(GEO, countries(spark, [(2, "FR")]))
    assert content(store) == [(2, "FR")]


def test_two_writers_of_one_version_cannot_both_publish(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    store.replace(GEO, countries(spark, [(1, "UK")]))
    versions = store._versions(GEO)
    before = versions.current()
    store.replace(GEO, countries(spark, [(2, "FR")]))
    with pytest.raises(Exception, match="(?i)exist"):
        versions.publish(before, before["parts"])
    assert content(store) == [(2, "FR")]


def test_a_small_merge_leaves_most_files(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), bucket_rows=50)
    all_keys = spark.range(1000).select(F.col("id").alias("geo_key"),
                                        F.concat(F.lit("c"), "id").alias("country"))
    store.upsert(GEO, all_keys)
    store.upsert(GEO, all_keys.limit(1), ("geo_key",))  # outgrown: buckets are doubled
    assert store._versions(GEO).current()["buckets"] >= 16
    before = files_of(store, GEO)
    current = store._versions(GEO).current()
    store.upsert(GEO, countries(spark, [(5000, "c7"), (5001, "new")]), ("geo_key",))
    after = store._versions(GEO).current()
    changed = [p for p in after["parts"] if after["parts"][p] != current["parts"].get(p)]
    assert len(changed) <= 2 and len(before & files_of(store, GEO)) >= len(after["parts"]) - 2
    found = dict((c, k) for k, c in content(store))
    assert len(found) == 1001 and found["c7"] == 5000 and found["new"] == 5001 and found["c8"] == 8


def test_period_filters_skip_folders(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    months = [f"2011-{m:02d}" for m in range(1, 7)]
    store.replace_periods("product_recommendation",
                          reco(spark, [("s", m, m, 1.0, 1, m) for m in months]), months)
    one = store.read("product_recommendation").filter("period = '2011-03'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
    assert [r.stock_code for r in one.collect()] == ["2011-03"]
