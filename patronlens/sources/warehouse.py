"""Warehouse tables as Parquet under one root folder.

Facts, history and recommendations have a part for each period and are replaced a period at a
time, so a rerun of a period gives the same tables. Other tables are merged by key, in buckets.
Every change of a table is published in one step, see `versions`."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from patronlens import schemas as S
from patronlens.operators import ordering
from patronlens.sources import views
from patronlens.sources.versions import Versions
from patronlens.staging import stage

BUCKETS = 8  # of a new table; doubled as it grows
_BUCKET = "_bucket"


def read_sql(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """A query with named parameters (:name) over registered views."""
    return spark.sql(query, args=params or {})


def execute_sql(spark: SparkSession, statement: str, params: dict | None = None) -> None:
    """A statement whose result is not wanted."""
    spark.sql(statement, args=params or {}).write.format("noop").mode("overwrite").save()


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
          update: Sequence[str] = (), defaults: dict[str, Column] | None = None) -> DataFrame:
    """`target` after inserting `source`: new keys are added, known keys take the `update`
    columns of the source and keep the others (all of them when `update` is empty).
    Columns the source lacks are filled from `defaults` in new rows, and in known rows
    when they are listed in `update`. Keys must be unique on both sides."""
    defaults = defaults or {}

    def incoming(name: str) -> Column:
        if name in source.columns:
            return F.col(f"_in_{name}")
        return defaults.get(name, F.lit(None))

    new = source.select(*[F.col(c).alias(f"_in_{c}") for c in source.columns],
                        F.lit(True).alias("_is_in"))
    old = target.withColumn("_is_old", F.lit(True))
    on = [F.col(k) == F.col(f"_in_{k}") for k in keys]
    joined = old.join(new, on, "full_outer")
    columns = []
    for field in target.schema:
        name = field.name
        if name in keys:
            value = F.coalesce(F.col(name), F.col(f"_in_{name}"))
        elif name in update:
            value = F.when(F.col("_is_in"), incoming(name)).otherwise(F.col(name))
        else:
            value = F.when(F.col("_is_old"), F.col(name)).otherwise(incoming(name))
        columns.append(value.cast(field.dataType).alias(name))
    return joined.select(*columns)


class Warehouse:
    """Tables under one root. Tables of periods have a part for each period; tables with a key
    have a part for each of their buckets, a hash of the key, so that a merge rewrites only
    the buckets it touches. `bucket_rows` is about the rows of a bucket: a table that has
    outgrown it by two gets more buckets when it is next merged."""

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = 1_000_000):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_rows = bucket_rows

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _versions(self, table: str) -> Versions:
        if table in S.PERIOD_PARTITIONED:
            return Versions(self.spark, self.path(table), "period", T.StringType())
        return Versions(self.spark, self.path(table), _BUCKET, T.IntegerType())

    def exists(self, table: str) -> bool:
        if table in S.APPENDED:
            return bool(Versions(self.spark, self.root, "", T.StringType())._names(table))
        return self._versions(table).current()["number"] > 0

    def read(self, table: str) -> DataFrame:
        """The stored table, or an empty one with its schema. A frame stays with the version
        that was current when it was made."""
        schema = S.TABLES[table]
        if table in S.APPENDED:
            return (self.spark.read.schema(schema).parquet(self.path(table)) if self.exists(table)
                    else self.spark.createDataFrame([], schema))
        versions = self._versions(table)
        return versions.read(versions.current(), schema)

    def register_views(self) -> None:
        """Every stored table as a temporary view under its own name, and the stored views."""
        for table in S.TABLES:
            self.read(table).createOrReplaceTempView(table)
        for name, build in views.VIEWS.items():
            build(self.read).createOrReplaceTempView(name)

    def periods(self, table: str) -> list[str]:
        """Periods a table of periods holds."""
        return sorted(self._versions(table).current()["parts"])

    def _conform(self, table: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TABLES[table]])

    # --- tables of periods

    def replace_periods(self, table: str, df: DataFrame, periods: Sequence[str]) -> None:
        """Make `df` the content of the given periods in one step; other periods stay as they
        are, and a period that `df` has no rows for is empty afterwards.

        A period's rows are brought together first, so it gets few, large files, and a large
        period is split over several tasks; tables with a customer are sorted by it and have
        Bloom filters on it, so that a look for one customer skips most row groups."""
        versions = self._versions(table)
        before = versions.current()
        rows = self._conform(table, df).filter(F.col("period").isin(list(periods)))
        options = {}
        if "customer_id" in S.TABLES[table].names:
            rows = (rows.repartitionByRange("period", "customer_id")
                    .sortWithinPartitions("period", "customer_id"))
            options["parquet.bloom.filter.enabled#customer_id"] = "true"
        elif table == "month_invoices":
            rows = rows.repartitionByRange("period", "invoice_no").sortWithinPartitions(
                "period", "invoice_no")
        else:
            rows = rows.hint("rebalance", F.col("period"))
        fresh = versions.write(rows, options)
        kept = {p: f for p, f in before["parts"].items() if p not in set(periods)}
        versions.publish(before, kept | fresh)

    def drop_periods(self, table: str, periods: Iterable[str]) -> None:
        versions = self._versions(table)
        before, gone = versions.current(), set(periods)
        if gone & set(before["parts"]):
            versions.publish(before, {p: f for p, f in before["parts"].items() if p not in gone})

    # --- tables with a key

    def _bucketed(self, table: str, df: DataFrame, buckets: int) -> DataFrame:
        key = [F.col(k).cast("string") for k in S.KEYS[table]]
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))

    def _written(self, table: str, df: DataFrame, buckets: int) -> dict[str, str]:
        rows = self._bucketed(table, self._conform(table, df), buckets)
        return self._versions(table).write(rows.hint("rebalance", F.col(_BUCKET)))

    def _published(self, table: str, before: dict, parts: dict[str, str], **notes) -> None:
        versions = self._versions(table)
        rows = versions.read({"parts": parts}, S.TABLES[table]).count()  # from the files' footers
        versions.publish(before, parts, rows=rows, **notes)

    def replace(self, table: str, df: DataFrame, **notes) -> None:
        """Write a whole table; the new one takes the old one's place when it is complete."""
        before = self._versions(table).current()
        buckets = before.get("buckets", BUCKETS)
        self._published(table, before, self._written(table, df, buckets), buckets=buckets, **notes)

    def append(self, table: str, df: DataFrame) -> None:
        self._conform(table, df).write.mode("append").parquet(self.path(table))

    def upsert(self, table: str, df: DataFrame, update: Sequence[str] = (),
               defaults: dict[str, Column] | None = None) -> int:
        """Merge by the table's key and return the number of incoming rows."""
        return self._merge_written(table, stage(df, f"incoming-{table}"), update, defaults)

    def _touched(self, table: str, incoming: DataFrame, before: dict) -> tuple[int, list[str]]:
        """Number of buckets of the merged table, and those that the incoming rows touch."""
        buckets = before.get("buckets", BUCKETS)
        if before.get("rows", 0) > 2 * buckets * self.bucket_rows:
            while before["rows"] > buckets * self.bucket_rows:
                buckets *= 2
            return buckets, [str(b) for b in range(buckets)]
        found = self._bucketed(table, incoming, buckets).select(_BUCKET).distinct().collect()
        return buckets, [str(r[0]) for r in found]  # at most one row a bucket

    def _merge_written(self, table: str, incoming: DataFrame, update: Sequence[str],
                       defaults: dict[str, Column] | None, **notes) -> int:
        """`upsert` of staged rows: reads and rewrites the buckets they touch."""
        rows = incoming.count()
        if rows:
            versions = self._versions(table)
            before = versions.current()
            buckets, touched = self._touched(table, incoming, before)
            whole = buckets != before.get("buckets", buckets)
            old = versions.read(before, S.TABLES[table], None if whole else touched)
            fresh = self._written(
                table, merge(old, incoming, S.KEYS[table], update, defaults), buckets)
            kept = {} if whole else {b: f for b, f in before["parts"].items() if b not in touched}
            self._published(table, before, kept | fresh, buckets=buckets, **notes)
        return rows

    def upsert_keyed(self, table: str, key: str, df: DataFrame, update: Sequence[str] = (),
                     defaults: dict[str, Column] | None = None) -> int:
        """`upsert` for a dimension with a surrogate key: known members keep theirs, new
        ones get the numbers after the largest, in order of the natural key."""
        natural = S.KEYS[table][0]
        members = stage(df.filter(F.col(natural).isNotNull()), f"members-{table}")
        versions = self._versions(table)
        before = versions.current()
        if not before["parts"]:
            incoming, top = ordering.number_rows(members, natural, key), 0
        else:
            _, touched = self._touched(table, members, before)
            stored = versions.read(before, S.TABLES[table], touched).select(natural, key)
            known = stage(members.join(stored, natural, "left"), f"known-{table}")
            top = before.get("top", 0)
            new = ordering.number_rows(known.filter(F.col(key).isNull()).drop(key), natural, key,
                                       after=top)
            incoming = known.filter(F.col(key).isNotNull()).unionByName(new)
        incoming = stage(incoming, f"incoming-{table}")
        largest = incoming.agg(F.coalesce(F.max(key), F.lit(0))).collect()[0][0]
        return self._merge_written(table, incoming, update, defaults, top=max(top, largest))

    def delete_sales_of_month(self, year: int, month: int) -> None:
        """Remove the facts dated in a calendar month. Sales of the last day may be stored
        with the following period, so two partitions are rewritten."""
        start, end = (year * 100 + month) * 100 + 1, (year * 100 + month) * 100 + 31
        following = f"{year + 1}-01" if month == 12 else f"{year}-{month + 1:02d}"
        touched = [f"{year}-{month:02d}", following]
        facts = self.read("fact_sales").filter(F.col("period").isin(touched))
        kept = stage(facts.filter(~F.col("date_key").between(start, end)), "kept-facts")
        self.replace_periods("fact_sales", kept, touched)

    def log_run(self, period: str, flow: str, status: str, rows: int,
                started: dt.datetime, error: str | None = None) -> None:
        row = (uuid.uuid4().hex, period, flow, status, rows, started, dt.datetime.now(), error)
        self.append("pipeline_log",
                    self.spark.createDataFrame([row], S.TABLES["pipeline_log"]))
