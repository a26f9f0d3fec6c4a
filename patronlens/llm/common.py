"""Driver side: reading the tables and staging intermediate results."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from patronlens.staging import new_path

# Settings that hold while a step is staged. Shuffle files go with their job;
# small batches keep Python workers small beside long texts.
STAGING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fetched(df: DataFrame) -> pd.DataFrame:
    """A bounded result on the driver, by way of Arrow: no object is made for each row."""
    return df.toArrow().to_pandas()


@contextlib.contextmanager
def tidy_shuffles(spark: SparkSession, rows: int | None = None) -> Iterator[None]:
    """Shuffle files of a job inside are deleted when it ends, so that a chain of staged
    steps needs the disk of its largest step, not of all of them. `rows`: of an Arrow batch,
    where rows are long."""
    now = STAGING if rows is None else STAGING | {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}
    before = {key: spark.conf.get(key, None) for key in now}
    for key, value in now.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def staged(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write `df` to the shared folder and go on from the written table; `rows` as above."""
    spark = df.sparkSession
    path = new_path(spark, f"llm-{label}")
    with tidy_shuffles(spark, rows):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._staged_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bundled(docs: DataFrame) -> DataFrame:
    """doc_id, text and lang, and in `row` all columns but the text, so that no name of a
    column of `docs` can meet one of an operator's own."""
    return docs.select("doc_id", "text", *(["lang"] if "lang" in docs.columns else []), F.struct(
        *(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))


def unbundled(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` from what `bundled` made of them."""
    return rows.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
                         for c in docs.columns))


def in_fold(doc_id: Column | str, folds: int) -> Column:
    """True for a document of the held-out fold; a document without an id is held out."""
    of = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(of.cast("string").cast("binary")) % folds == 0, F.lit(True))


def extended(schema: T.StructType, **kinds: str | T.DataType) -> T.StructType:
    """The schema with more columns (StructType.add would change the frame's own schema)."""
    out = T.StructType(list(schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out
