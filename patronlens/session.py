"""Session settings for standalone use; callers may bring their own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "patronlens", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution on and skewed joins split.

    On a cluster leave `shuffle_partitions` unset and give a generous
    `spark.sql.adaptive.coalescePartitions.initialPartitionNum` instead: adaptive
    execution then merges small partitions down to the advisory size."""
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               # recording the call site of every column costs more than small plans take to run
               .config("spark.sql.dataFrameQueryContext.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
