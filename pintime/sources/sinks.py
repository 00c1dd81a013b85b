"""Table writes (SNK-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pintime.sources.periods import PERIOD, period_of


def write_feature_table(df: DataFrame, path: str, ts: str = "date") -> None:
    """Write a feature table, partitioned by the year of its event time, so that
    increments and bounded retrieval read only the years they need; a year's rows go to
    as many files as their size needs. Tables that are kept up are ``PeriodTable``s."""
    rows = df.withColumn(PERIOD, period_of(ts)).hint("rebalance", PERIOD)
    overwrite_table(rows, path, partition_by=[PERIOD])


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Replace the table at ``path`` with ``df`` (WRITE_TRUNCATE). No global
    sort before the write: readers sort if they need order."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table_at(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
