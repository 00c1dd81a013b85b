"""CSV in and out: raw daily file (SRC-3), feature CSV (SNK-2) and the
schema-checked load with a bad-record limit (SRC-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_TEXT = "yyyy-MM-dd HH:mm:ss"
BAD = "_bad"


def read_csv_columns(spark: SparkSession, path: str, schema: T.StructType,
                     keep: Sequence[str]) -> DataFrame:
    """SRC-3: read a headed CSV with its full declared schema (no inference)
    and keep some columns; the CSV reader parses only the kept ones."""
    return (spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd")
            .option("timestampNTZFormat", TS_TEXT).csv(path).select(*keep))


def write_csv(df: DataFrame, path: str, ts_format: str = TS_TEXT) -> None:
    """SNK-2: header, no index, timestamps as text."""
    cols = [F.date_format(c.name, ts_format).alias(c.name)
            if isinstance(c.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(c.name)
            for c in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


class TooManyBadRecords(ValueError):
    pass


def load_csv(spark: SparkSession, path: str, schema: T.StructType, target: str,
             max_bad_records: int = 2, staging: str | None = None) -> DataFrame:
    """SRC-4 + SNK-1: parse with an explicit schema and one header row, count
    bad records (a bad date or int, or an extra column), fail above the limit,
    otherwise replace ``target`` (parquet) with the good rows.

    Parsing lands in a staging table first: it cuts lineage (the count and
    the final write read parsed parquet, not the CSV twice) and lets the bad
    record column be queried. A blank number is a null, not a bad record.
    """
    full = T.StructType([*schema.fields, T.StructField(BAD, T.StringType(), True)])
    parsed = (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BAD)
              .option("timestampNTZFormat", TS_TEXT).option("dateFormat", "yyyy-MM-dd")
              .csv(path))
    staging = staging or target.rstrip("/") + "._staging"
    parsed.write.mode("overwrite").parquet(staging)
    staged = spark.read.parquet(staging)
    n_bad = staged.where(F.col(BAD).isNotNull()).count()
    if n_bad > max_bad_records:
        raise TooManyBadRecords(f"{n_bad} bad records in {path}, limit {max_bad_records}")
    (staged.where(F.col(BAD).isNull()).drop(BAD)
     .write.mode("overwrite").parquet(target))
    return spark.read.parquet(target)


COUNT_CSV_SCHEMA = T.StructType([
    T.StructField("date", T.TimestampNTZType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("lag_1_weekly_vaccinations_count", T.LongType(), True),
    T.StructField("weekly_vaccinations_count", T.LongType(), True),
    T.StructField("lag_2_weekly_vaccinations_count", T.LongType(), True),
])

DAILY_CSV_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("total_count", T.LongType(), True),
    T.StructField("daily_count", T.LongType(), True),
])
