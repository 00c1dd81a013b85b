"""The driver's parquet tables and the two raw inputs built from them.

``daily_counts`` stands in for the daily CSV (date, location, daily count) and
``trend_points`` for the raw trend table (several rows per date and region);
see FIXTURES.md section 2. Both are lazy plans: columns are pruned and
filters pushed into the parquet scans by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date DATE, location STRING, daily_count BIGINT``: orders per day and
    customer nation.

    Spark broadcasts the customer-to-nation map if it measures it to be small;
    otherwise orders and customers meet in a sort-merge join. The count is
    partially aggregated per task before the (date, location) shuffle.
    """
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cust_nation = (cust.join(_nation_names(spark, sf_dir),
                             F.col("c_nationkey") == F.col("n_nationkey"))
                   .select("c_custkey", "n_name"))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("date"))
    joined = orders.join(cust_nation, F.col("o_custkey") == F.col("c_custkey"))
    return (joined.groupBy("date", F.col("n_name").alias("location"))
            .agg(F.count(F.lit(1)).alias("daily_count")))


def trend_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date DATE, sub_region_1, sub_region_2 STRING, s1, s2, s3 BIGINT``:
    one row per line item, dated by the Monday of its ship week, placed by the
    supplier's nation (region) and supplier (sub-region).

    Measures are integer-scaled so averages are exact in every engine.
    """
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    supp_nation = (supp.join(_nation_names(spark, sf_dir),
                             F.col("s_nationkey") == F.col("n_nationkey"))
                   .select("s_suppkey", F.col("n_name").alias("sub_region_1"),
                           F.col("s_name").alias("sub_region_2")))
    items = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.trunc(F.to_date("l_shipdate"), "week").alias("date"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("s1"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("s2"),
        F.col("l_quantity").cast("bigint").alias("s3"),
    )
    return (items.join(supp_nation, F.col("l_suppkey") == F.col("s_suppkey"))
            .select("date", "sub_region_1", "sub_region_2", "s1", "s2", "s3"))


def register_raw_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose the two raw inputs to ``spark.sql`` (SRC-2)."""
    daily_counts(spark, sf_dir).createOrReplaceTempView("daily_counts")
    trend_points(spark, sf_dir).createOrReplaceTempView("trend_points")
