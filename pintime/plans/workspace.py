"""A workspace binds one data directory: raw views, the two feature tables as
temp views, and the registered definitions.

A workspace builds the feature tables from the raw tables and writes them (parquet,
under the shared checkpoint root), because retrieval, publishing and drift read
them several times; the written tables also cut lineage, so a lost executor
re-reads files rather than re-aggregating the raw data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pintime import config
from pintime.definitions import FeatureRepo, FeatureService, FeatureView
from pintime.plans.features import count_features, trend_features
from pintime.plans.repo import build_repo, count_view, trend_view
from pintime.session import scratch_dir
from pintime.sources.sinks import write_feature_table
from pintime.sources.tables import register_raw_views


@dataclass
class Workspace:
    spark: SparkSession
    sf_dir: str
    repo: FeatureRepo

    @property
    def trend(self) -> FeatureView:
        return self.repo.get_feature_view("vaccine_search_trends")

    @property
    def counts(self) -> FeatureView:
        return self.repo.get_feature_view("weekly_vaccinations")

    @property
    def serving(self) -> FeatureService:
        return self.repo.get_feature_service("serving_features")

    @property
    def training(self) -> FeatureService:
        return self.repo.get_feature_service("training_features")

    def count_table(self) -> DataFrame:
        return self.spark.table(config.COUNT_TABLE)

    def trend_table(self) -> DataFrame:
        return self.spark.table(config.TREND_TABLE)


def open_workspace(spark: SparkSession, sf_dir: str,
                   write: tuple[str, ...] = ("trends", "counts")) -> Workspace:
    """Build the feature tables from the raw tables under ``sf_dir`` and register them.

    Nothing is remembered between calls: every workspace reads its sources anew. The
    tables named in ``write`` are written under a folder of this workspace's own (they
    are read more than once); the others stay lazy plans."""
    register_raw_views(spark, sf_dir)
    root = scratch_dir(spark, "workspace")
    tables = {"trends": (trend_features(spark.table("trend_points")), config.TREND_TABLE),
              "counts": (count_features(spark.table("daily_counts")), config.COUNT_TABLE)}
    for name, (df, view) in tables.items():
        if name in write:
            write_feature_table(df, f"{root}/{name}")
            df = spark.read.parquet(f"{root}/{name}")
        df.createOrReplaceTempView(view)
    return Workspace(spark, sf_dir, build_repo(spark, trend_view(), count_view()))
