"""The concrete definitions: one entity, two views, two services."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from pintime import config
from pintime.definitions import (
    Entity,
    FeatureRepo,
    FeatureService,
    FeatureSource,
    FeatureView,
    Field,
)
from pintime.sources.periods import PERIOD

state = Entity(name="state", join_keys=("state",))


def trend_view(table: str = config.TREND_TABLE, path: str | None = None,
               versioned: bool = False) -> FeatureView:
    src = FeatureSource(name="vaccine_search_trends_src", timestamp_field="date",
                        table=None if path else table, path=path, period=PERIOD,
                        versioned=versioned)
    return FeatureView(name="vaccine_search_trends", entities=[state], ttl=config.DEFAULT_TTL,
                       schema=[Field(n, T.FloatType()) for n in config.TREND_FEATURES],
                       source=src)


def count_view(table: str = config.COUNT_TABLE, path: str | None = None,
               versioned: bool = False) -> FeatureView:
    src = FeatureSource(name="weekly_vaccinations_src", timestamp_field="date",
                        table=None if path else table, path=path, period=PERIOD,
                        versioned=versioned)
    return FeatureView(name="weekly_vaccinations", entities=[state], ttl=config.DEFAULT_TTL,
                       schema=[Field(n, T.LongType()) for n in
                               ["lag_1_weekly_vaccinations_count",
                                "lag_2_weekly_vaccinations_count",
                                "weekly_vaccinations_count"]],
                       source=src)


def services(trend: FeatureView, counts: FeatureView) -> tuple[FeatureService, FeatureService]:
    serving = FeatureService(name="serving_features", features=[
        trend, counts[["lag_1_weekly_vaccinations_count", "lag_2_weekly_vaccinations_count"]]])
    training = FeatureService(name="training_features", features=[trend, counts])
    return serving, training


def build_repo(spark: SparkSession, trend: FeatureView | None = None,
               counts: FeatureView | None = None) -> FeatureRepo:
    trend = trend or trend_view()
    counts = counts or count_view()
    serving, training = services(trend, counts)
    return FeatureRepo().apply(spark, [state, trend, counts, serving, training])
