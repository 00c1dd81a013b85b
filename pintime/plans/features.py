"""Feature builds: weekly trend features (FS-12) and weekly count features (FS-13).

Both aggregate first (partial + final hash aggregation, so a hot key is
combined map-side) and only then run the per-key lag/lead window over the
small weekly series: one shared window spec, hence one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintime import config
from pintime.functions.nulls import as_nullable_int, fill_zero_all, not_in_keep_nulls
from pintime.functions.time import date_to_ts, week_ending_monday

_TREND_MEASURES = [
    # (raw measure, current-week feature, previous-week feature)
    ("s1", "lag_1_vaccine_interest", "lag_2_vaccine_interest"),
    ("s2", "lag_1_vaccine_intent", "lag_2_vaccine_intent"),
    ("s3", "lag_1_vaccine_safety", "lag_2_vaccine_safety"),
]


def trend_avg(points: DataFrame) -> DataFrame:
    """AGG-1: mean of each measure per (date, state); finer sub-regions
    collapse, a null state is its own group, nulls are ignored by ``avg``."""
    return (points.groupBy("date", F.col("sub_region_1").alias("state"))
            .agg(*[F.avg(raw).alias(cur) for raw, cur, _ in _TREND_MEASURES]))


def trend_rows(cells: DataFrame, *carry: str) -> DataFrame:
    """WIN-1 (previous row per state), then FLT-5, over the means of ``trend_avg``;
    ``carry`` names further columns of the cells to keep."""
    w = Window.partitionBy("state").orderBy("date")
    cols = [date_to_ts("date").alias("date"), F.col("state")]
    for _, cur, prev in _TREND_MEASURES:
        cols += [F.col(cur), F.lag(cur, 1).over(w).alias(prev)]
    lagged = cells.select(*cols, *carry)
    return lagged.na.drop(how="any", subset=["state", *config.TREND_FEATURES]).select(
        "date", "state", *config.TREND_FEATURES, *carry)


def trend_features(points: DataFrame) -> DataFrame:
    """FS-12: AGG-1, then WIN-1 (previous row per state), then FLT-5.

    ``lag_1_*`` is the current week's mean and ``lag_2_*`` the previous row's
    (Q2). Null means take part in the lag and are filtered afterwards (Q6).
    """
    return trend_rows(trend_avg(points))


def clean_daily(daily: DataFrame) -> DataFrame:
    """FLT-2/3/7: drop excluded locations (nulls kept), keep dates on or after
    the floor, then fill every null with zero (a null location becomes '0')."""
    kept = daily.select("date", "location", "daily_count").where(
        not_in_keep_nulls("location", config.EXCLUDED_LOCATIONS)
        & (F.col("date") >= F.lit(config.DATE_FLOOR).cast("date")))
    return fill_zero_all(kept)


def weekly_counts(daily: DataFrame) -> DataFrame:
    """AGG-2: weekly sum per location over Tue..Mon bins labelled by the
    closing Monday; only observed (week, location) pairs appear."""
    name = "lag_1_weekly_vaccinations_count"
    weekly = (clean_daily(daily).groupBy(week_ending_monday("date").alias("date"), "location")
              .agg(F.sum("daily_count").alias(name)))
    # PRJ-5: fractional sums stay as they are; whole ones become nullable integers
    whole = isinstance(weekly.schema[name].dataType, T.IntegralType)
    return weekly if whole else as_nullable_int(weekly, [name])


def count_rows(cells: DataFrame, *carry: str) -> DataFrame:
    """WIN-2 and WIN-3 over the weekly sums per state; ``carry`` names further columns to
    keep. Shifts are by row: a missing week is skipped (Q5)."""
    w = Window.partitionBy("state").orderBy("date")
    cur = "lag_1_weekly_vaccinations_count"
    return cells.select(
        date_to_ts("date").alias("date"),
        "state",
        F.col(cur),
        F.lead(cur, 1).over(w).alias("weekly_vaccinations_count"),
        F.lag(cur, 1).over(w).alias("lag_2_weekly_vaccinations_count"),
        *carry,
    )


def count_features(daily: DataFrame) -> DataFrame:
    """FS-13: weekly sums, then next week's count as the target (lead) and the
    previous week's count (lag). Columns in the table's declared order."""
    return count_rows(weekly_counts(daily).withColumnRenamed("location", "state"))
