"""Week bins, NOT IN with nulls, fill, lag/lead and trend features on hand-made rows."""

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintime.functions.nulls import fill_zero_all, not_in_keep_nulls
from pintime.functions.time import week_ending_monday
from pintime.plans.features import clean_daily, count_features, trend_features, weekly_counts

DAILY = T.StructType([T.StructField("date", T.DateType()), T.StructField("location", T.StringType()),
                      T.StructField("daily_count", T.LongType())])
POINTS = T.StructType([T.StructField("date", T.DateType()),
                       T.StructField("sub_region_1", T.StringType()),
                       T.StructField("sub_region_2", T.StringType()),
                       T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
                       T.StructField("s3", T.LongType())])


def test_week_bins_close_on_monday(spark):
    days = [date(2021, 1, 3), date(2021, 1, 4), date(2021, 1, 5), date(2021, 1, 11),
            date(2021, 1, 12)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(week_ending_monday("d")).collect()]
    assert got == [date(2021, 1, 4), date(2021, 1, 4), date(2021, 1, 11), date(2021, 1, 11),
                   date(2021, 1, 18)]


def test_week_label_matches_rule_over_three_years(spark):
    df = spark.sql("select explode(sequence(date'2020-01-01', date'2022-12-31')) as d")
    got = df.select("d", week_ending_monday("d").alias("w")).collect()
    for r in got:
        delta = (r.w - r.d).days
        assert r.w.weekday() == 0 and 0 <= delta <= 6


def test_not_in_keeps_null_and_fill_zero(spark):
    df = spark.createDataFrame([
        (date(2021, 1, 4), None, 5), (date(2021, 1, 4), "A", None),
        (date(2021, 1, 4), "NATION_0", 7), (date(1995, 12, 31), "A", 9)], DAILY)
    kept = df.where(not_in_keep_nulls("location", ["NATION_0"]))
    assert kept.count() == 3
    cleaned = clean_daily(df)
    got = sorted((r.location, r.daily_count) for r in cleaned.collect())
    assert got == [("0", 5), ("A", 0)]
    filled = fill_zero_all(spark.createDataFrame([(None, None)], "a string, b long")).first()
    assert (filled.a, filled.b) == ("0", 0)


def test_count_features_shift_by_row(spark):
    df = spark.createDataFrame([
        (date(2021, 1, 4), "ONE", 3),
        (date(2021, 1, 4), "GAP", 1), (date(2021, 1, 5), "GAP", 2),
        (date(2021, 1, 18), "GAP", 4),     # week of 01-11 missing
        (date(2021, 1, 25), "GAP", 8)], DAILY)
    weekly = {(r.location, r.date): r.lag_1_weekly_vaccinations_count
              for r in weekly_counts(df).collect()}
    assert weekly[("GAP", date(2021, 1, 4))] == 1 and weekly[("GAP", date(2021, 1, 11))] == 2
    out = {(r.state, r.date.date()): r for r in count_features(df).collect()}
    one = out[("ONE", date(2021, 1, 4))]
    assert one.weekly_vaccinations_count is None and one.lag_2_weekly_vaccinations_count is None
    mid = out[("GAP", date(2021, 1, 18))]
    assert mid.lag_2_weekly_vaccinations_count == 2      # previous row, 1 week skipped
    assert mid.weekly_vaccinations_count == 8
    assert dict(count_features(df).dtypes)["lag_1_weekly_vaccinations_count"] == "bigint"


def test_trend_features_null_mean_mid_series(spark):
    rows = [(date(2021, 1, 4), "A", "x", 1, 1, 1), (date(2021, 1, 4), "A", "y", 3, 3, 3),
            (date(2021, 1, 11), "A", "x", None, 2, 2),
            (date(2021, 1, 18), "A", "x", 5, 5, 5),
            (date(2021, 1, 25), "A", "x", 6, 6, 6),
            (date(2021, 1, 4), None, "z", 1, 1, 1), (date(2021, 1, 11), None, "z", 1, 1, 1)]
    out = trend_features(spark.createDataFrame(rows, POINTS))
    got = {r.date.date(): r for r in out.collect()}
    # 01-04: no previous row; 01-11: null mean; 01-18: previous mean is null
    assert sorted(got) == [date(2021, 1, 25)]
    r = got[date(2021, 1, 25)]
    assert (r.lag_1_vaccine_interest, r.lag_2_vaccine_interest) == (6.0, 5.0)
    avg = trend_features(spark.createDataFrame(rows[:2] + [(date(2021, 1, 11), "A", "x", 4, 4, 4)],
                                               POINTS)).first()
    assert avg.lag_2_vaccine_interest == 2.0   # mean of 1 and 3
    assert out.where(F.col("state").isNull()).count() == 0
