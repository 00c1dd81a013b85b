"""Registered queries: one callable per operator key of SURVEY section 2.

Each takes ``(spark, sf_dir)``, reads the driver's tables under ``sf_dir`` and
returns a DataFrame whose column names match the oracle SQL. Keys that write
(feature tables, stores, CSV, models) run jobs while they build it. Rounding for
display happens here, never in the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime import config
from pintime.functions.nulls import drop_any_null, not_in_keep_nulls
from pintime.functions.stats import round_p
from pintime.functions.time import date_to_ts, interval, ts_lit, week_ending_monday
from pintime.functions.vectors import feature_array
from pintime.operators.asof import AsofSide, asof_join
from pintime.operators.drift import chi2_test, ks_test, out_of_bounds, target_drift
from pintime.operators.drift import drift_report as report
from pintime.operators.explore import Stage, correlations, describe, head, histogram, tail
from pintime.operators.explore import stage_counts as stage_count_table
from pintime.operators.latest import SNAPSHOT_TS, expire, latest_per_key, upsert
from pintime.operators.split import temporal_split
from pintime.plans import features as feat
from pintime.plans.boosting import fit_counts
from pintime.plans.maintenance import COUNTS, TRENDS, WeeklyFeatures, rebuild, update
from pintime.plans.model import ModelRegistry, fit, gbt_pipeline, mae, poisson_pipeline, score
from pintime.plans.model import feature_importance as importance
from pintime.plans.online import (SnapshotStore, get_online_features, latest_snapshot,
                                  materialize_incremental)
from pintime.plans.profiles import DriftProfiles, update_profiles
from pintime.plans.refresh import refresh
from pintime.plans.retrieval import get_historical_features
from pintime.plans.windows import fetch_window, split_windows, window_entity_query
from pintime.plans.windows import window_union as drift_windows
from pintime.plans.workspace import open_workspace
from pintime.session import ensure_checkpoint_dir, scratch_dir
from pintime.sources.csv import (COUNT_CSV_SCHEMA, DAILY_CSV_SCHEMA, load_csv,
                                 read_csv_columns, write_csv)
from pintime.sources.periods import PERIOD, PeriodTable
from pintime.sources.requests import build_requests, read_request_keys, write_requests
from pintime.sources.sinks import overwrite_table, read_table_at
from pintime.sources.tables import daily_counts, trend_points

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ENTITY_QUERY = f"select state, date as event_timestamp from {config.COUNT_TABLE}"


def query(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


# ---- feature builds -------------------------------------------------------

@query("trend_avg")
def trend_avg(spark, sf_dir):
    return feat.trend_avg(trend_points(spark, sf_dir))


@query("trend_features")
def trend_features(spark, sf_dir):
    return feat.trend_features(trend_points(spark, sf_dir))


@query("weekly_counts")
def weekly_counts(spark, sf_dir):
    return feat.weekly_counts(daily_counts(spark, sf_dir))


@query("count_features")
def count_features(spark, sf_dir):
    return feat.count_features(daily_counts(spark, sf_dir))


def _earlier_state(raw: DataFrame, measures: list[str]) -> DataFrame:
    """A raw table as it might have been before its last load: days that came late or were
    corrected since, days that are gone now, and none of the newest."""
    late, wrong = F.month("date") == 2, F.dayofyear("date") % 41 == 0
    newest = F.col("date") >= F.lit(config.FIRST_INCREMENT_END[:10]).cast("date")
    held = raw.where(~(late & (F.year("date") == 1997)) & ~newest).withColumns({
        c: F.when(wrong, F.col(c) + 7).otherwise(F.col(c)) for c in measures})
    gone = raw.where(F.dayofyear("date") % 97 == 0).withColumn(
        "date", F.date_add("date", 3000))
    return held.unionByName(gone)


def _maintained(spark, label: str, spec: WeeklyFeatures, raw: DataFrame,
                measures: list[str]) -> DataFrame:
    """Built from an earlier state of the raw table, then brought up to it."""
    table = PeriodTable(spark, scratch_dir(spark, label))
    rebuild(table, spec, _earlier_state(raw, measures))
    update(table, spec, raw)
    return table.read("rows").drop(PERIOD)


@query("counts_maintained")
def counts_maintained(spark, sf_dir):
    return _maintained(spark, "counts", COUNTS, daily_counts(spark, sf_dir), ["daily_count"])


@query("trends_maintained")
def trends_maintained(spark, sf_dir):
    return _maintained(spark, "trends", TRENDS, trend_points(spark, sf_dir), ["s1", "s2", "s3"])


@query("filter_not_in")
def filter_not_in(spark, sf_dir):
    d = daily_counts(spark, sf_dir)
    return d.where(not_in_keep_nulls("location", config.EXCLUDED_LOCATIONS)
                   & (F.col("date") >= F.lit(config.DATE_FLOOR).cast("date")))


@query("fill_zero")
def fill_zero(spark, sf_dir):
    return feat.clean_daily(daily_counts(spark, sf_dir))


# ---- point-in-time joins ----------------------------------------------------

@query("entity_rows")
def entity_rows(spark, sf_dir):
    open_workspace(spark, sf_dir, write=())
    return spark.sql(ENTITY_QUERY)


def _asof_trend(spark, sf_dir, ttl):
    ws = open_workspace(spark, sf_dir)
    entity = spark.sql(ENTITY_QUERY)
    side = AsofSide(df=ws.trend.to_df(spark), ts="date",
                    features=config.TREND_FEATURES, ttl=ttl)
    return asof_join(entity, side, keys=["state"], entity_ts=config.EVENT_TS)


@query("asof_join")
def asof_join_long(spark, sf_dir):
    return _asof_trend(spark, sf_dir, config.DEFAULT_TTL)


@query("asof_join_ttl")
def asof_join_ttl(spark, sf_dir):
    return _asof_trend(spark, sf_dir, config.SHORT_TTL)


@query("training_set")
def training_set(spark, sf_dir):
    ws = open_workspace(spark, sf_dir)
    return get_historical_features(spark, ws.training, entity_query=ENTITY_QUERY)


def clean_training_set(spark, sf_dir) -> DataFrame:
    return drop_any_null(training_set(spark, sf_dir))


@query("training_set_clean")
def training_set_clean(spark, sf_dir):
    return clean_training_set(spark, sf_dir)


# ---- definitions, projections, filters, sorts ------------------------------

@query("src_feature_table")
def src_feature_table(spark, sf_dir):
    ws = open_workspace(spark, sf_dir, write=())
    return ws.counts.to_df(spark)


@query("typed_features")
def typed_features(spark, sf_dir):
    ws = open_workspace(spark, sf_dir, write=())
    return ws.trend.to_df(spark)


@query("serving_projection")
def serving_projection(spark, sf_dir):
    ws = open_workspace(spark, sf_dir, write=())
    proj = ws.serving.projections()[1]
    return proj.view.to_df(spark, proj.features)


@query("feature_matrix")
def feature_matrix(spark, sf_dir):
    return clean_training_set(spark, sf_dir).select(*config.X_COLS, config.Y_COL)


def state_rows(spark, sf_dir) -> DataFrame:
    return clean_training_set(spark, sf_dir).where(F.col("state") == config.FILTER_STATE)


@query("filter_state")
def filter_state(spark, sf_dir):
    return state_rows(spark, sf_dir)


@query("filter_between")
def filter_between(spark, sf_dir):
    open_workspace(spark, sf_dir, write=())
    return spark.sql(window_entity_query(*config.DRIFT_WINDOW_A))


@query("sorted_training_set")
def sorted_training_set(spark, sf_dir):
    return clean_training_set(spark, sf_dir).orderBy(config.EVENT_TS, "state")


@query("head_rows")
def head_rows(spark, sf_dir):
    return head(state_rows(spark, sf_dir), [config.EVENT_TS, "state"])


@query("tail_rows")
def tail_rows(spark, sf_dir):
    return tail(state_rows(spark, sf_dir), [config.EVENT_TS, "state"])


@query("describe_target")
def describe_target(spark, sf_dir):
    return rounded(describe(state_rows(spark, sf_dir), config.Y_COL),
                   dict.fromkeys(["mean", "std", "p25", "p50", "p75"], 6))


def count_stages() -> list[Stage]:
    """The count job's steps over the raw daily rows: loaded, filtered, weekly."""
    kept = (not_in_keep_nulls("location", config.EXCLUDED_LOCATIONS)
            & (F.col("date") >= F.lit(config.DATE_FLOOR).cast("date")))
    named = F.coalesce("location", F.lit("0"))      # as the filter fills it
    return [Stage("loaded", F.lit(True), F.col("location")), Stage("filtered", kept, named),
            Stage("weekly", kept, named, (named.alias("k"), week_ending_monday("date").alias("w")))]


@query("stage_counts")
def stage_counts(spark, sf_dir):
    return stage_count_table(daily_counts(spark, sf_dir), count_stages())


@query("training_set_from_df")
def training_set_from_df(spark, sf_dir):
    ws = open_workspace(spark, sf_dir)
    entity = ws.trend_table().select("state", F.col("date").alias(config.EVENT_TS))
    return get_historical_features(spark, ws.training, entity_df=entity)


# ---- temporal split --------------------------------------------------------

def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round columns for display; p-values below half the last digit show as 0."""
    return df.withColumns({c: round_p(F.col(c), d) if c == "p_value" else F.round(c, d)
                           for c, d in digits.items()})


def _split(spark, sf_dir):
    data = clean_training_set(spark, sf_dir).select(
        "state", config.EVENT_TS, *config.X_COLS, config.Y_COL)
    return temporal_split(data, timedelta(weeks=1), config.EVENT_TS)


@query("temporal_split_train")
def temporal_split_train(spark, sf_dir):
    return _split(spark, sf_dir)[0]


@query("temporal_split_test")
def temporal_split_test(spark, sf_dir):
    return _split(spark, sf_dir)[1]


# ---- online store ------------------------------------------------------------

def _max_ts(df: DataFrame, col: str):
    return df.agg(F.max(col).alias("m")).first()["m"]


@query("online_snapshot")
def online_snapshot(spark, sf_dir):
    ws = open_workspace(spark, sf_dir, write=())
    return latest_snapshot(ws.counts.to_df(spark), ws.counts)


def _store(spark, label):
    return SnapshotStore(spark, scratch_dir(spark, label))


@query("materialize_increment")
def materialize_increment(spark, sf_dir):

    ws = open_workspace(spark, sf_dir, write=("counts",))
    store = _store(spark, "materialize")
    first_end = datetime.fromisoformat(config.FIRST_INCREMENT_END)
    materialize_incremental(spark, store, ws.counts, end_ts=first_end)
    last_end = _max_ts(ws.count_table(), "date")
    return materialize_incremental(spark, store, ws.counts, end_ts=max(last_end, first_end))


@query("online_upsert")
def online_upsert(spark, sf_dir):
    ws = open_workspace(spark, sf_dir, write=("counts",))
    src = ws.counts.to_df(spark)
    feats = ws.counts.feature_names
    snap = latest_per_key(src.where(F.col("date") <= ts_lit(config.FIRST_INCREMENT_END)),
                          ["state"], "date", feats)
    lo, hi = config.UPSERT_LATE_WINDOW
    inc_rows = src.where(F.col("date").between(ts_lit(lo), ts_lit(hi))
                         | (F.col("date") > ts_lit(config.UPSERT_NEW_AFTER)))
    inc = latest_per_key(inc_rows, ["state"], "date", feats)
    return upsert(snap, inc, ["state"], feats)


@query("online_expire")
def online_expire(spark, sf_dir):
    ws = open_workspace(spark, sf_dir, write=("trends",))
    snap = latest_snapshot(ws.trend.to_df(spark), ws.trend)
    as_of = snap.agg(F.max(SNAPSHOT_TS)).scalar()
    return expire(snap, as_of, config.SHORT_TTL)


def _published_store(spark, ws, label):
    store = _store(spark, label)
    for view, table in ((ws.trend, ws.trend_table()), (ws.counts, ws.count_table())):
        end = _max_ts(table, "date")
        if end is not None:
            materialize_incremental(spark, store, view, end_ts=end)
    return store


def request_states(spark, sf_dir) -> DataFrame:
    """Keys to look up: every location seen in the raw daily data (excluded
    ones included, so unknown keys are exercised)."""
    return daily_counts(spark, sf_dir).select(F.col("location").alias("state")).distinct()


@query("online_lookup")
def online_lookup(spark, sf_dir):
    ws = open_workspace(spark, sf_dir)
    store = _published_store(spark, ws, "lookup")
    return get_online_features(store, ws.serving, request_states(spark, sf_dir))


@query("refresh_job")
def refresh_job(spark, sf_dir):
    root = scratch_dir(spark, "refresh")
    store, ws = refresh(spark, sf_dir, root)
    keys = ws.counts.source.read(spark).select("state").distinct()
    return get_online_features(store, ws.serving, keys)


# ---- sources and sinks -------------------------------------------------------

@query("overwrite_roundtrip")
def overwrite_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "overwrite")
    trend = feat.trend_features(trend_points(spark, sf_dir))
    overwrite_table(trend.where(F.col("state") == config.FILTER_STATE), path)
    overwrite_table(trend, path)
    return read_table_at(spark, path)


def _daily_csv_roundtrip(spark, sf_dir, root):
    """Raw daily counts out to CSV (with a column the job ignores) and back."""
    daily = daily_counts(spark, sf_dir)
    raw = daily.select("date", "location", F.col("daily_count").alias("total_count"),
                       "daily_count")
    write_csv(raw, f"{root}/daily_csv")
    return read_csv_columns(spark, f"{root}/daily_csv", DAILY_CSV_SCHEMA,
                            ["date", "location", "daily_count"])


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "csv")
    counts = feat.count_features(_daily_csv_roundtrip(spark, sf_dir, root))
    write_csv(counts, f"{root}/weekly_csv")
    return load_csv(spark, f"{root}/weekly_csv", COUNT_CSV_SCHEMA, f"{root}/weekly_table")


@query("csv_load_bad_records")
def csv_load_bad_records(spark, sf_dir):
    """Count features to CSV plus a second file whose first two rows carry a
    non-numeric count; the load passes (2 bad records) and keeps the rest."""
    root = scratch_dir(spark, "csvbad")
    counts = feat.count_features(daily_counts(spark, sf_dir))
    write_csv(counts, f"{root}/in/good")
    damaged = (counts.where(F.col("state") == config.FILTER_STATE)
               .orderBy("date").limit(2)
               .select(F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "state",
                       F.lit("n/a").alias("lag_1_weekly_vaccinations_count"),
                       F.col("weekly_vaccinations_count").cast("string"),
                       F.col("lag_2_weekly_vaccinations_count").cast("string")))
    damaged.write.mode("overwrite").option("header", True).csv(f"{root}/in/bad")
    return load_csv(spark, f"{root}/in/*", COUNT_CSV_SCHEMA, f"{root}/table")


@query("requests_from_json")
def requests_from_json(spark, sf_dir):
    path = scratch_dir(spark, "requests")
    open_workspace(spark, sf_dir, write=())
    rows = spark.table(config.COUNT_TABLE).select(
        F.concat_ws("/", F.date_format("date", "yyyy-MM-dd"), "state").alias("id"), "state")
    write_requests(build_requests(rows, "id", "state"), path)
    return read_request_keys(spark, path)


# ---- drift windows -----------------------------------------------------------

@query("drift_window")
def drift_window(spark, sf_dir):
    ws = open_workspace(spark, sf_dir)
    return fetch_window(spark, ws, *config.DRIFT_WINDOW_A, sort=True)


@query("window_union")
def window_union(spark, sf_dir):
    ws = open_workspace(spark, sf_dir)
    return drift_windows(spark, ws, target="target")


@query("feature_histogram")
def feature_histogram(spark, sf_dir):
    ws = open_workspace(spark, sf_dir)
    cols = ["lag_1_vaccine_interest", "lag_1_vaccine_intent", "lag_1_vaccine_safety",
            config.Y_COL]
    return rounded(histogram(drift_windows(spark, ws), cols, by="year", bins=10),
                   {"lo": 6, "hi": 6})


@query("feature_target_corr")
def feature_target_corr(spark, sf_dir):
    ws = open_workspace(spark, sf_dir)
    return rounded(correlations(drift_windows(spark, ws), config.X_COLS, config.Y_COL, by="year"),
                   {"corr": 9})


# ---- scalar functions --------------------------------------------------------

@query("scalar_functions")
def scalar_functions(spark, sf_dir):
    """FN-1..FN-8, FN-10 over the count table (FN-9: feature_tensor, FN-11: requests_from_json)."""
    open_workspace(spark, sf_dir, write=())
    c = spark.table(config.COUNT_TABLE)
    text = F.date_format("date", "yyyy-MM-dd HH:mm:ss")
    return c.select(
        "state", "date",
        date_to_ts("date").alias("date_ts"),
        (F.col("date") >= ts_lit(config.DRIFT_WINDOW_A[0])).alias("after_start"),
        F.to_date(F.date_format("date", "yyyy-MM-dd"), "yyyy-MM-dd").alias("day"),
        text.alias("date_text"),
        F.year("date").alias("year"),
        (F.col("date") - interval(timedelta(weeks=1))).alias("week_before"),
        F.decode(F.encode("state", "UTF-8"), "UTF-8").alias("state_text"),
        F.to_json(F.array("lag_1_weekly_vaccinations_count", "weekly_vaccinations_count",
                          "lag_2_weekly_vaccinations_count")).alias("counts_json"),
        F.to_json(F.struct("state", "lag_1_weekly_vaccinations_count")).alias("row_json"),
    )


# ---- model (rows-only: results depend on the library) -----------------------

def _model_data(spark, sf_dir):
    """The model's input, checkpointed once: boosting iterates over it, and fit
    and transform then read the same materialized rows instead of re-running
    the point-in-time join (the checkpoint also cuts the lineage)."""
    ensure_checkpoint_dir(spark)
    return clean_training_set(spark, sf_dir).select(
        "state", config.EVENT_TS, *config.X_COLS, config.Y_COL).checkpoint()


@query("train_predict")
def train_predict(spark, sf_dir):
    data = _model_data(spark, sf_dir)
    model = fit(data, gbt_pipeline())
    return model.transform(data).select("state", config.EVENT_TS, config.Y_COL,
                                        F.col("prediction").cast("float").alias("prediction"))


@query("train_predict_poisson")
def train_predict_poisson(spark, sf_dir):
    data = _model_data(spark, sf_dir)
    model = fit(data, poisson_pipeline())
    return model.transform(data).select("state", config.EVENT_TS, config.Y_COL,
                                        F.col("prediction").cast("float").alias("prediction"))


def _boosted(spark, sf_dir):
    data = _model_data(spark, sf_dir)
    train, test = temporal_split(data, timedelta(weeks=1), config.EVENT_TS)
    return data, fit_counts(train, test)


@query("train_predict_boosted")
def train_predict_boosted(spark, sf_dir):
    """The reference's objective: boosted trees for counts, stopped by the newest weeks."""
    data, boosted = _boosted(spark, sf_dir)
    return boosted.model.transform(data).select(
        "state", config.EVENT_TS, config.Y_COL,
        F.col("prediction").cast("float").alias("prediction"))


@query("boosting_curve")
def boosting_curve(spark, sf_dir):
    """ML-4: the errors after every round on both parts of the split."""
    return _boosted(spark, sf_dir)[1].curve(spark)


@query("feature_tensor")
def feature_tensor(spark, sf_dir):
    """FN-9: the 8-wide float vector of every request key, and whether it is known."""
    ws = open_workspace(spark, sf_dir)
    store = _published_store(spark, ws, "tensor")
    feats = get_online_features(store, ws.serving, request_states(spark, sf_dir))
    known = F.greatest(*[F.col(c).isNotNull() for c in config.X_COLS])
    return feats.select("state", F.to_json(feature_array(config.X_COLS, "double")).alias("tensor"),
                        known.alias("known"))


@query("validation_mae")
def validation_mae(spark, sf_dir):
    train, test = temporal_split(_model_data(spark, sf_dir), timedelta(weeks=1), config.EVENT_TS)
    model = fit(train, gbt_pipeline())
    return mae(model, test)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    model = fit(_model_data(spark, sf_dir), gbt_pipeline())
    return importance(spark, model)


@query("batch_score")
def batch_score(spark, sf_dir):
    """Requests (JSON) -> online features -> assembled vector -> prediction,
    one distributed job for all keys."""
    ws = open_workspace(spark, sf_dir)
    registry = ModelRegistry(spark, scratch_dir(spark, "models"))
    registry.save("predict-counts", fit(_model_data(spark, sf_dir), gbt_pipeline()))
    store = _published_store(spark, ws, "score")
    req_path = scratch_dir(spark, "score-requests")
    keys = request_states(spark, sf_dir).withColumn("id", F.col("state"))
    write_requests(build_requests(keys, "id", "state"), req_path)
    feats = get_online_features(store, ws.serving, read_request_keys(spark, req_path))
    return score(registry.load("predict-counts"), feats, keys=("id", "state"))


# ---- drift -------------------------------------------------------------------

def _drift_frames(spark, sf_dir, target=True):
    ws = open_workspace(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    # one point-in-time pass, cut from its lineage so every test reads it once
    u = drift_windows(spark, ws, target="target" if target else None).checkpoint()
    return split_windows(u)


@query("drift_ks")
def drift_ks(spark, sf_dir):
    a, b = _drift_frames(spark, sf_dir)
    return rounded(ks_test(a, b, config.X_COLS).drop("mean_a", "mean_b"),
                   {"statistic": 9, "p_value": 6})


@query("drift_chi2")
def drift_chi2(spark, sf_dir):
    a, b = _drift_frames(spark, sf_dir)
    return rounded(chi2_test(a, b, "state"), {"statistic": 6, "p_value": 6})


@query("drift_target")
def drift_target(spark, sf_dir):
    a, b = _drift_frames(spark, sf_dir)
    return rounded(target_drift(a, b, "target"), {"statistic": 6, "p_value": 6})


@query("drift_report")
def drift_report(spark, sf_dir):
    a, b = _drift_frames(spark, sf_dir)
    shown = report(a, b, config.X_COLS, ["state"], target="target")
    digits = F.when(F.col("test") == "ks", F.round("statistic", 9)).otherwise(
        F.round("statistic", 6))
    return rounded(shown.withColumn("statistic", digits),
                   {"p_value": 6, "mean_a": 6, "mean_b": 6, "share_drifted": 6})


@query("drift_report_profiles")
def drift_report_profiles(spark, sf_dir):
    """The report of ``drift_report`` from stored profiles, exact."""
    ws = open_workspace(spark, sf_dir)
    profiles = DriftProfiles(spark, scratch_dir(spark, "profiles"))
    update_profiles(spark, ws, profiles, ())
    shown = profiles.report(config.DRIFT_WINDOW_A, config.DRIFT_WINDOW_B)
    digits = F.when(F.col("test") == "ks", F.round("statistic", 9)).otherwise(
        F.round("statistic", 6))
    return rounded(shown.withColumn("statistic", digits),
                   {"p_value": 6, "mean_a": 6, "mean_b": 6, "share_drifted": 6})


def serving_snapshot(spark, ws) -> DataFrame:
    """Newest serving features per key of the count table (state + X)."""
    counts = latest_snapshot(ws.counts.to_df(spark), ws.counts).select(
        "state", "lag_1_weekly_vaccinations_count", "lag_2_weekly_vaccinations_count")
    trend = latest_snapshot(ws.trend.to_df(spark), ws.trend).select("state", *config.TREND_FEATURES)
    return counts.join(trend, "state", "left").select("state", *config.X_COLS)


@query("online_out_of_bounds")
def online_out_of_bounds(spark, sf_dir):
    ws = open_workspace(spark, sf_dir)
    baseline = fetch_window(spark, ws, *config.DRIFT_WINDOW_A)
    flagged = out_of_bounds(baseline, serving_snapshot(spark, ws), config.X_COLS, ["state"])
    return rounded(flagged, {"lo": 6, "hi": 6})
