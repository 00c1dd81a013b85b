"""Training frames restricted to date windows (DR-1, SET-1, PRJ-4)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime import config
from pintime.functions.nulls import drop_any_null
from pintime.functions.time import ts_lit
from pintime.plans.retrieval import get_historical_features
from pintime.plans.workspace import Workspace


def _between(start: str, end: str) -> str:
    return f"date between to_timestamp_ntz('{start}') and to_timestamp_ntz('{end}')"


def window_entity_query(start: str, end: str, table: str = config.COUNT_TABLE) -> str:
    """FLT-4: both ends inclusive; the upper end is midnight of ``end``."""
    return f"select state, date as event_timestamp from {table} where {_between(start, end)}"


def _max_ttl(ws: Workspace):
    return max(v.ttl for v in (ws.trend, ws.counts))


def fetch_window(spark: SparkSession, ws: Workspace, start: str, end: str,
                 sort: bool = False) -> DataFrame:
    """Clean training rows of one window, tagged with the start year. The
    feature scan is bounded to ``[start - ttl, end]``, pushed to the source."""
    lo = datetime.fromisoformat(start) - _max_ttl(ws)
    d = get_historical_features(spark, ws.training,
                                entity_query=window_entity_query(start, end),
                                feature_time_range=(ts_lit(lo), ts_lit(end)))
    d = drop_any_null(d)
    if sort:
        d = d.orderBy(config.EVENT_TS, "state")
    return d.withColumn("year", F.lit(datetime.fromisoformat(start).year))


def fetch_windows(spark: SparkSession, ws: Workspace,
                  windows: Sequence[tuple[str, str]]) -> DataFrame:
    """Several windows stacked by name, duplicates kept, each row tagged with
    its window's start year: one point-in-time pass over the entity rows of
    all windows (a row in two overlapping windows appears twice)."""
    where = " or ".join(f"({_between(s, e)})" for s, e in windows)
    query = f"select state, date as event_timestamp from {config.COUNT_TABLE} where {where}"
    lo = min(datetime.fromisoformat(s) for s, _ in windows) - _max_ttl(ws)
    hi = max(e for _, e in windows)
    d = drop_any_null(get_historical_features(spark, ws.training, entity_query=query,
                                              feature_time_range=(ts_lit(lo), ts_lit(hi))))
    ts = F.col(config.EVENT_TS)
    tags = F.array_compact(F.array(*[
        F.when(ts.between(ts_lit(s), ts_lit(e)), F.lit(datetime.fromisoformat(s).year))
        for s, e in windows]))
    return d.withColumn("year", F.explode(tags))


def window_union(spark: SparkSession, ws: Workspace, target: str | None = None) -> DataFrame:
    """The two drift windows (SET-1), with the target copied into ``target``
    (PRJ-4) when asked."""
    u = fetch_windows(spark, ws, [config.DRIFT_WINDOW_A, config.DRIFT_WINDOW_B])
    if target:
        u = u.withColumn(target, F.col(config.Y_COL))
    return u


def split_windows(u: DataFrame) -> tuple[DataFrame, DataFrame]:
    ya = int(config.DRIFT_WINDOW_A[0][:4])
    yb = int(config.DRIFT_WINDOW_B[0][:4])
    return u.where(F.col("year") == ya), u.where(F.col("year") == yb)
