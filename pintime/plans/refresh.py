"""The daily refresh job (FS-11): bring both feature tables up to the raw tables, then
publish newest values incrementally.

The first run builds everything; later ones rebuild only the periods that the changed raw
days touch (``plans.maintenance``), unless ``full_refresh`` is set. A table changes by one
commit, so a run that dies leaves the last version, and a rerun repeats cleanly; the
snapshot store only moves forward."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pintime.plans.maintenance import COUNTS, TRENDS, rebuild, update
from pintime.plans.online import SnapshotStore, materialize_incremental
from pintime.plans.profiles import DriftProfiles, update_profiles
from pintime.plans.repo import build_repo, count_view, trend_view
from pintime.plans.workspace import Workspace
from pintime.sources.periods import PeriodTable
from pintime.sources.tables import daily_counts, trend_points

log = logging.getLogger(__name__)


def refresh(spark: SparkSession, sf_dir: str, root: str,
            end_ts: datetime | None = None, full_refresh: bool = False,
            changed_days: Iterable[date] | None = None,
            profiles: bool = False) -> tuple[SnapshotStore, Workspace]:
    """Counts first, then trends, then publish (the reference's order), then, if asked, the
    drift profiles of the periods that changed.

    ``changed_days``: raw days that are new, late, corrected or gone since the last run
    (None: found by comparing the raw tables with the marks of the last run).
    ``end_ts`` defaults to the newest event time in each table (an explicit
    end makes reruns repeatable; FN-7)."""
    root = root.rstrip("/")
    counts_path, trend_path = f"{root}/tables/counts", f"{root}/tables/trends"
    touched: set[int] = set()
    for path, spec, raw in ((counts_path, COUNTS, daily_counts(spark, sf_dir)),
                            (trend_path, TRENDS, trend_points(spark, sf_dir))):
        table = PeriodTable(spark, path)
        done = (rebuild(table, spec, raw) if full_refresh
                else update(table, spec, raw, changed_days))
        touched |= set(done.row_periods)
        log.info("%s: version %s, %d changed days, rows of periods %s written", path,
                 done.version and done.version.number, done.days, done.row_periods)
    trend = trend_view(path=trend_path, versioned=True)
    counts = count_view(path=counts_path, versioned=True)
    repo = build_repo(spark, trend, counts)
    store = SnapshotStore(spark, f"{root}/online")
    for view in (counts, trend):
        end = end_ts or view.source.read(spark).agg(F.max("date").alias("m")).first()["m"]
        if end is not None:
            materialize_incremental(spark, store, view, end_ts=end, full_refresh=full_refresh)
    ws = Workspace(spark, sf_dir, repo)
    if profiles:
        done = update_profiles(spark, ws, DriftProfiles(spark, f"{root}/profiles"), touched)
        log.info("profiles of periods %s written", done)
    return store, ws
