"""Feature tables kept up by the days that changed (FS-11, FS-12, FS-13).

A weekly feature row needs its own cell (the aggregate of one key and week) and the
neighbouring cells of its key, for lag and lead go by rows. So a table keeps three parts
by period: ``cells`` (unfiltered aggregates), ``edges`` (each key's first and last cell of
a period) and ``rows`` (the features). When raw days change,

1. the weeks they fall in are aggregated again from those weeks' raw days alone,
2. the periods of these weeks get new cells and edges,
3. where a key's first or last cell of such a period changed, its neighbouring row in the
   nearest other period of that key is touched too, which a join of the changed edges
   with the others tells,
4. the rows of the touched periods are built from their cells, with the edges of all
   other periods standing in for the cells there (each lies next to what it borders),
5. one commit replaces the touched periods of the three parts.

A run reads the raw days of the touched weeks, the cells of touched periods and one edge
row per key and period, and its result is that of a full build. Which days changed is
given by the caller, or found by ``marks``: a count and a hash sum of every raw day, kept
as a fourth part and compared with the raw table as it is now.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pintime.plans import features as feat
from pintime.operators.prefix import null_safe_join
from pintime.sources.periods import PERIOD, PeriodTable, Version, period_of


@dataclass(frozen=True)
class WeeklyFeatures:
    """How a weekly feature table comes from raw rows with a ``date``."""

    cells: Callable[[DataFrame], DataFrame]             # raw rows -> date, state, values
    rows: Callable[..., DataFrame]                      # cells, carried columns -> features
    label: Callable[[date], date]                       # raw day -> its cell's date
    span: timedelta                                     # raw days before the label in its cell
    looks_ahead: bool                                   # whether rows use the next cell


COUNTS = WeeklyFeatures(cells=lambda raw: feat.weekly_counts(raw).withColumnRenamed(
    "location", "state"), rows=feat.count_rows,
    label=lambda d: d + timedelta(days=-d.weekday() % 7), span=timedelta(days=6),
    looks_ahead=True)
TRENDS = WeeklyFeatures(cells=feat.trend_avg, rows=feat.trend_rows, label=lambda d: d,
                        span=timedelta(0), looks_ahead=False)


@dataclass(frozen=True)
class Update:
    version: Version | None
    days: int
    cell_periods: list[int]     # whose cells were built anew
    row_periods: list[int]      # whose rows were


def rebuild(table: PeriodTable, spec: WeeklyFeatures, raw: DataFrame) -> Update:
    """The whole table from the whole raw table."""
    held = table.current()
    cells = table.stage("cells", _by_period(spec.cells(raw)))
    edges = table.stage("edges", _edges(cells[2]))
    rows = table.stage("rows", _rows(spec, cells[2], None))
    marks = table.stage("marks", day_marks(raw))
    version = table.commit([(*p[:2], None) for p in (cells, edges, rows, marks)], held)
    periods = sorted(cells[1]["periods"])
    return Update(version, 0, periods, periods)


def day_marks(raw: DataFrame) -> DataFrame:
    """``date, n, h``: how many rows each raw day has, and the sum of their hashes."""
    hashed = F.xxhash64(*sorted(raw.columns)).cast("decimal(38,0)")
    return raw.groupBy("date").agg(F.count("*").alias("n"), F.sum(hashed).alias("h")).withColumn(
        PERIOD, F.lit(0))


def changed_days(table: PeriodTable, raw: DataFrame) -> list[date]:
    """Days whose rows are not those of the last run; one scan and one row a day."""
    now = day_marks(raw).select("date", F.col("n").alias("n2"), F.col("h").alias("h2"))
    both = null_safe_join(table.read("marks"), now, ["date"], "full")
    kept = F.col("n").eqNullSafe(F.col("n2")) & F.col("h").eqNullSafe(F.col("h2"))
    gone = null_safe_join(now, table.read("marks"), ["date"], "left_anti")
    days = both.where(~kept).select("date").union(gone.select("date")).distinct().collect()
    return [r["date"] for r in days if r["date"] is not None]


def update(table: PeriodTable, spec: WeeklyFeatures, raw: DataFrame,
           days: Iterable[date] | None = None) -> Update:
    """Bring the table up to ``raw``, of which ``days`` changed (None: found by marks)."""
    held = table.current()
    if held is None:
        return rebuild(table, spec, raw)
    days = sorted(set(changed_days(table, raw) if days is None else days))
    if not days:
        return Update(held, 0, [], [])
    labels = sorted({spec.label(d) for d in days})
    touched = sorted({d.year for d in labels})
    weeks = [(d - spec.span, d) for d in labels]
    fresh = _by_period(spec.cells(raw.where(_within("date", weeks))))
    stay = table.read("cells", touched, held).where(_outside("date", [(d, d) for d in labels]))
    cells = table.stage("cells", stay.unionByName(fresh))
    edges = table.stage("edges", _edges(cells[2]))
    others = [p for p in held.periods("edges") if p not in touched]
    far = table.read("edges", others, held)
    more = _bordering(table.read("edges", touched, held), edges[2], far, spec.looks_ahead)
    all_cells = cells[2].unionByName(table.read("cells", more, held))
    rows = table.stage("rows", _rows(spec, all_cells, far.where(~F.col(PERIOD).isin(more))
                                     if more else far))
    each = [(d, d) for d in days]
    marks = table.stage("marks", table.read("marks", version=held).where(
        _outside("date", each)).unionByName(day_marks(raw.where(_within("date", each)))))
    row_periods = sorted({*touched, *more})
    version = table.commit([(*cells[:2], touched), (*edges[:2], touched),
                            (*rows[:2], row_periods), (*marks[:2], None)], held)
    return Update(version, len(days), touched, row_periods)


def _by_period(cells: DataFrame) -> DataFrame:
    return cells.withColumn(PERIOD, period_of("date"))


def _within(column: str, ranges: Sequence[tuple[date, date]]) -> Column:
    """Whether a date lies in one of the sorted ranges; ranges that touch are one."""
    merged: list[tuple[date, date]] = []
    for a, b in ranges:
        if merged and a <= merged[-1][1] + timedelta(days=1):
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    days = [a for a, b in merged if a == b]
    some = [F.col(column).between(F.lit(a), F.lit(b)) for a, b in merged if a < b]
    if days:
        some.append(F.col(column).isin(days))
    while len(some) > 1:        # a balanced tree, however many ranges there are
        some = [x | y for x, y in zip(some[::2], some[1::2], strict=False)] + (
            some[-1:] if len(some) % 2 else [])
    return some[0]


def _outside(column: str, ranges: Sequence[tuple[date, date]]) -> Column:
    return ~F.coalesce(_within(column, ranges), F.lit(False))


def _values(cells: DataFrame) -> list[str]:
    return [c for c in cells.columns if c not in ("date", "state", PERIOD)]


def _edges(cells: DataFrame) -> DataFrame:
    """Each key's first and last cell of every period (a struct begins with its date)."""
    cell = F.struct("date", *_values(cells))
    return cells.groupBy("state", PERIOD).agg(F.min(cell).alias("first"),
                                              F.max(cell).alias("last"))


def _bordering(before: DataFrame, after: DataFrame, others: DataFrame,
               looks_ahead: bool) -> list[int]:
    """Other periods with a row whose neighbour in a touched period changed."""
    key = ["state", PERIOD]
    old = before.select(*key, F.col("first").alias("f1"), F.col("last").alias("l1"))
    new = after.select(*key, F.col("first").alias("f2"), F.col("last").alias("l2"))
    both = old.unionByName(new, allowMissingColumns=True).groupBy(*key).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("f1", "l1", "f2", "l2")])
    changed = both.select("state", F.col(PERIOD).alias("at"),
                          (~F.col("f1").eqNullSafe(F.col("f2"))).alias("first"),
                          (~F.col("l1").eqNullSafe(F.col("l2"))).alias("last")).where(
        F.col("last") | (F.col("first") if looks_ahead else F.lit(False)))
    pairs = null_safe_join(others.select("state", PERIOD), changed, ["state"])
    ahead = F.min(F.when(F.col("last") & (F.col(PERIOD) > F.col("at")), F.col(PERIOD)))
    behind = F.max(F.when(F.col("first") & (F.col(PERIOD) < F.col("at")), F.col(PERIOD)))
    found = pairs.groupBy("state", "at").agg(
        ahead.alias("ahead"), (behind if looks_ahead else F.max(F.lit(None).cast("int")))
        .alias("behind")).select(F.explode(F.array("ahead", "behind")).alias("p"))
    return sorted(r["p"] for r in found.where("p is not null").distinct().collect())


def _rows(spec: WeeklyFeatures, cells: DataFrame, edges: DataFrame | None) -> DataFrame:
    """Feature rows of ``cells``, with the cells of ``edges`` as neighbours only."""
    line = cells.withColumn("_own", F.lit(True))
    if edges is not None:
        ends = edges.select("state", PERIOD, F.explode(F.array_distinct(
            F.array("first", "last"))).alias("_c")).select(
            "state", PERIOD, "_c.*", F.lit(False).alias("_own"))
        line = line.unionByName(ends)
    return spec.rows(line, PERIOD, "_own").where("_own").drop("_own")
