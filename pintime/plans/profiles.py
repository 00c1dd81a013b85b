"""Stored distribution profiles of the training rows, for drift reports that read no rows
(DR-1..DR-6).

For every month of event time and every column the profile holds counts per distinct value
(exact) and, for numeric columns, a KLL quantile sketch of a few kilobytes with the rows' count
and sum. Both merge, so a window of whole months is the union of its months' profiles. The
exact report does what the scan does, from counts; the sketched one reads one short row per
month and column. Profiles are kept by year in a ``PeriodTable``: a refresh rebuilds those
from the first touched year on, since a feature row can be the newest for later entity rows.
"""

from __future__ import annotations

import calendar
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime import config
from pintime.functions.nulls import drop_any_null
from pintime.functions.stats import ks_pvalue
from pintime.operators.drift import chi2_of_counts, ks_of_counts, verdict
from pintime.operators.prefix import materialize_counted, quantiles_of_counts
from pintime.plans.retrieval import get_historical_features
from pintime.plans.workspace import Workspace
from pintime.sources.periods import PERIOD, PeriodTable, Version, period_of

DECILES = [i / 10 for i in range(1, 10)]
#: Points of both distributions at which the sketched KS statistic compares them.
POINTS = [i / 400 for i in range(401)]


def month_of(ts: Column | str) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


@dataclass(frozen=True)
class Columns:
    numeric: Sequence[str] = tuple(config.X_COLS)
    categorical: Sequence[str] = (config.ENTITY_KEY,)
    target: str | None = config.Y_COL

    @property
    def counted(self) -> list[str]:
        return [*self.numeric, *([self.target] if self.target else [])]


class DriftProfiles:
    def __init__(self, spark: SparkSession, root: str, columns: Columns = Columns()):
        self.spark, self.columns = spark, columns
        self.table = PeriodTable(spark, root)

    def write(self, rows: DataFrame, periods: Collection[int] | None = None,
              ts: str = config.EVENT_TS) -> Version:
        """Profiles of ``rows``, in place of those of ``periods`` (None: of all)."""
        kept = self.table.current()
        at = [period_of(ts).alias(PERIOD), month_of(ts).alias("month")]
        numbers = rows.select(*at, *[F.col(c).cast("double").alias(c) for c in
                                     self.columns.counted]).unpivot(
            [PERIOD, "month"], self.columns.counted, "feature", "value").where(
            F.col("value").isNotNull() & ~F.isnan("value"))
        words = rows.select(*at, *[F.col(c).cast("string").alias(c) for c in
                                   self.columns.categorical]).unpivot(
            [PERIOD, "month"], list(self.columns.categorical), "feature", "category").where(
            "category is not null")
        of = [PERIOD, "month", "feature"]
        staged = [
            self.table.stage("values", numbers.groupBy(*of, "value").agg(F.count("*").alias("n"))),
            self.table.stage("categories",
                             words.groupBy(*of, "category").agg(F.count("*").alias("n"))),
            self.table.stage("sketches", numbers.groupBy(*of).agg(
                F.count("*").alias("n"), F.sum("value").alias("total"),
                F.kll_sketch_agg_double("value").alias("sketch")))]
        return self.table.commit([(*s[:2], periods) for s in staged], kept)

    def window(self, part: str, start: str, end: str) -> DataFrame:
        """A part's rows of the months from ``start`` to ``end``, first and last day."""
        a, b = date.fromisoformat(start), date.fromisoformat(end)
        if a.day != 1 or b.day != calendar.monthrange(b.year, b.month)[1] or a > b:
            raise ValueError(f"{start}..{end} is not a window of whole months")
        rows = self.table.read(part, range(a.year, b.year + 1))
        return rows.where(F.col("month").between(a.year * 100 + a.month, b.year * 100 + b.month))

    def _sides(self, part: str, value: str, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
        """``feature, <value>, na, nb`` over both windows."""
        tagged = self.window(part, *a).withColumn("_a", F.lit(True)).unionByName(
            self.window(part, *b).withColumn("_a", F.lit(False)))
        count = lambda side: F.coalesce(F.sum(F.when(F.col("_a") == side, F.col("n"))),
                                        F.lit(0))
        return tagged.groupBy("feature", value).agg(count(True).alias("na"),
                                                    count(False).alias("nb"))

    def report(self, a: tuple[str, str], b: tuple[str, str], sketched: bool = False,
               target_name: str = "target", threshold: float = 0.05,
               share: float = 0.5) -> DataFrame:
        """The drift report of window ``b`` against ``a`` from profiles alone; ``sketched``: KS
        and deciles from the sketches (to about a percent), else exact."""
        categories = self._sides("categories", "category", a, b)
        chi2 = [chi2_of_counts(categories.where(F.col("feature") == c).select(
            F.col("na").alias("oa"), F.col("nb").alias("ob")), c)
            for c in self.columns.categorical]
        ks, bins = self._sketched(a, b) if sketched else self._exact(a, b)
        if self.columns.target:
            chi2.append(chi2_of_counts(bins, target_name))
        out = verdict(ks, chi2, threshold, share)
        for side, (start, end) in (("n_a", a), ("n_b", b)):
            if self.window("sketches", start, end).isEmpty():
                raise ValueError(f"no rows for {side} in {start}..{end}")
        return out

    def _exact(self, a, b) -> tuple[DataFrame, DataFrame | None]:
        counts, distinct = materialize_counted(self._sides("values", "value", a, b), "profile")
        mine = counts.where(F.col("feature") != (self.columns.target or ""))
        ks = ks_of_counts(mine, distinct)
        if not self.columns.target:
            return ks, None
        target = counts.where(F.col("feature") == self.columns.target)
        base = target.where("na > 0").select(F.col("value").alias("_v"), F.col("na").alias("_n"))
        edges = quantiles_of_counts(base, distinct, DECILES).select("_q").scalar()
        # bind the edges to a column first: lambdas cannot hold subqueries
        placed = target.select("value", "na", "nb", edges.alias("_edges")).withColumn(
            "_cat", F.size(F.filter("_edges", lambda e: e < F.col("value"))))
        return ks, placed.groupBy("_cat").agg(F.sum("na").alias("oa"), F.sum("nb").alias("ob"))

    def _sketched(self, a, b) -> tuple[DataFrame, DataFrame | None]:
        def merged(window, side: str) -> DataFrame:
            return self.window("sketches", *window).groupBy("feature").agg(
                F.sum("n").alias(f"n_{side}"), F.sum("total").alias(f"total_{side}"),
                F.kll_merge_agg_double("sketch").alias(f"sketch_{side}"))

        both = merged(a, "a").join(merged(b, "b"), "feature", "full")
        points = F.array(*[F.lit(p) for p in POINTS])
        both = both.withColumns({f"_q{s}": F.kll_sketch_get_quantile_double(
            f"sketch_{s}", points) for s in "ab"})
        # the share of a distribution up to a value, from its quantiles
        rank = lambda s, v: F.size(F.filter(
            F.col(f"_q{s}"), lambda q: q <= v)) / F.lit(len(POINTS))
        whole = F.col("n_a").isNotNull() & F.col("n_b").isNotNull()
        gaps = both.withColumn("_d", F.when(whole, F.array_max(F.transform(
            F.array_distinct(F.concat("_qa", "_qb")), lambda v: F.abs(rank("a", v) - rank("b", v))))))
        lam = "_d * sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b))"
        ks = gaps.where(F.col("feature") != (self.columns.target or "")).select(
            "feature", F.col("_d").alias("statistic"), ks_pvalue(lam).alias("p_value"),
            *[F.coalesce(F.col(f"n_{s}"), F.lit(0)).alias(f"n_{s}") for s in "ab"],
            *[F.try_divide(f"total_{s}", f"n_{s}").alias(f"mean_{s}") for s in "ab"])
        if not self.columns.target:
            return ks, None
        deciles = F.kll_sketch_get_quantile_double("sketch_a", F.array(*map(F.lit, DECILES)))
        target = both.where((F.col("feature") == self.columns.target) & whole).withColumn(
            "_at", F.array_distinct(deciles))
        below = lambda s: F.concat(
            F.array(F.lit(0.0)), F.transform("_at", lambda v: rank(s, v)), F.array(F.lit(1.0)))
        cells = target.select("n_a", "n_b", below("a").alias("_a"), below("b").alias("_b")).select(
            "*", F.explode(F.sequence(F.lit(1), F.size("_a") - 1)).alias("_cat"))
        step = lambda s: F.round(F.col(f"n_{s}") * (
            F.get(f"_{s}", F.col("_cat")) - F.get(f"_{s}", F.col("_cat") - 1))).cast("long")
        bins = cells.select("_cat", step("a").alias("oa"), step("b").alias("ob"))
        return ks, bins.where("oa + ob > 0")


def profiled_rows(spark: SparkSession, ws: Workspace,
                  periods: Collection[int] | None = None) -> DataFrame:
    """Clean training rows of the entity rows of ``periods`` (None: of all)."""
    entity = ws.counts.source.read(spark)
    if periods is not None:
        entity = entity.where(F.col(PERIOD).isin(sorted(periods)))
    entity = entity.select(config.ENTITY_KEY, F.col("date").alias(config.EVENT_TS))
    return drop_any_null(get_historical_features(spark, ws.training, entity_df=entity))


def update_profiles(spark: SparkSession, ws: Workspace, profiles: DriftProfiles,
                    touched: Collection[int]) -> list[int]:
    """Rebuild the profiles that changed feature rows of the ``touched`` periods can reach;
    returns the periods that were rebuilt."""
    held = profiles.table.current()
    if held is None:
        profiles.write(profiled_rows(spark, ws))
        return sorted(profiles.table.current().periods("sketches"))
    if not touched:
        return []
    entity = ws.counts.source.read(spark).select(PERIOD).distinct().collect()
    known = {r[PERIOD] for r in entity} | set(held.periods("sketches"))
    reached = sorted(p for p in known if p >= min(touched))
    profiles.write(profiled_rows(spark, ws, reached), reached)
    return reached
