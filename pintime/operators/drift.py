"""Drift between two windows (DR-2..DR-6).

* Numeric features: two-sample Kolmogorov-Smirnov. Values are unpivoted and
  counted per (feature, value) with map-side partial aggregation; the running
  sums that give both empirical CDFs come from the two-level
  ``running_totals``, so no task holds a whole feature. Exact.
* Categorical columns and the binned target: chi-square on the
  side x category table, all categories of either side included.
* Online values outside a baseline's percentile range.

Nothing is rounded here: flags and bins compare exact values, callers round what
they show. A column without values on one side has a null statistic and p-value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pintime.functions.stats import chi2_sf, ks_pvalue
from pintime.operators.prefix import (exact_quantiles, materialize_counted, ranges_for,
                                      running_totals)


def require_rows(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise ValueError(f"window {name!r} has no rows")


def _long(df: DataFrame, features: Sequence[str], side: int) -> DataFrame:
    cast = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    return (cast.unpivot([], list(features), "feature", "value")
            .where(F.col("value").isNotNull() & ~F.isnan("value"))
            .withColumn("_side", F.lit(side)))


def _counted(a: DataFrame, b: DataFrame, features: Sequence[str]) -> tuple[DataFrame, int]:
    """``feature, value, na, nb`` per distinct value, written once, and its row count."""
    return materialize_counted(
        _long(a, features, 0).unionByName(_long(b, features, 1)).groupBy("feature", "value")
        .agg(F.count_if(F.col("_side") == 0).alias("na"),
             F.count_if(F.col("_side") == 1).alias("nb")), "ks_values")


def ks_test(a: DataFrame, b: DataFrame, features: Sequence[str],
            ranges: int | None = None) -> DataFrame:
    """``feature, statistic, p_value, n_a, n_b, mean_a, mean_b``. Running sums are
    spread over ``ranges`` value ranges (by default as many as the values need)."""
    return ks_of_counts(*_counted(a, b, features), ranges)


def ks_of_counts(counts: DataFrame, distinct: int, ranges: int | None = None) -> DataFrame:
    """``ks_test`` of values counted already: ``feature, value, na, nb``, one row per value and
    ``distinct`` rows in all."""
    cdf = running_totals(counts, ["feature"], "value", ["na", "nb"],
                         ranges or ranges_for(distinct))
    mean = lambda n: F.try_divide(F.sum(F.col("value") * F.col(n)), F.sum(n))
    totals = counts.groupBy("feature").agg(
        F.sum("na").alias("n_a"), F.sum("nb").alias("n_b"), mean("na").alias("mean_a"),
        mean("nb").alias("mean_b"))
    cdf = cdf.join(F.broadcast(totals), "feature")     # one row per feature
    gap = F.abs(F.try_divide("_cum_na", "n_a") - F.try_divide("_cum_nb", "n_b"))
    d = cdf.groupBy("feature", "n_a", "n_b", "mean_a", "mean_b").agg(F.max(gap).alias("_d"))
    lam = "_d * sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b))"
    return d.select("feature", F.col("_d").alias("statistic"), ks_pvalue(lam).alias("p_value"),
                    F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b"),
                    "mean_a", "mean_b")


def chi2_test(a: DataFrame, b: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """``feature, statistic, dof, p_value, n_a, n_b`` for one categorical
    column (nulls ignored)."""
    u = (a.select(F.col(col).cast("string").alias("_cat"), F.lit(0).alias("_side"))
         .unionByName(b.select(F.col(col).cast("string").alias("_cat"), F.lit(1).alias("_side")))
         .where(F.col("_cat").isNotNull()))
    return chi2_of_counts(u.groupBy("_cat").agg(
        F.count_if(F.col("_side") == 0).alias("oa"), F.count_if(F.col("_side") == 1).alias("ob")),
        name or col)


def chi2_of_counts(table: DataFrame, name: str) -> DataFrame:
    """``chi2_test`` of a table with one row per category: its counts ``oa`` and ``ob``."""
    # table totals as one scalar subquery: [n_a, n_b, number of categories]
    tot = table.agg(F.array(F.sum("oa"), F.sum("ob"), F.count(F.lit(1)))).scalar()
    cells = table.select("oa", "ob", tot[0].alias("n_a"), tot[1].alias("n_b"),
                         tot[2].alias("k"))
    ea = (F.col("oa") + F.col("ob")) * F.col("n_a") / (F.col("n_a") + F.col("n_b"))
    eb = (F.col("oa") + F.col("ob")) * F.col("n_b") / (F.col("n_a") + F.col("n_b"))
    term = (F.try_divide(F.pow(F.col("oa") - ea, 2), ea)
            + F.try_divide(F.pow(F.col("ob") - eb, 2), eb))     # null if a side is empty
    stat = cells.groupBy("n_a", "n_b", "k").agg(F.sum(term).alias("_x"))
    return stat.select(F.lit(name).alias("feature"),
                       F.col("_x").alias("statistic"),
                       (F.col("k") - 1).cast("long").alias("dof"),
                       chi2_sf("_x", "k - 1").alias("p_value"),
                       F.col("n_a").cast("long").alias("n_a"),
                       F.col("n_b").cast("long").alias("n_b"))


def decile_edges(baseline: DataFrame, col: str) -> DataFrame:
    """One row: the baseline's deciles of ``col`` (linear interpolation),
    computed by the distributed exact quantile."""
    q = exact_quantiles(baseline, col, [i / 10 for i in range(1, 10)])
    return q.select(F.col("_q").alias("_edges"))


def target_drift(a: DataFrame, b: DataFrame, target: str = "target") -> DataFrame:
    """Chi-square on the target cut at the baseline's deciles (raw counts are
    too sparse for a contingency table)."""
    edges = decile_edges(a, target).scalar()     # one array, a scalar subquery

    def binned(df):
        # bind the edges to a column first: lambdas cannot hold subqueries
        with_edges = df.select(F.col(target), edges.alias("_edges"))
        return with_edges.select(
            F.size(F.filter("_edges", lambda e: e < F.col(target).cast("double"))).alias("_bin"),
            F.col(target))
    return chi2_test(binned(a).where(F.col(target).isNotNull()),
                     binned(b).where(F.col(target).isNotNull()), "_bin", name=target)


def drift_report(a: DataFrame, b: DataFrame, numeric: Sequence[str],
                 categorical: Sequence[str], target: str | None = "target",
                 threshold: float = 0.05, share: float = 0.5) -> DataFrame:
    """One row per column: test, statistic, p-value, drifted flag, means and
    sizes, plus the share of drifted columns and the dataset verdict."""
    require_rows(a, "reference")
    require_rows(b, "current")
    chi2 = [chi2_test(a, b, c) for c in categorical]
    if target:
        chi2.append(target_drift(a, b, target))
    return verdict(ks_test(a, b, numeric), chi2, threshold, share)


def verdict(ks: DataFrame, chi2: Sequence[DataFrame], threshold: float = 0.05,
            share: float = 0.5) -> DataFrame:
    """The report of some tests: one row per column, and what all of them say."""
    rows = ks.select("feature", F.lit("ks").alias("test"), "statistic", "p_value", "n_a", "n_b",
                     "mean_a", "mean_b")
    for c in chi2:
        rows = rows.unionByName(c.select("feature", F.lit("chi2").alias("test"), "statistic",
                                         "p_value", "n_a", "n_b",
                                         F.lit(None).cast("double").alias("mean_a"),
                                         F.lit(None).cast("double").alias("mean_b")))
    rows = rows.withColumn("drifted", F.col("p_value") < F.lit(threshold))
    # one row per tested column (a bound fixed by the arguments), so a
    # whole-frame window is small
    share_col = F.avg(F.col("drifted").cast("double")).over(Window.partitionBy())
    return (rows.withColumn("share_drifted", share_col)
            .withColumn("dataset_drift", F.col("share_drifted") >= F.lit(share)))


def out_of_bounds(baseline: DataFrame, current: DataFrame, features: Sequence[str],
                  keys: Sequence[str], lo_q: float = 0.01, hi_q: float = 0.99) -> DataFrame:
    """``keys, feature, value, lo, hi, out_of_bounds``: each current value
    against the baseline's ``[lo_q, hi_q]`` percentile range of its feature."""
    bounds = (exact_quantiles(_long(baseline, features, 0), "value", [lo_q, hi_q], by=["feature"])
              .select("feature", F.col("_q")[0].alias("lo"), F.col("_q")[1].alias("hi")))
    cur = (current.select(*keys, *[F.col(f).cast("double").alias(f) for f in features])
           .unpivot(list(keys), list(features), "feature", "value"))
    flag = F.coalesce((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi")),
                      F.lit(False))
    # bounds: one row per feature, a proven-size broadcast
    return (cur.join(F.broadcast(bounds), "feature")
            .select(*keys, "feature", "value", "lo", "hi", flag.alias("out_of_bounds")))
