"""Exploration aggregates: summary statistics (AGG-6), histogram (AGG-8),
feature-target correlation (AGG-9), head/tail (SRT-2), stage counts (AGG-4/5).

All are hash aggregations with map-side partial results; exact quantiles use
the distributed rank search of ``prefix.exact_quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pintime.operators.prefix import exact_quantiles, null_safe_join


def number(col: str) -> Column:
    """The column as a double, NaN as null (as pandas skips it)."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def describe(df: DataFrame, col: str, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """pandas ``describe()``: count, mean, sample std, min, quartiles
    (linear interpolation), max, of a null group too. ``df.summary()`` is not used:
    its quartiles are nearest-rank. ``approx=True`` uses ``percentile_approx``
    instead of the distributed exact quantile."""
    x = number(col)
    aggs = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max")]
    if approx:
        aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).alias("_q"))
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    if not approx:
        # exact quartiles without gathering a group's values in one task
        q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by=by)
        g = (null_safe_join(g, q, list(by), "left") if by
             else g.withColumn("_q", q.select("_q").scalar()))
    return g.select(*by, "count", "mean", "std", "min", F.col("_q")[0].alias("p25"),
                    F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"), "max")


def histogram(df: DataFrame, cols: Sequence[str], by: str, bins: int = 10) -> DataFrame:
    """``by, feature, bin, lo, hi, n``: equal-width bins over the global min..max of
    each column; the maximum falls in the last bin. All columns in one pass; the
    bounds are one scalar subquery. Null and NaN values don't count."""
    bounds = df.agg(F.array(*[F.array(F.min(number(c)), F.max(number(c))) for c in cols])).scalar()
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), number(c).alias("x"),
                                 bounds[i][0].alias("lo"), bounds[i][1].alias("hi"))
                        for i, c in enumerate(cols)])
    long = df.select(by, F.inline(entries)).where("x is not null")
    width = F.col("hi") - F.col("lo")
    raw = F.floor((F.col("x") - F.col("lo")) / width * F.lit(bins))
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    edge = lambda k: F.col("lo") + (F.col("hi") - F.col("lo")) / F.lit(bins) * k
    return (long.select(by, "feature", b.alias("bin"), "lo", "hi")
            .groupBy(by, "feature", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
            .select(by, "feature", "bin", edge(F.col("bin")).alias("lo"),
                    edge(F.col("bin") + 1).alias("hi"), "n"))


def correlations(df: DataFrame, features: Sequence[str], target: str,
                 by: str | None = None) -> DataFrame:
    """``[by, overall,] feature, corr, n``: Pearson correlation of each feature with
    the target, overall and per group, in one pass (grouping sets). ``overall`` tells
    the row over all groups from that of a null group."""
    y = number(target)
    aggs = [F.struct(F.lit(f).alias("feature"), F.corr(number(f), y).alias("corr"),
                     F.count(F.when(number(f).isNotNull() & y.isNotNull(), 1)).alias("n"))
            .alias(f"_{i}") for i, f in enumerate(features)]
    arr = F.inline(F.array(*[F.col(f"_{i}") for i in range(len(features))]))
    if by is None:
        return df.agg(*aggs).select(arr)
    sets = df.groupingSets([[], [F.col(by)]], F.col(by)).agg(
        (F.grouping(by) == 1).alias("overall"), *aggs)
    return sets.select(by, "overall", arr)


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in order (a top-k plan, no full sort)."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """Last ``n`` rows in order: descending top-k, re-sorted ascending."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


@dataclass(frozen=True)
class Stage:
    """A step of a job over the same raw rows: the rows it keeps, the key it counts and, if
    it aggregates, what it groups the kept rows by."""

    name: str
    keep: Column
    key: Column
    group: Sequence[Column] = ()


def _measured(rows: DataFrame, stages: Sequence[Stage], *carry: str) -> DataFrame:
    """Per stage the key (null where the row is not kept), whether it is kept, its group."""
    cols = []
    for i, s in enumerate(stages):
        kept = F.coalesce(s.keep, F.lit(False))
        cols += [kept.alias(f"_f{i}"), F.when(kept, s.key).alias(f"_k{i}")]
        if s.group:
            cols.append(F.when(kept, F.struct(*s.group)).alias(f"_g{i}"))
    return rows.select(*carry, *cols)


def _as_rows(one: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    entries = [F.struct(F.lit(s.name).alias("stage"), F.col(f"_n{i}").alias("n_rows"),
                        F.col(f"_d{i}").alias("n_keys")) for i, s in enumerate(stages)]
    return one.select(F.inline(F.array(*entries)))


def stage_counts(rows: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    """AGG-4, AGG-5: ``stage, n_rows, n_keys`` (rows or groups, and distinct non-null keys) of
    all stages, exact, in one scan: rows that no stage tells apart are counted together in
    every task first, and only what is left meets the distinct counts."""
    measured = _measured(rows, stages)
    cells = measured.groupBy(*measured.columns).agg(F.count("*").alias("_n"))
    aggs = []
    for i, s in enumerate(stages):
        size = (F.count_distinct(F.when(F.col(f"_f{i}"), F.struct(f"_g{i}"))) if s.group
                else F.coalesce(F.sum(F.when(F.col(f"_f{i}"), F.col("_n"))), F.lit(0)))
        aggs += [size.alias(f"_n{i}"), F.count_distinct(f"_k{i}").alias(f"_d{i}")]
    return _as_rows(cells.agg(*aggs), stages)


def stage_marks(rows: DataFrame, stages: Sequence[Stage], day: str) -> DataFrame:
    """What a run stores: per day of its rows, every stage's row count and HyperLogLog sketches
    of its keys and groups. One aggregate over one scan."""
    aggs = []
    for i, s in enumerate(stages):
        aggs += [F.count_if(f"_f{i}").alias(f"_n{i}"),
                 F.hll_sketch_agg(F.col(f"_k{i}").cast("string")).alias(f"_keys{i}")]
        if s.group:
            aggs.append(F.hll_sketch_agg(F.to_json(f"_g{i}")).alias(f"_groups{i}"))
    return _measured(rows, stages, day).groupBy(day).agg(*aggs)


def merged_stage_counts(marks: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    """``stage, n_rows, n_keys`` of any days' ``stage_marks``: rows exact, keys and groups
    estimated (to about 1.6 percent) from the merged sketches."""
    aggs = []
    for i, s in enumerate(stages):
        size = (F.hll_sketch_estimate(F.hll_union_agg(f"_groups{i}")) if s.group
                else F.coalesce(F.sum(f"_n{i}"), F.lit(0)))
        aggs += [size.alias(f"_n{i}"),
                 F.hll_sketch_estimate(F.hll_union_agg(f"_keys{i}")).alias(f"_d{i}")]
    return _as_rows(marks.agg(*aggs), stages)
