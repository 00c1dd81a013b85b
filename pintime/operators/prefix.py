"""Running totals and exact quantiles without a single-task group.

``running_totals`` computes inclusive running sums over distinct sorted values
in two levels: values are cut into ranges at approximate quantiles, each range
sums locally in its own task, and a small table of the ranges' totals supplies
what lies before. The sums are exact; the number of ranges follows the number
of distinct values, so no task gets more than about ``RANGE_ROWS`` of them.
Joins match null groups too.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from pintime.session import ensure_checkpoint_dir

#: Distinct values that one range should hold; it sets the number of tasks only.
RANGE_ROWS = 500_000


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which a null key matches a null key."""
    named = right.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c)
                           for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return left.join(named, reduce(lambda a, b: a & b, same), how).drop(
        *[f"_on_{c}" for c in on])


def attach(big: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add ``small``'s columns to ``big``: by its groups, or, for one global row, as
    scalar subqueries."""
    if not on:
        return big.select("*", *[small.select(c).scalar().alias(c) for c in small.columns])
    return null_safe_join(big, small, on)


def running_totals(df: DataFrame, part: Sequence[str], order: str, cols: Sequence[str],
                   ranges: int) -> DataFrame:
    """``df`` (one row per ``part`` + ``order`` value) plus ``_cum_<c>`` for
    every ``c`` in ``cols``: the inclusive running sum in ``order``, worked out in
    ``ranges`` ranges of each group."""
    part = list(part)
    cuts = [i / ranges for i in range(1, ranges)] or [0.5]
    edges = df.groupBy(*part).agg(F.percentile_approx(order, cuts, 10000).alias("_edges"))
    df = (attach(df, edges, part)
          .withColumn("_bk", F.size(F.filter("_edges", lambda e: e < F.col(order))))
          .drop("_edges"))
    local_w = (Window.partitionBy(*part, "_bk").orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.select("*", *[F.sum(c).over(local_w).alias(f"_loc_{c}") for c in cols])
    per_range = df.groupBy(*part, "_bk").agg(*[F.sum(c).alias(f"_tot_{c}") for c in cols])
    before = (Window.partitionBy(*part).orderBy("_bk")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_range.select(*part, "_bk", *[
        F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in cols])
    out = null_safe_join(local, offsets, [*part, "_bk"])
    return out.select(*[c for c in local.columns if not c.startswith("_loc_") and c != "_bk"],
                      *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"_cum_{c}")
                        for c in cols])


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Checkpoint ``df`` (reliable, under ``spark.checkpoint.dir``) and return
    it with its row count, observed during the same job."""
    ensure_checkpoint_dir(df.sparkSession)
    obs = Observation(label)
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")).checkpoint()
    return out, int(obs.get.get("rows") or 0)


def ranges_for(rows: int) -> int:
    return 1 + rows // RANGE_ROWS


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``by..., _q``: array of exact quantiles of ``col`` per group (a null group
    included), linear interpolation between the order statistics at
    ``p * (n - 1)`` (pandas / ``quantile_cont``); null and NaN values don't count.

    Values are counted per distinct value and written once; the order statistics
    are then read off the running totals, in ``ranges`` ranges (by default as many
    as the distinct values need)."""
    by = list(by)
    x = F.col(col).cast("double")
    counts, distinct = materialize_counted(
        df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*by, x.alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n")), "quantile_values")
    return quantiles_of_counts(counts, distinct, probs, by, ranges)


def quantiles_of_counts(counts: DataFrame, distinct: int, probs: Sequence[float],
                        by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``exact_quantiles`` of values that are counted already: ``by..., _v, _n``, one row per
    distinct value, ``distinct`` rows in all."""
    by = list(by)
    cum = running_totals(counts, by, "_v", ["_n"], ranges or ranges_for(distinct))
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_total"))
    cum = attach(cum, totals, by)
    # 0-based ranks each quantile needs: floor and ceil of p * (n - 1)
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("side"),
                               (F.floor if j == 0 else F.ceil)(
                                   F.lit(p) * (F.col("_total") - 1)).alias("r"))
                      for i, p in enumerate(probs) for j in (0, 1)])
    first = F.col("_cum__n") - F.col("_n")      # rank of this value's first copy
    hits = (cum.select(*by, "_v", "_total", F.explode(F.filter(
        ranks, lambda s: (s["r"] >= first) & (s["r"] < F.col("_cum__n")))).alias("_h")))
    picked = hits.groupBy(*by, "_total").agg(*[
        F.max(F.when((F.col("_h.i") == i) & (F.col("_h.side") == j), F.col("_v")))
        .alias(f"_{i}_{j}") for i in range(len(probs)) for j in (0, 1)])
    qs = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_total") - 1)
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_{i}_0"), F.col(f"_{i}_1")
        qs.append(lo + (hi - lo) * frac)
    return picked.select(*by, F.array(*qs).alias("_q"))
