"""Point-in-time (as-of) join, JN-1 / JN-2.

For every entity row, each feature side contributes its newest row of the same
key whose time is at or before the entity time and no older than the side's
TTL (``entity_ts - ttl <= feature_ts <= entity_ts``). Unmatched entity rows keep
null features; every entity row appears exactly once, duplicates included.

Plan (no range join, no per-row fan-out):

1. A match depends only on (key, instant). So the entity rows' instants and the
   feature rows of *all* sides become one timeline with one row per key and
   instant, by an aggregation that is combined in every task first: a third of
   all rows being copies, or lying at one instant of one key, on either side,
   costs one row a task. Feature rows tied on time resolve to the greatest
   struct.
2. The timeline is cut into (key, time bucket) groups, so a hot key spreads over
   its buckets. With ``group_rows``, which retrieval gives where the rows are more than
   that in all, a group of more instants is cut further, at quantiles of its own
   instants, into ranges of about that many: however the rows of a key crowd together
   in time, no group holds more. The timeline is then written once, as it is read
   several times; the cuts are at most one value for every ``group_rows`` rows, which
   bounds their broadcast.
3. The newest feature of each group is carried to the later groups that hold
   entity instants (one row per key and bucket, and per range of a large group, in
   small windows) and injected there as an older row of the timeline.
4. A running ``last(struct, ignorenulls)`` in each group then gives every entity
   instant its newest feature row. Features travel as one struct, so a newest
   row's null feature stays null instead of being back-filled.
5. The entity rows join their instants by plain equality: nothing else of them
   was shuffled before, adaptive execution splits skewed partitions of this join,
   and a filter on a key of the result reaches both scans.
6. TTL is checked on the matched struct's own timestamp.

Null keys or times never match: such rows take no part in the timeline and keep
null features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pintime.config import ASOF_BUCKET_DAYS
from pintime.functions.time import day_bucket
from pintime.session import scratch_dir

#: Instants that one group of the timeline should hold, and into how many ranges a larger
#: group is cut at most.
GROUP_ROWS = 500_000
GRID = 1024


@dataclass
class AsofSide:
    """One feature side of an as-of join."""

    df: DataFrame
    ts: str
    features: Sequence[str]
    ttl: timedelta | None = None
    created: str | None = None          # optional tie-break among equal times
    names: Sequence[str] | None = field(default=None)  # output names (default: features)

    def out_names(self) -> list[str]:
        return list(self.names) if self.names is not None else list(self.features)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def asof_join(entity: DataFrame, sides: AsofSide | Sequence[AsofSide],
              keys: Sequence[str], entity_ts: str = "event_timestamp",
              bucket_days: int | None = ASOF_BUCKET_DAYS,
              group_rows: int | None = None) -> DataFrame:
    """Entity columns (in order) followed by each side's features (in order).

    ``bucket_days``: width of the time buckets (None: one bucket a key); ``group_rows``:
    instants that one group should hold (None: no group is known to hold too many). Any
    values give the same result.
    """
    if isinstance(sides, AsofSide):
        sides = [sides]
    keys = list(keys)
    ent_cols = list(entity.columns)
    missing = [c for c in [*keys, entity_ts] if c not in ent_cols]
    if missing:
        raise ValueError(f"entity rows lack columns {missing}")
    out_names = [n for s in sides for n in s.out_names()]
    clash = sorted({n for n in out_names if out_names.count(n) > 1} | (set(out_names) & set(ent_cols)))
    if clash:
        raise ValueError(f"feature names collide: {clash}")

    names = [f"_k{i}" for i in range(len(keys))]
    found = [f"_f{i}" for i in range(len(sides))]
    timeline = _timeline(entity, sides, keys, entity_ts, names, found, bucket_days)
    if group_rows is not None:
        timeline = _grouped(_written(timeline), names, found, group_rows)
    elif bucket_days:
        timeline = timeline.unionByName(_carried(timeline, names, found)).withColumn(
            "_s", F.lit(0))
    else:
        timeline = timeline.withColumn("_s", F.lit(0))
    running = (Window.partitionBy(*names, "_b", "_s").orderBy(F.col("_ts").asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    matches = timeline.select(
        *names, "_ts", "_e", *[F.last(f, ignorenulls=True).over(running).alias(f"_m{f}")
                               for f in found]).where("_e").drop("_e")
    same = [F.col(f"_entity.{k}") == F.col(n) for k, n in zip(keys, names, strict=True)]
    joined = entity.alias("_entity").join(
        matches, _all([*same, F.col(f"_entity.{entity_ts}") == F.col("_ts")]), "left")
    out = [F.col(f"_entity.{c}") for c in ent_cols]
    for f, s in zip(found, sides, strict=True):
        m = F.col(f"_m{f}")
        if s.ttl is not None:
            m = F.when(m["_t"] >= F.col("_ts") - F.lit(s.ttl), m)
        out += [m[c].alias(n) for c, n in zip(s.features, s.out_names(), strict=True)]
    return joined.select(*out)


def _timeline(entity: DataFrame, sides: Sequence[AsofSide], keys: list[str], entity_ts: str,
              names: list[str], found: list[str], bucket_days: int | None) -> DataFrame:
    """One row per key and instant: its bucket, its feature structs, whether entities need it."""
    def bucket(c: str) -> Column:
        return day_bucket(c, bucket_days) if bucket_days else F.lit(0).cast("long")

    def placed(df: DataFrame, ts: str, *cols: Column) -> DataFrame:
        valid = _all([F.col(k).isNotNull() for k in [*keys, ts]])
        return df.where(valid).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
                                      bucket(ts).alias("_b"), F.col(ts).alias("_ts"), *cols)

    frames = [placed(entity, entity_ts, F.lit(True).alias("_e"))]
    for f, s in zip(found, sides, strict=True):
        parts = [F.col(s.ts).alias("_t")]
        if s.created:
            parts.append(F.col(s.created).alias("_c"))
        parts += [F.col(c) for c in s.features]
        frames.append(placed(s.df, s.ts, F.lit(False).alias("_e"), F.struct(*parts).alias(f)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.groupBy(*names, "_b", "_ts").agg(
        F.max("_e").alias("_e"), *[F.max(f).alias(f) for f in found])


def _written(timeline: DataFrame) -> DataFrame:
    """The timeline in the shared scratch folder: what follows reads it several times."""
    spark = timeline.sparkSession
    path = scratch_dir(spark, "asof-timeline")
    timeline.write.parquet(path)
    return spark.read.schema(timeline.schema).parquet(path)


def _carried(timeline: DataFrame, names: list[str], found: list[str]) -> DataFrame:
    """Rows for the buckets with entity instants: the newest features of all earlier buckets.

    They have no time of their own, so they come first in their bucket. A struct begins
    with its time, so the greatest struct of a bucket is the newest.
    """
    newest = timeline.groupBy(*names, "_b").agg(
        F.max("_e").alias("_needed"), *[F.max(f).alias(f) for f in found])
    earlier = (Window.partitionBy(*names).orderBy("_b")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = newest.select(*names, "_b", "_needed", *_last(found, earlier)).where("_needed")
    no_time = F.lit(None).cast(timeline.schema["_ts"].dataType)
    return carried.select(*names, "_b", no_time.alias("_ts"), F.lit(False).alias("_e"), *found)


def _grouped(timeline: DataFrame, names: list[str], found: list[str],
             group_rows: int) -> DataFrame:
    """The timeline with each row's range ``_s`` of its bucket, and the carried rows: those
    hold the newest features of all earlier groups of their key."""
    group = [*names, "_b"]
    newest = timeline.groupBy(*group).agg(
        F.count("*").alias("_n"), F.max("_e").alias("_e"), *[F.max(f).alias(f) for f in found])
    earlier = (Window.partitionBy(*names).orderBy("_b")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = newest.select(*group, "_n", "_e", *_last(found, earlier)).where("_e")

    large = newest.where(F.col("_n") > group_rows).select(*group, "_n")
    edges = _edges(timeline, large, group, group_rows)
    place = F.coalesce(F.size(F.filter("_edges", lambda t: t < F.col("_ts"))), F.lit(0))
    ranged = timeline.join(F.broadcast(edges), group, "left").withColumn("_s", place)

    no_time = F.lit(None).cast(timeline.schema["_ts"].dataType).alias("_ts")
    row = [*group, "_s", no_time, F.lit(False).alias("_e"), *found]
    first = carried.withColumn("_s", F.lit(0)).where(F.col("_n") <= group_rows).select(*row)
    # large groups: what is carried into them comes before the newest of each range
    inside = ranged.where("_edges is not null").groupBy(*group, "_s").agg(
        F.max("_e").alias("_e"), *[F.max(f).alias(f) for f in found])
    before = carried.where(F.col("_n") > group_rows).select(
        *group, F.lit(-1).alias("_s"), F.lit(False).alias("_e"), *found)
    ranges = (Window.partitionBy(*group).orderBy("_s")
              .rowsBetween(Window.unboundedPreceding, -1))
    among = inside.unionByName(before).select(*group, "_s", "_e", *_last(found, ranges)).where(
        "_e").select(*row)
    return ranged.select(*group, "_s", "_ts", "_e", *found).unionByName(first).unionByName(among)


def _last(columns: list[str], window) -> list[Column]:
    return [F.last(c, ignorenulls=True).over(window).alias(c) for c in columns]


def _edges(timeline: DataFrame, large: DataFrame, group: list[str],
           group_rows: int) -> DataFrame:
    """Instants at which each large group is cut into ranges of about ``group_rows``: every
    so many of ``GRID`` quantiles of its instants."""
    rows = timeline.join(F.broadcast(large), group).select(*group, "_n", "_ts")
    quantiles = F.percentile_approx("_ts", [i / GRID for i in range(1, GRID)], 10 * GRID)
    cuts = F.least(F.lit(GRID), F.ceil(F.col("_n") / F.lit(group_rows)))
    chosen = F.transform(F.sequence(F.lit(1), cuts - 1), lambda i: F.element_at(
        F.col("_q"), (i * F.lit(GRID) / cuts).cast("int")))
    return rows.groupBy(*group, "_n").agg(quantiles.alias("_q")).select(
        *group, F.array_distinct(chosen).alias("_edges"))
