"""Online store of the newest value per key (SNK-3, FS-7, FS-8, FS-9, JN-3).

A view's snapshot is a stack of layers: a base with one row per key, and deltas with one
row for each key that an increment touched. Publishing writes the increment alone as a
new layer and commits a version that names all layers; readers merge them (the newest
event time wins, of equal times the later layer). Past ``max_deltas`` deltas the layers
are merged into a new base, so a publish costs its increment and, spread over the
increments, a share of the base.

Layout under a shared root: ``<root>/<view>/layer=<id>/bucket=<b>/``, rows ``keys, event_ts,
features`` sorted by key in the bucket that the hash of their key names, and the version
log beside them. A lookup reads only the buckets of the requested keys. A run that dies
leaves a layer that no version names; of two publishers that read the same version the
second is refused (``VersionConflict``). The stored end never moves back.

A value older than the view's TTL is not served: relative to the end of the last publish,
or to the ``as_of`` that a lookup gives. Merging into a base leaves expired rows out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintime.definitions import FeatureService, FeatureView
from pintime.functions.time import ts_lit
from pintime.operators.latest import SNAPSHOT_TS, expire, latest_per_key
from pintime.sources.versions import VersionConflict, VersionLog

BUCKET = "bucket"
#: Buckets of a new view; large stores take more, so that a lookup reads a small share.
BUCKETS = 16
MAX_DELTAS = 8


@dataclass(frozen=True)
class Published:
    version: int
    end_ts: datetime
    layers: tuple[str, ...]     # base first, then deltas by age
    keys: tuple[str, ...]
    schema: str
    buckets: int
    ttl: timedelta | None

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def key_bucket(keys: Sequence[str], types: Sequence[T.DataType], buckets: int) -> Column:
    """The bucket of a key, whatever type the given columns have."""
    typed = [F.col(k).cast(t) for k, t in zip(keys, types, strict=True)]
    return F.pmod(F.xxhash64(*typed), F.lit(buckets)).cast("int")


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS,
                 max_deltas: int = MAX_DELTAS):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets, self.max_deltas = buckets, max_deltas

    def _log(self, view: str) -> VersionLog:
        return VersionLog(self.spark, f"{self.root}/{view}/_versions")

    def current(self, view: str) -> Published | None:
        held = self._log(view).latest()
        if held is None:
            return None
        e = held[1]
        return Published(held[0], datetime.fromisoformat(e["end_ts"]), tuple(e["layers"]),
                         tuple(e["keys"]), e["schema"], e["buckets"],
                         None if e["ttl"] is None else timedelta(seconds=e["ttl"]))

    def _layer(self, view: str, cur: Published, layer: str,
               buckets: Collection[int] | None) -> DataFrame:
        columns = T.StructType([*cur.columns.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(columns).parquet(f"{self.root}/{view}/layer={layer}")
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(sorted(buckets)))
        return rows.select(*cur.columns.names)

    def merged(self, view: str, cur: Published,
               buckets: Collection[int] | None = None) -> DataFrame:
        """Newest value per key over all layers, expired ones included."""
        layers = [self._layer(view, cur, n, buckets) for n in cur.layers]
        if not layers:
            return self.spark.createDataFrame([], cur.columns)
        if len(layers) == 1:
            return layers[0]        # a layer has one row per key
        features = [c for c in cur.columns.names if c not in (*cur.keys, SNAPSHOT_TS)]
        tagged = reduce(DataFrame.unionByName, [
            rows.withColumn("_layer", F.lit(i)) for i, rows in enumerate(layers)])
        best = tagged.groupBy(*cur.keys).agg(F.max(F.struct(
            F.col(SNAPSHOT_TS).alias("_t"), "_layer", *features)).alias("_n"))
        return best.select(*cur.keys, F.col("_n._t").alias(SNAPSHOT_TS),
                           *[F.col("_n")[f].alias(f) for f in features])

    def snapshot(self, view: str, as_of: datetime | None = None,
                 buckets: Collection[int] | None = None) -> DataFrame | None:
        """The newest value per key that is no older than the TTL at ``as_of`` (None: at the
        stored end), of all buckets or those given."""
        cur = self.current(view)
        if cur is None:
            return None
        rows = self.merged(view, cur, buckets)
        return rows if cur.ttl is None else expire(rows, ts_lit(as_of or cur.end_ts), cur.ttl)

    def _write(self, view: str, rows: DataFrame, keys: Sequence[str],
               buckets: int) -> list[str]:
        """Rows as a new layer that no version names yet; none if there are no rows."""
        layer = uuid.uuid4().hex[:16]
        path = f"{self.root}/{view}/layer={layer}"
        placed = rows.withColumn(BUCKET, key_bucket(
            keys, [rows.schema[k].dataType for k in keys], buckets))
        (placed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *keys)
         .write.partitionBy(BUCKET).parquet(path))
        written = any(n.startswith(f"{BUCKET}=") for n in self._log(view).files.names(path))
        return [layer] if written else []

    def _commit(self, view: str, entry: Published) -> Published:
        self._log(view).commit(entry.version, {
            "end_ts": entry.end_ts.isoformat(), "layers": list(entry.layers),
            "keys": list(entry.keys), "schema": entry.schema, "buckets": entry.buckets,
            "ttl": None if entry.ttl is None else entry.ttl.total_seconds()})
        return entry

    def publish(self, view: str, rows: DataFrame, keys: Sequence[str], end_ts: datetime,
                ttl: timedelta | None = None, based_on: Published | None = None,
                replace: bool = False) -> Published:
        """Add ``rows`` (keys, event time, features; one a key) on top of ``based_on``, the
        version the caller read, or in place of all its layers."""
        end_ts = end_ts if based_on is None else max(end_ts, based_on.end_ts)
        buckets = self.buckets if based_on is None else based_on.buckets
        below = () if based_on is None or replace else based_on.layers
        layers = (*below, *self._write(view, rows, keys, buckets))
        entry = Published(1 if based_on is None else based_on.version + 1, end_ts, layers,
                          tuple(keys), rows.schema.json(), buckets, ttl)
        if len(layers) > 1 + self.max_deltas:
            entry = self._compacted(view, entry)
        return self._commit(view, entry)

    def _compacted(self, view: str, entry: Published) -> Published:
        rows = self.merged(view, entry)
        if entry.ttl is not None:
            rows = expire(rows, ts_lit(entry.end_ts), entry.ttl)
        layers = tuple(self._write(view, rows, entry.keys, entry.buckets))
        return Published(entry.version, entry.end_ts, layers, entry.keys, entry.schema,
                         entry.buckets, entry.ttl)

    def compact(self, view: str) -> Published | None:
        """Merge all layers into one base, without the expired rows, as a new version."""
        cur = self.current(view)
        if cur is None:
            return None
        return self._commit(view, self._compacted(view, Published(
            cur.version + 1, cur.end_ts, cur.layers, cur.keys, cur.schema, cur.buckets, cur.ttl)))

    def vacuum(self, view: str, keep: int = 2) -> int:
        """Delete layers that none of the last ``keep`` versions names (run it while nobody
        publishes); returns how many went."""
        log = self._log(view)
        named = {n for v in log.versions()[-keep:] for n in log.read(v)["layers"]}
        gone = [n for n in log.files.names(f"{self.root}/{view}")
                if n.startswith("layer=") and n[6:] not in named]
        return sum(log.files.delete(f"{self.root}/{view}/{n}") for n in gone)

    def drop(self, view: str) -> None:
        """Delete a view's layers and versions."""
        self._log(view).files.delete(f"{self.root}/{view}")


def materialize_incremental(spark: SparkSession, store: SnapshotStore, view: FeatureView,
                            end_ts: datetime | None = None,
                            full_refresh: bool = False) -> DataFrame:
    """FS-7: rows with event time in (last end, end] (first run: from
    ``end - ttl``), newest per key, published as a layer over the last version.
    Returns the new snapshot."""
    end_ts = end_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    last = store.current(view.name)
    if last is not None and not full_refresh:
        end_ts = max(end_ts, last.end_ts)       # an earlier end adds nothing and moves nothing
    cur = None if full_refresh else last
    start = cur.end_ts if cur is not None else (end_ts - view.ttl if view.ttl else None)
    ts = view.source.timestamp_field
    src = view.to_df(spark, time_range=(None if start is None else ts_lit(start), ts_lit(end_ts)))
    if start is not None:
        src = src.where(F.col(ts) > ts_lit(start))
    inc = latest_per_key(src, view.join_keys, ts, view.feature_names,
                         created=view.source.created_timestamp_column)
    store.publish(view.name, inc, view.join_keys, end_ts, view.ttl, based_on=last,
                  replace=full_refresh)
    return store.snapshot(view.name)


def get_online_features(store: SnapshotStore, service: FeatureService, requests: DataFrame,
                        as_of: datetime | None = None) -> DataFrame:
    """JN-3: request rows, left-joined to each view's newest values, features in service
    order; an unknown key, or a value older than the TTL at ``as_of`` (None: the view's
    stored end), gives nulls.

    Only the buckets of the requested keys are read (one small job finds them), and of
    those the requested keys: the rows that go into the left join are at most the
    requests' distinct keys."""
    out, found = requests, {}
    for proj in service.projections():
        view = proj.view
        cur = store.current(view.name)
        if cur is None:
            types = {f.name: f.dtype for f in view.schema}
            out = out.select("*", *[F.lit(None).cast(types[f]).alias(f) for f in proj.features])
            continue
        keys = list(cur.keys)
        types = tuple(cur.columns[k].dataType for k in keys)
        place = (tuple(keys), types, cur.buckets)
        if place not in found:
            rows = requests.select(key_bucket(keys, types, cur.buckets).alias(BUCKET)).distinct()
            found[place] = {r[BUCKET] for r in rows.collect()}
        asked = requests.select(*[F.col(k).cast(t).alias(k) for k, t in zip(
            keys, types, strict=True)]).distinct()
        snap = store.snapshot(view.name, as_of, found[place]).join(asked, keys, "left_semi")
        out = out.join(snap.select(*keys, *proj.features), on=keys, how="left")
    return out.select(*requests.columns, *service.feature_names())


def latest_snapshot(view_df: DataFrame, view: FeatureView) -> DataFrame:
    """AGG-7 straight from a view frame, without the store."""
    return latest_per_key(view_df, view.join_keys, view.source.timestamp_field,
                          view.feature_names, created=view.source.created_timestamp_column)


__all__ = ["SNAPSHOT_TS", "SnapshotStore", "VersionConflict", "get_online_features",
           "latest_snapshot", "materialize_incremental"]
