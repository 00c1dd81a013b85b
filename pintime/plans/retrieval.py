"""Historical retrieval (FS-6 with SRC-5 / SRC-6 entity inputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime import config
from pintime.definitions import FeatureService
from pintime.functions.time import ts_lit
from pintime.operators.asof import GROUP_ROWS, AsofSide, asof_join

#: Estimated distinct keys of the entity rows that are broadcast to the feature scans; at 20
#: percent of error and 100 bytes a key that is 12 MB.
FEW_KEYS = 100_000


def get_historical_features(spark: SparkSession, service: FeatureService,
                            entity_df: DataFrame | None = None,
                            entity_query: str | None = None,
                            event_timestamp: str = config.EVENT_TS,
                            ttl_override=None,
                            feature_time_range: tuple | None = None,
                            bucket_days: int | None = config.ASOF_BUCKET_DAYS,
                            few_keys: int = FEW_KEYS,
                            group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Entity rows + every service feature, point-in-time correct.

    Entity rows come from a frame or a SQL string over registered views. Views
    sharing the same join keys are joined in one pass.
    Only features from the oldest entity time less the view's TTL to the newest
    entity time can match; that range is pushed to the feature scans and prunes
    their periods. The same small aggregate over the entity rows estimates how many keys
    they have: where they are up to ``few_keys`` and at most half of a view's, only features
    of these keys go on (a broadcast of the distinct keys, before anything is shuffled). Pass
    ``feature_time_range=(lo, hi)`` when the bounds are known, ``few_keys=0`` when the
    entity rows are known to have most keys. Where entity and feature rows are more than
    ``group_rows`` in all (fewer can't crowd one group), the join cuts groups of more
    instants at quantiles; None: never.
    Errors are raised, not printed (Q7).
    """
    if entity_df is None and entity_query is None:
        raise ValueError("give entity_df or entity_query")
    entity = entity_df if entity_df is not None else spark.sql(entity_query)

    views = service.projections()
    key_sets = list(dict.fromkeys(tuple(p.view.join_keys) for p in views))
    if feature_time_range is None or few_keys or group_rows:
        seen = entity.agg(F.count("*").alias("rows"), F.min(event_timestamp).alias("oldest"),
                          F.max(event_timestamp).alias("newest"), *[
                              F.approx_count_distinct(F.struct(*keys), 0.05).alias(f"keys{i}")
                              for i, keys in enumerate(key_sets)]).first()
    few = {keys for i, keys in enumerate(key_sets) if few_keys and seen[f"keys{i}"] <= few_keys}
    groups: dict[tuple[str, ...], list[AsofSide]] = {}
    rows = seen["rows"] if group_rows else 0
    for proj in views:
        view, keys = proj.view, tuple(proj.view.join_keys)
        ts = view.source.timestamp_field
        ttl = ttl_override if ttl_override is not None else view.ttl
        if feature_time_range is not None:
            lo, hi = feature_time_range
        else:
            oldest, newest = seen["oldest"], seen["newest"]
            lo = ts_lit(oldest - ttl) if oldest is not None and ttl is not None else None
            hi = ts_lit(newest) if newest is not None else None
        fdf = view.to_df(spark, proj.features, time_range=(lo, hi))
        if keys in few or (group_rows and rows <= group_rows):
            has = fdf.agg(F.count("*").alias("rows"), F.approx_count_distinct(
                F.struct(*keys), 0.05).alias("keys")).first()
            rows += has["rows"]
            if keys in few and 2 * seen[f"keys{key_sets.index(keys)}"] <= has["keys"]:
                wanted = F.broadcast(entity.select(*keys).distinct())
                fdf = fdf.join(wanted, list(keys), "left_semi")
        side = AsofSide(df=fdf, ts=ts, features=proj.features, ttl=ttl,
                        created=view.source.created_timestamp_column)
        groups.setdefault(keys, []).append(side)

    out = entity
    for keys, sides in groups.items():
        out = asof_join(out, sides, keys, entity_ts=event_timestamp, bucket_days=bucket_days,
                        group_rows=group_rows if rows > (group_rows or 0) else None)
    return out
