"""Feature definitions (FS-1..FS-5, FS-10): entities, sources, views,
projections, services, and a registry that checks them against the data.

Definitions live in code; the registry only validates and names them. Sources
are tables or parquet paths, always read with their declared columns so the
scan is pruned to what the view needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintime.sources.periods import PeriodTable
from pintime.sources.versions import Files


@dataclass(frozen=True)
class Entity:
    """FS-1: a name plus its join-key columns."""

    name: str
    join_keys: tuple[str, ...]

    def __post_init__(self):
        if isinstance(self.join_keys, str):
            object.__setattr__(self, "join_keys", (self.join_keys,))
        else:
            object.__setattr__(self, "join_keys", tuple(self.join_keys))


@dataclass(frozen=True)
class Field:
    name: str
    dtype: T.DataType


@dataclass
class FeatureSource:
    """SRC-1: a table (catalog or temp view name) or a parquet path, with the
    name of its event-time column and, if it is partitioned by the year of its
    event time, of that partition column. ``versioned``: the path is that of a
    ``PeriodTable``, of which the current version is read."""

    name: str
    timestamp_field: str
    table: str | None = None
    path: str | None = None
    created_timestamp_column: str | None = None
    period: str | None = None
    versioned: bool = False

    def read(self, spark: SparkSession) -> DataFrame:
        if self.table is not None:
            return spark.table(self.table)
        if self.path is not None and self.versioned:
            return PeriodTable(spark, self.path).read("rows")
        if self.path is not None:
            return spark.read.parquet(self.path)
        raise ValueError(f"source {self.name} has neither table nor path")


@dataclass
class FeatureView:
    """FS-2: named, typed features of one source, keyed by entities, with a TTL."""

    name: str
    entities: Sequence[Entity]
    ttl: timedelta | None
    schema: Sequence[Field]
    source: FeatureSource

    @property
    def join_keys(self) -> list[str]:
        keys: list[str] = []
        for e in self.entities:
            keys += [k for k in e.join_keys if k not in keys]
        return keys

    @property
    def feature_names(self) -> list[str]:
        return [f.name for f in self.schema]

    def __getitem__(self, names: Sequence[str]) -> FeatureViewProjection:
        """FS-3: ``fv[["a", "b"]]``."""
        unknown = [n for n in names if n not in self.feature_names]
        if unknown:
            raise KeyError(f"{self.name} has no features {unknown}")
        return FeatureViewProjection(self, list(names))

    def projection(self) -> FeatureViewProjection:
        return FeatureViewProjection(self, self.feature_names)

    def to_df(self, spark: SparkSession, features: Sequence[str] | None = None,
              time_range: tuple[Column | None, Column | None] = (None, None)) -> DataFrame:
        """Keys, event time, (created time) and the declared features cast to
        their declared types, e.g. SQL doubles to ``float``. ``time_range`` bounds
        the event time, both ends included (None: open); a source that is
        partitioned by period then reads only the periods it needs."""
        feats = list(features) if features is not None else self.feature_names
        types = {f.name: f.dtype for f in self.schema}
        src = self.source
        cols = [F.col(k) for k in self.join_keys] + [F.col(src.timestamp_field)]
        if src.created_timestamp_column:
            cols.append(F.col(src.created_timestamp_column))
        cols += [F.col(n).cast(types[n]).alias(n) for n in feats]
        rows = src.read(spark)
        periods = src.period if src.period in rows.columns else None
        for bound, inside in zip(time_range, ("__ge__", "__le__"), strict=True):
            if bound is not None:
                rows = rows.where(getattr(F.col(src.timestamp_field), inside)(bound))
                if periods:
                    rows = rows.where(getattr(F.col(periods), inside)(F.year(bound)))
        return rows.select(*cols)


@dataclass
class FeatureViewProjection:
    view: FeatureView
    features: list[str]

    @property
    def name(self) -> str:
        return self.view.name


@dataclass
class FeatureService:
    """FS-4: an ordered list of (projected) views."""

    name: str
    features: Sequence[FeatureView | FeatureViewProjection]

    def projections(self) -> list[FeatureViewProjection]:
        return [f if isinstance(f, FeatureViewProjection) else f.projection()
                for f in self.features]

    def feature_names(self) -> list[str]:
        return [n for p in self.projections() for n in p.features]


@dataclass
class FeatureRepo:
    """FS-5 / FS-10: registers definitions after checking them against the
    source schemas (path sources also become temp views named after the
    source), looks services up by name, and tears tables and views down."""

    entities: dict[str, Entity] = field(default_factory=dict)
    views: dict[str, FeatureView] = field(default_factory=dict)
    services: dict[str, FeatureService] = field(default_factory=dict)
    registered: set[str] = field(default_factory=set)

    def apply(self, spark: SparkSession, objects: Sequence) -> FeatureRepo:
        for obj in objects:
            if isinstance(obj, Entity):
                self.entities[obj.name] = obj
            elif isinstance(obj, FeatureView):
                if obj.name in self.views and self.views[obj.name] is not obj:
                    raise ValueError(f"duplicate feature view name {obj.name!r}")
                self._check_view(spark, obj)
                if obj.source.path is not None and obj.source.table is None:
                    # expose path sources to SQL (entity queries) under the source name
                    obj.source.read(spark).createOrReplaceTempView(obj.source.name)
                    self.registered.add(obj.source.name)
                self.views[obj.name] = obj
            elif isinstance(obj, FeatureService):
                if obj.name in self.services and self.services[obj.name] is not obj:
                    raise ValueError(f"duplicate feature service name {obj.name!r}")
                for p in obj.projections():
                    if p.view.name not in self.views:
                        raise ValueError(f"service {obj.name} uses unregistered view {p.view.name}")
                self.services[obj.name] = obj
            else:
                raise TypeError(f"cannot register {type(obj).__name__}")
        return self

    @staticmethod
    def _check_view(spark: SparkSession, view: FeatureView) -> None:
        schema = view.source.read(spark).schema
        names = set(schema.names)
        need = [*view.join_keys, view.source.timestamp_field, *view.feature_names]
        lacking = [n for n in need if n not in names]
        if lacking:
            raise ValueError(f"view {view.name}: source lacks columns {lacking}")
        ts_type = schema[view.source.timestamp_field].dataType
        if not isinstance(ts_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            raise ValueError(f"view {view.name}: event time is {ts_type.simpleString()}")
        for f in view.schema:
            src_t = schema[f.name].dataType
            if not isinstance(src_t, T.NumericType) and isinstance(f.dtype, T.NumericType):
                raise ValueError(f"view {view.name}: {f.name} is {src_t.simpleString()}")

    def get_feature_service(self, name: str) -> FeatureService:
        try:
            return self.services[name]
        except KeyError:
            raise KeyError(f"no feature service {name!r}") from None

    def get_feature_view(self, name: str) -> FeatureView:
        return self.views[name]

    def teardown(self, spark: SparkSession, stored: bool = False) -> None:
        """Drop every registered source, by what it is: temp view, view or table;
        ``stored``: also delete the files of path sources."""
        if stored:
            for path in {v.source.path for v in self.views.values() if v.source.path}:
                Files(spark, path).delete(path)
        names = [v.source.table for v in self.views.values() if v.source.table]
        for name in [*names, *self.registered]:
            if not spark.catalog.tableExists(name):
                continue
            table = spark.catalog.getTable(name)
            if table.isTemporary:
                spark.catalog.dropTempView(name)
            else:
                kind = "VIEW" if table.tableType == "VIEW" else "TABLE"
                spark.sql(f"DROP {kind} IF EXISTS {name}")
        self.registered.clear()
        self.views.clear()
        self.services.clear()
        self.entities.clear()
