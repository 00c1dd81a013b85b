"""Tables kept by period, of which a run replaces only the periods it touched.

A table has named parts (feature rows, weekly cells, ...), each stored as
``<root>/<part>/attempt=<id>/period=<p>/``. A version of the table names, for every part
and period, the attempt that holds it. Writing a few periods therefore writes those
directories alone, and becomes visible, all parts together, with one commit to the
version log. Readers that hold a version keep reading its files until they are vacuumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintime.sources.versions import VersionLog

PERIOD = "period"


def period_of(ts: Column | str) -> Column:
    """The period of an event time: its year (0 for none)."""
    return F.coalesce(F.year(ts), F.lit(0))


@dataclass
class Version:
    number: int
    parts: dict[str, dict] = field(default_factory=dict)    # part: {schema, periods}

    def periods(self, part: str) -> dict[int, str]:
        held = self.parts.get(part, {"periods": {}})["periods"]
        return {int(p): a for p, a in held.items()}


class PeriodTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = VersionLog(spark, f"{self.root}/_versions")

    def current(self) -> Version | None:
        held = self.log.latest()
        return None if held is None else Version(held[0], held[1]["parts"])

    def read(self, part: str = "rows", periods: Collection[int] | None = None,
             version: Version | None = None) -> DataFrame:
        """A part's rows with their ``period``; of ``periods`` alone, if given: no other
        directory is listed or read."""
        version = version or self.current()
        if version is None or part not in version.parts:
            raise ValueError(f"{self.root} has no {part} yet")
        held = version.periods(part)
        return self._open(part, version.parts[part]["schema"], {
            p: a for p, a in held.items() if periods is None or p in periods})

    def _open(self, part: str, schema: str, held: dict[int, str]) -> DataFrame:
        columns = T.StructType.fromJson(json.loads(schema))
        if not held:
            return self.spark.createDataFrame([], columns)
        paths = [f"{self.root}/{part}/attempt={a}/{PERIOD}={p}" for p, a in sorted(held.items())]
        return (self.spark.read.option("basePath", f"{self.root}/{part}").schema(columns)
                .parquet(*paths).select(*columns.names))

    def stage(self, part: str, df: DataFrame) -> tuple[str, dict, DataFrame]:
        """Write rows (with a ``period`` column) under a new attempt that no version names
        yet: (part, its entry, the written rows). Rows of a period go to as many files as
        their size needs, not one from every task."""
        attempt = uuid.uuid4().hex[:16]
        df.hint("rebalance", PERIOD).write.partitionBy(PERIOD).parquet(
            f"{self.root}/{part}/attempt={attempt}")
        names = self.log.files.names(f"{self.root}/{part}/attempt={attempt}")
        held = {int(n.partition("=")[2]): attempt for n in names if n.startswith(f"{PERIOD}=")}
        entry = {"schema": df.schema.json(), "periods": held}
        return part, entry, self._open(part, entry["schema"], held)

    def commit(self, staged: list[tuple[str, dict, Collection[int] | None]],
               based_on: Version | None) -> Version:
        """One version in which each staged part replaces the given periods (None: all);
        a given period without rows is gone. Refused if ``based_on`` is no longer current."""
        parts = dict(based_on.parts) if based_on else {}
        for part, entry, periods in staged:
            kept = {} if periods is None or based_on is None else {
                p: a for p, a in based_on.periods(part).items() if p not in periods}
            parts[part] = {"schema": entry["schema"], "periods": kept | entry["periods"]}
        new = Version(1 if based_on is None else based_on.number + 1, parts)
        self.log.commit(new.number, {"parts": parts})
        return Version(new.number, json.loads(json.dumps(parts)))

    def vacuum(self, keep: int = 2) -> int:
        """Delete attempts that none of the last ``keep`` versions names (run it while no
        writer is at work); returns how many went."""
        named = set()
        for v in self.log.versions()[-keep:]:
            for part, entry in self.log.read(v)["parts"].items():
                named |= {(part, a) for a in entry["periods"].values()}
        gone = 0
        for part in self.log.files.names(self.root):
            for name in self.log.files.names(f"{self.root}/{part}"):
                if name.startswith("attempt=") and (part, name[8:]) not in named:
                    gone += self.log.files.delete(f"{self.root}/{part}/{name}")
        return gone

    def drop(self) -> None:
        self.log.files.delete(self.root)
