"""Whitening of embeddings over distinct vectors with multiplicities.

Vectors become whole numbers, ``floor(64 c) + 1,000,000`` an entry. Equal vectors are
grouped first (combined in every task, so a vector that a third of all rows share costs
a row a task); a group weighs its count in the fit, or one. The mean is exact: whole
sums over whole counts. The covariance is a weighted matrix product of the centred
distinct vectors, summed over tasks by rows of the matrix. Each distinct vector is
projected on the components once, and the rows get theirs by a join on the vector,
whose skewed partitions Spark splits.

What reaches the driver depends on the dimension alone: its sums, its covariance and
the components. A fit has ``FIT_TASKS`` tasks at most, so that the partial matrices
are bounded too; a task streams its vectors.

Defined results: rows whose vector is null or holds null or non-finite entries are left
out, and vectors of another length than the commonest (of equally common ones the
longest); null ids are kept and rows with the same id each give their own; entries are
held within 2^61 in size before they are whole, and a deviation that 64 bits don't hold
is null in ``deviation`` (``deviation_exact`` has 38 digits). Directions with less than
``LEAST_SHARE`` of the first component's variance can't be whitened in double precision
and are no components: constant vectors, a single row or an empty table have none and
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.llm.common import map_arrow, ship, table
from pintime.llm.components import written
from pintime.session import scratch_dir

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
FIT_TASKS = 2048
LEAST_SHARE = 1e-11
LARGEST = float(2**61)
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double, deviation_exact decimal(38,0)")


@dataclass(frozen=True)
class Fit:
    """Exact sums over ``n`` vectors, and the components by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray         # one column a component
    trace: float

    def centre(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The mean as whole parts and what is left of them, and ``sums - n * whole``."""
        whole = [round(Fraction(s, self.n)) for s in self.sums]
        rest = [s - self.n * w for s, w in zip(self.sums, whole, strict=True)]
        return (np.array(whole, np.int64), np.array([r / self.n for r in rest]), rest)


def whole_vectors(rows: DataFrame, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows with a whole vector."""
    given = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                        F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    within = lambda c: F.greatest(F.least(SCALE * c, F.lit(LARGEST)), F.lit(-LARGEST))
    return given.where(F.col("v").isNotNull() & finite).select("vec_id", F.transform(
        "v", lambda c: F.floor(within(c)).cast("long") + OFFSET).alias("x"))


def distinct_vectors(vectors: DataFrame, weights: str = "count") -> DataFrame:
    """(x, weight): each vector once, weighing its count or one."""
    if weights not in ("count", "one"):
        raise ValueError("weights must be 'count' or 'one'")
    counted = vectors.groupBy("x").agg(F.count("*").alias("weight"))
    return counted if weights == "count" else counted.withColumn("weight", F.lit(1).cast("long"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact_sums(vectors: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """The weights' sum and the weighted sum of every dimension, exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * dimension, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            w = batch.column(1).to_numpy()
            size = int(w.sum())
            if size * (float(np.abs(x).max(initial=0)) + 1) < 2.0**62:
                sums = (w @ x).tolist()
            else:
                sums = (w.astype(object) @ x.astype(object)).tolist()
            total = [a + b for a, b in zip(total, sums, strict=True)]
            n += size
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dimension), pa.int32()),
             pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))], ["i", "s"])

    parts = map_arrow(vectors.select("x", "weight"), run, "i int, s decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("s").alias("s")).collect()      # dimension + 1 rows
    sums = {r["i"]: int(r["s"]) for r in rows}
    return sums.get(-1, 0), [sums.get(i, 0) for i in range(dimension)]


def covariance(vectors: DataFrame, column: str, centre: tuple[np.ndarray, np.ndarray],
               n: int) -> np.ndarray:
    """Weighted covariance of ``column`` about ``centre`` (two parts, taken off one after
    the other), divisor ``n``."""
    size = len(centre[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                z = _matrix(batch.column(0)) - centre[0] - centre[1]
                total += (z * batch.column(1).to_numpy()[:, None]).T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            ["i", "row"])

    def add(group: pa.Table) -> pa.Table:
        rows = _matrix(group.column("row").combine_chunks())
        return pa.table({"i": group.column("i").slice(0, 1),
                         "row": pa.array([rows.sum(axis=0)], pa.list_(pa.float64()))})

    parts = map_arrow(vectors.select(column, "weight"), run, "i int, row array<double>")
    rows = parts.groupBy("i").applyInArrow(add, "i int, row array<double>").collect()
    out = np.zeros((size, size))
    for r in rows:
        out[r["i"]] = r["row"]
    return (out + out.T) / (2 * n)


def fit(vectors: DataFrame, dimension: int, components: int = COMPONENTS) -> Fit | None:
    """Mean and components of ``(x, weight)``, all of one length."""
    few = vectors.coalesce(FIT_TASKS)
    n, sums = exact_sums(few, dimension)
    none = np.zeros((dimension, 0))
    if not n or not dimension:
        return None
    whole, rest, _ = Fit(n, sums, np.zeros(0), none, 0.0).centre()
    v = covariance(few, "x", (whole, rest), n)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    kept = int((values > LEAST_SHARE * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    kept = min(kept, components)
    axes = axes[:, :kept]
    signs = np.sign(axes[np.argmax(np.abs(axes), axis=0), np.arange(kept)])
    return Fit(n, sums, values[:kept], axes * signs, float(np.trace(v)))


def project(vectors: DataFrame, model: Fit) -> DataFrame:
    """(x, weight, deviation, y): each distinct vector's exact deviation, and it whitened."""
    whole, rest, owed = model.centre()
    scaled = model.vectors / np.sqrt(model.values)
    n, far = model.n, max(map(abs, owed), default=0)
    owed_exact = np.array(owed, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            near = x - whole
            if x.shape[1] * (n * (float(np.abs(near).max()) + 1) + far) ** 2 < 2.0**62:
                deviation = ((n * near - owed_exact.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = ((n * near.astype(object) - owed_exact) ** 2).sum(axis=1).tolist()
            y = (near - rest) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([Decimal(d) if d < 10**38 else None for d in deviation],
                          pa.decimal128(38, 0)),
                 pa.array(list(y), pa.list_(pa.float64()))], ["x", "weight", "deviation", "y"])

    return map_arrow(vectors.select("x", "weight"), run,
                     "x array<long>, weight long, deviation decimal(38,0), y array<double>")


def identity_error(projected: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    k = len(model.values)
    few = projected.coalesce(FIT_TASKS)
    sums = few.agg(*[F.sum(F.col("weight") * F.col("y")[i]).alias(f"s{i}")
                     for i in range(k)]).first()
    mean = np.array([s / model.n for s in sums])
    off = covariance(few, "y", (mean, np.zeros(k)), model.n) - np.eye(k)
    return float(np.abs(off).max())


def whiten(rows: DataFrame, components: int = COMPONENTS, weights: str = "count",
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row and component: the fit's size, the vector's deviation, its whitened
    coordinate, the component's share of the variance, and the fit's identity error."""
    spark = rows.sparkSession
    ship(spark)
    folder = scratch_dir(spark, "whitening")
    vectors = whole_vectors(rows, id_col, vector_col)
    groups = written(distinct_vectors(vectors, weights), folder, "distinct")
    length = groups.groupBy(F.size("x").alias("d")).agg(F.sum("weight").alias("n")).orderBy(
        F.desc("n"), F.desc("d")).first()
    model = None
    if length is not None and length["d"] > 0:
        fitted = groups.where(F.size("x") == length["d"])
        model = fit(fitted, length["d"], components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], SCHEMA)
    whitened = written(project(fitted, model), folder, "whitened")
    error = identity_error(whitened, model)
    # the hash comes first in the sort, so that vectors are seldom compared entry by entry
    key = F.xxhash64("x").alias("h")
    joined = vectors.select("vec_id", key, "x").join(
        whitened.select(key, "x", "deviation", "y"), ["h", "x"])
    shares = F.lit((model.values / model.trace).tolist())
    fits = F.abs("deviation") <= F.lit(2**63 - 1).cast("decimal(38,0)")
    return joined.select("vec_id", "deviation", F.posexplode("y").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.when(fits, F.col("deviation").cast("long")).alias("deviation"), "whitened",
        F.get(shares, F.col("i")).alias("explained"),
        F.lit(error).alias("identity_error"), F.col("deviation").alias("deviation_exact"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
