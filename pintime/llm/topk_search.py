"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code is the signs of its components. Codes are dealt by their hash to
blocks of about ``BLOCK`` rows, queries to blocks of about ``QUERIES``, and every
pair of blocks meets in one task, so memory is bounded and nothing is broadcast. In
a task the codes are indexed by each of their 16-bit segments. A query probes all
segments at radius 0, then 1, and so on; codes it meets are verified by their full
Hamming distance. After radius r every code within ``segments * (r + 1) - 1`` bits
has been met (one of its segments differs by r bits at most), so the query ends as
soon as its k-th verified distance is covered, ties included.

Equal codes beyond the k + 1 least ids can't be among the k nearest (ties go to the
least id), so a vector that a third of all rows share is k + 1 rows. The blocks'
answers are merged by distance, then id.

Defined results: a vector is not its own neighbour; repeated (id, vector) rows are
one; null ids and null vectors take no part; a null component counts as not
positive; shorter vectors are filled up with zeros; fewer than k other vectors give
fewer rows.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pintime.llm.common import map_arrow, ship, table
from pintime.llm.components import written
from pintime.session import scratch_dir

TOP = 10
EVERY = 50          # the contract's queries: ids divisible by this
BLOCK, QUERIES = 50_000, 2_000
SEGMENT = 16
_ONES = np.array([bin(i).count("1") for i in range(1 << SEGMENT)], np.uint8)


@functools.lru_cache(maxsize=SEGMENT + 1)
def flips(radius: int) -> np.ndarray:
    """All segment values with ``radius`` ones."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(SEGMENT), radius)],
                    np.uint32)


def nearest(codes: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int,
            index: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """(distance, id) of the k nearest; ``index`` holds each segment's order and offsets."""
    met = np.zeros(len(codes), bool)
    found_at, found = [], []
    for radius in range(SEGMENT + 1):
        for segment, (order, offsets) in enumerate(index):
            value = query[segment] ^ flips(radius)
            lo, n = offsets[value], offsets[value + 1] - offsets[value]
            lo, n = lo[n > 0], n[n > 0]
            if not len(n):
                continue
            at = order[np.arange(n.sum()) + np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n)]
            at = at[~met[at]]
            met[at] = True
            found_at.append(at)
            found.append(_ONES[codes[at] ^ query].sum(axis=1, dtype=np.int64))
        at = np.concatenate(found_at) if found_at else np.zeros(0, np.int64)
        distance = np.concatenate(found) if found else np.zeros(0, np.int64)
        other = ids[at] != own
        if other.sum() >= k and np.partition(distance[other], k - 1)[k - 1] <= (
                len(index) * (radius + 1) - 1):
            break
    at, distance = at[other], distance[other]
    best = np.lexsort((ids[at], distance))[:k]
    return list(zip(distance[best].tolist(), ids[at[best]].tolist(), strict=True))


def index_of(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for segment in range(codes.shape[1]):
        values = codes[:, segment]
        order = np.argsort(values, kind="stable")
        out.append((order, np.searchsorted(values[order], np.arange((1 << SEGMENT) + 1))))
    return out


def _codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("v")).where(
        "id is not null and v is not null")
    width = rows.agg(F.max(F.size("v")).alias("w")).first()["w"] or 1
    size = -(-width // SEGMENT) * SEGMENT
    schema = pa.schema([("id", pa.int64()), ("code", pa.binary())])

    def run(batches):
        for b in batches:
            lists = b.column(1)
            bits = np.zeros((b.num_rows, size), bool)
            flat = np.nan_to_num(lists.flatten().to_numpy(zero_copy_only=False).astype(float))
            n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), n)
            bits[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat > 0
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in np.packbits(bits, axis=1)],
                                       pa.binary())], schema=schema)

    return map_arrow(rows, run, "id long, code binary")


def top_k(vectors: DataFrame, is_query, k: int = TOP, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, neighbor_id, distance``: the k nearest codes of every query.

    ``is_query``: condition on the column ``id``.
    """
    spark = vectors.sparkSession
    folder = scratch_dir(spark, "top-k")
    codes = written(_codes(vectors, id_col, vector_col).distinct(), folder, "codes")
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    base = codes.withColumn("_n", place).where(F.col("_n") <= k + 1).drop("_n")
    n_blocks = 8 + codes.count() // BLOCK
    n_query_blocks = 1 + codes.where(is_query).count() // QUERIES
    cell = lambda c, n: F.expr(f"int(pmod(xxhash64({c}), {n}))")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = base.withColumn("b", cell("code", n_blocks)).withColumn("q", every(n_query_blocks))
    right = codes.where(is_query).withColumn("q", cell("id", n_query_blocks)).withColumn(
        "b", every(n_blocks))

    def search(data: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if data.num_rows:
            segments = lambda t: np.frombuffer(
                b"".join(t.column("code").to_pylist()), np.uint16).reshape(t.num_rows, -1)
            stored, ids = segments(data), data.column("id").to_numpy()
            index = index_of(stored)
            for own, q in zip(queries.column("id").to_pylist(),
                              segments(queries) if queries.num_rows else [], strict=True):
                out += [(own, i, d) for d, i in nearest(stored, ids, q, own, k, index)]
        return pa.table({n: pa.array([r[i] for r in out], pa.int64())
                         for i, n in enumerate(("query_id", "neighbor_id", "distance"))})

    ship(spark)
    found = left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInArrow(
        search, "query_id long, neighbor_id long, distance long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "neighbor_id", "distance")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0)
