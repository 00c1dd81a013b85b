"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes its set of distinct 5-word shingles (64-bit hashes) and a
   signature of ``HASHES`` minima; texts with the same words are one class with
   its least doc_id as representative, so exact copies, however many, are one row.
2. ``BANDS`` bands of ``ROWS`` minima put representatives into buckets. A pair at
   the threshold shares no bucket with probability (1 - 0.85^5)^25 = 4e-7.
3. Buckets of up to ``SMALL`` rows give their pairs (at most ``SMALL / 2`` a row).
   Larger ones are cut into blocks of about ``BLOCK`` rows, and every two blocks
   meet in a task of their own, which holds two blocks at most and returns only
   the links that join different components; all pairs are looked at, none of
   them is written out. A pair in several large buckets counts in its first one.
4. Candidates are verified in sequence: signatures are compared ``BATCH`` minima
   at a time, and a pair is dropped as soon as the posterior probability (uniform
   prior) that its similarity reaches the threshold falls below ``MISS``.
   Survivors are verified exactly on their full sets of shingles.
5. Links between representatives become components (see ``components``).

Nothing is capped: hot buckets cost more tasks. Written stages lie in the shared
checkpoint folder, so lost executors repeat at most one stage.

Defined results: null or empty texts and texts without words have an empty set,
link with nothing and are kept; texts with fewer than five words link to those
with the same words; a repeated doc_id is one document (its texts' links are all
its own); rows with a null doc_id are classed by their text but represent nobody,
get the component of their class (null if alone) and are kept if alone.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.llm.common import id_text, map_arrow, map_text, ship, table
from pintime.llm.components import components, written
from pintime.llm.shingles import mix, shingle_sets, word_hashes
from pintime.session import scratch_dir

PERCENT = 85        # of the union, the least intersection of a link
HASHES, BANDS, ROWS = 128, 25, 5
BATCH = 32
MISS = 1e-6
SMALL, BLOCK = 16, 256

_RNG = np.random.default_rng(97_531)
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of the set under each hash, as unsigned 32-bit integers."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at:at + 2048, None] * _A + _B
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def bands(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key a band for each row of signatures."""
    s = signatures[:, :BANDS * ROWS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + s[:, :, k])
    return key.view(np.int64)


@functools.lru_cache(maxsize=8)
def least_matches(percent: int, miss: float) -> tuple[tuple[int, int], ...]:
    """(minima compared, least equal ones that keep a pair alive) for each batch.

    With a uniform prior the posterior after m of n equal minima is
    Beta(m + 1, n - m + 1), whose mass above t is P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        mass = 0.0
        for m in range(n + 1):
            mass += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if mass >= miss:
                out.append((n, m))
                break
    return tuple(out)


def alive(a: np.ndarray, b: np.ndarray, percent: int, miss: float) -> np.ndarray:
    """Which rows of two aligned signature arrays survive all batches."""
    left, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, least in least_matches(percent, miss):
        equal = equal + (a[left, n - BATCH:n] == b[left, n - BATCH:n]).sum(axis=1)
        stay = equal >= least
        left, equal = left[stay], equal[stay]
    return left


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def work(ids: list, texts: list[str]) -> dict[str, list]:
        sets = shingle_sets(texts)
        words, ends = word_hashes(texts)
        text_keys, at = [], 0
        for end in ends.tolist():       # 128 bits over the words, in order
            w = words[at:end]
            place = mix(np.arange(1, len(w) + 1, dtype=np.uint64))
            text_keys.append(np.array([mix(w ^ place).sum(dtype=np.uint64) + np.uint64(len(w)),
                                       (w * (place | np.uint64(1))).sum(dtype=np.uint64)],
                                      np.uint64).tobytes() if len(w) else None)
            at = end
        return {"doc_id": ids, "text_key": text_keys, "n_shingles": [len(s) for s in sets],
                "signature": [signature(s).tobytes() if len(s) else None for s in sets]}

    return map_text(id_text(docs, id_col, text_col),
                    "doc_id long, text_key binary, n_shingles long, signature binary", work)


def _band_rows(classes: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32)
                keys = bands(s.reshape(-1, HASHES))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(list(keys), schema.field(1).type)], schema=schema)

    return (map_arrow(classes.select("doc_id", "signature"), run, "doc_id long, keys array<long>")
            .select("doc_id", F.explode("keys").alias("bucket")))


def _survivors(pairs: DataFrame, signed: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs whose signatures don't rule them out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32)
                        .reshape(-1, HASHES) for c in ("x", "y"))
                keep = pa.array(alive(x, y, percent, miss))
                yield pa.RecordBatch.from_arrays(
                    [b.column("a").take(keep), b.column("b").take(keep)], schema=schema)

    left = signed.select(F.col("doc_id").alias("a"), F.col("signature").alias("x"))
    right = signed.select(F.col("doc_id").alias("b"), F.col("signature").alias("y"))
    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"),
                     run, "a long, b long")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _exact(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that the full sets confirm."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [i for i, (x, y) in enumerate(zip(b.column("x"), b.column("y"), strict=True))
                  if _linked(np.frombuffer(x.as_buffer(), np.uint64),
                             np.frombuffer(y.as_buffer(), np.uint64), percent)]
            keep = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("a").take(keep), b.column("b").take(keep)], schema=schema)

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"),
                     run, "a long, b long")


def _block_links(members: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links within large buckets: ``members(bucket, n, doc_id, signature, shingles)``."""
    block = F.expr(f"int(pmod(xxhash64(doc_id, bucket), ceil(n / {BLOCK})))")
    dealt = (members.withColumn("own", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.expr(f"int(ceil(n / {BLOCK})) - 1"))))
             .select("bucket", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"), "own", "doc_id", "signature",
                     "shingles"))

    def links(t: pa.Table) -> pa.Table:
        a, b = _links_of_block(t, percent, miss)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ship(members.sparkSession)
    return dealt.groupBy("bucket", "i", "j").applyInArrow(links, "a long, b long")


def _links_of_block(t: pa.Table, percent: int, miss: float) -> tuple[list[int], list[int]]:
    ids = t.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, own = ids[order], t.column("own").to_numpy()[order]
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    bucket = t.column("bucket")[0].as_py()
    signatures = np.frombuffer(b"".join(t.column("signature").to_pylist()),
                               np.uint32).reshape(-1, HASHES)[order]
    raw = t.column("shingles").to_pylist()
    sets = [np.frombuffer(raw[k], np.uint64) for k in order]
    sizes = np.array([len(s) for s in sets])
    keys = bands(signatures)
    # a pair belongs to its first band in common; pairs in an earlier bucket are done there
    place = int(np.flatnonzero((keys == bucket).all(axis=0))[0])
    flat = np.concatenate(sets)
    shingle, local = np.unique(flat, return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), sizes)
    by = np.argsort(local, kind="stable")
    posts, ends = holder[by], np.cumsum(np.bincount(local, minlength=len(shingle)))
    begins = np.r_[0, ends[:-1]]
    local_of = np.split(local, np.cumsum(sizes)[:-1])
    parent = np.arange(len(sets))
    a, b = [], []
    for x in range(len(sets)):
        rest = np.arange(x + 1, len(sets))
        if i != j:
            rest = rest[own[rest] != own[x]]
        rest = rest[parent[rest] != parent[x]]
        rest = rest[~(keys[rest, :place] == keys[x, :place]).any(axis=1)]
        rest = rest[(100 * np.minimum(sizes[rest], sizes[x])
                     >= percent * np.maximum(sizes[rest], sizes[x]))]
        rest = rest[alive(signatures[rest], np.broadcast_to(signatures[x], (len(rest), HASHES)),
                          percent, miss)]
        if not len(rest):
            continue
        if len(rest) > 8:       # the sets of all survivors at once
            own_posts = np.concatenate([posts[begins[s]:ends[s]] for s in local_of[x]])
            both = np.bincount(own_posts, minlength=len(sets))[rest]
        else:
            both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                             for y in rest])
        for y in rest[100 * both >= percent * (sizes[x] + sizes[rest] - both)]:
            if parent[x] != parent[y]:
                a.append(int(ids[x]))
                b.append(int(ids[y]))
                parent[parent == parent[y]] = parent[x]
    return a, b


def near_duplicates(docs: DataFrame, percent: int = PERCENT, miss: float = MISS,
                    id_col: str = "doc_id", text_col: str = "text",
                    folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "near-dedup")
    signed = written(_signed(docs, id_col, text_col), folder, "signed")
    # representatives: the least id of each text
    known = signed.where("text_key is not null and doc_id is not null")
    classes = written(known.groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"), F.min("signature").alias("signature")),
        folder, "classes")
    # a repeated id may stand for several texts; each keeps its own row here
    rows = written(_band_rows(classes), folder, "bands")
    buckets = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(rows.join(buckets, "bucket"), folder, "shared")
    small = (shared.where(F.col("n") <= SMALL).groupBy("bucket")
             .agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))
             .select(F.posexplode("ids").alias("at", "a"), "ids")
             .select("a", F.explode(F.expr("slice(ids, at + 2, size(ids))")).alias("b"))
             .distinct())
    survivors = written(_survivors(small, classes, percent, miss), folder, "survivors")
    large = shared.where(F.col("n") > SMALL)
    wanted = (survivors.select("a").union(survivors.select("b")).union(large.select("doc_id"))
              .toDF("doc_id").distinct())
    texts = id_text(docs, id_col, text_col).join(wanted, "doc_id", "left_semi")
    sets = written(map_text(
        texts, "doc_id long, shingles binary",
        lambda i, t: {"doc_id": i, "shingles": [s.tobytes() for s in shingle_sets(t)]}),
        folder, "sets")
    found = _exact(survivors, sets, percent)
    members = large.join(classes.select("doc_id", "signature"), "doc_id").join(sets, "doc_id")
    found = found.union(_block_links(members, percent, miss))
    copies = known.join(classes.select("text_key", F.col("doc_id").alias("first")), "text_key")
    nodes = written(found.union(copies.where("doc_id <> first").select("doc_id", "first")),
                    folder, "links")
    merged = components(nodes, folder).toDF("doc_id", "component")
    own = signed.select("doc_id", "text_key", "n_shingles")
    named = (own.where("doc_id is not null").join(merged, "doc_id", "left")
             .select("doc_id", "n_shingles",
                     F.coalesce("component", "doc_id").alias("component_id")))
    first = (classes.select("text_key", F.col("doc_id").alias("first"))
             .join(merged.withColumnRenamed("doc_id", "first"), "first", "left")
             .select("text_key", F.coalesce("component", "first").alias("component_id")))
    unnamed = (own.where("doc_id is null").join(first, "text_key", "left")
               .select("doc_id", "n_shingles", "component_id"))
    return named.unionByName(unnamed).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                           F.col("component_id").isNull()))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
