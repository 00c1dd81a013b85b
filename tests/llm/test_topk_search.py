"""Exact top-k search against brute force."""

import random

from pyspark.sql import functions as F

from pintime.llm import topk_search
from pintime.llm.topk_search import top_k


def test_against_brute_force_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 50)
    monkeypatch.setattr(topk_search, "QUERIES", 4)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.5]) for _ in range(40)], "clash") for i in range(150)]
    rows += [(1000 + i, [1.0] * 40, "clash") for i in range(60)] + [rows[0], rows[0]]
    rows += [(None, [1.0] * 40, "x"), (2000, None, "x"), (2050, [], "x"),
             (2100, [1.0, None, -1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    known = {i: [(v[j] or 0) > 0 if j < len(v) else False for j in range(40)]
             for i, v, _ in rows if i is not None and v is not None}
    got = {}
    for r in top_k(df, F.col("id") % 50 == 0, k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.distance, r.neighbor_id))
    want = {q: sorted((sum(x != y for x, y in zip(known[q], c, strict=True)), i)
                      for i, c in known.items() if i != q)[:7] for q in known if q % 50 == 0}
    assert got == want
    assert top_k(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert top_k(df.where("vec_id = 2050"), F.col("id") % 50 == 0).count() == 0
