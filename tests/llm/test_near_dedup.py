"""Components and near-duplicates against brute force."""

import random

import duckdb
import numpy as np
import pytest

from pintime.llm import near_dedup
from pintime.llm.components import components
from pintime.llm.oracle import ORACLE_SQL
from pintime.llm.shingles import shingle_sets
from tests.llm.helpers import ODD_TEXTS, SF, brute_components, frame, shingles


def near_copies(seed=1, n=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(160)]
    out = []
    for i in range(n):
        t = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            t[rng.randrange(len(t))] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(t).upper() if i % 5 == 0 else " ".join(t))
    return out


def test_components_of_random_links(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (None, 3)]
    parent = {x: x for a, b in links for x in (a, b) if a is not None and b is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_sets_are_the_words():
    texts = [t or "" for t in ODD_TEXTS] + near_copies(n=5)
    sets = shingle_sets(texts)
    want = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) == len(want[i] & want[j])


def test_posterior_bounds():
    bounds = dict(near_dedup.least_matches(85, 1e-6))
    assert sorted(bounds) == [32, 64, 96, 128]
    assert bounds[32] < 32 * 0.6 and 80 < bounds[128] < 109
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 32, (2000, 128), dtype=np.uint32)
    near = np.where(rng.random(a.shape) < 0.87, a, a + np.uint32(1))
    far = np.where(rng.random(a.shape) < 0.4, a, a + np.uint32(1))
    assert len(near_dedup.alive(a, near, 85, 1e-6)) == 2000
    assert len(near_dedup.alive(a, far, 85, 1e-6)) == 0


@pytest.mark.parametrize("small,block", [(16, 256), (2, 7)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, small, block):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = [*ODD_TEXTS, *near_copies(), *near_copies(2, 30), "a", "three words only",
             "Three WORDS only", "three  words\nonly", *ODD_TEXTS[5:8]]
    df = frame(spark, texts, first_id=100)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(df).collect()}
    sets = {100 + i: shingles(t) for i, t in enumerate(texts)}
    want = brute_components(sets)
    assert {d: r.component_id for d, r in got.items()} == want
    assert all(r.n_shingles == len(sets[d]) for d, r in got.items())
    assert all(r.kept == (d == r.component_id) for d, r in got.items())


def test_null_and_repeated_ids(spark):
    rows = [(1, "same words are here today again"), (None, "same words are here today again"),
            (None, "all alone and not like any other"), (2, None), (3, "x"), (3, "x"),
            (4, "Same Words are here today again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id, r.kept)
                 for r in near_dedup.near_duplicates(df).collect() if r.component_id is not None)
    assert got == [(-1, 1, False), (1, 1, True), (2, 2, True), (3, 3, True), (3, 3, True),
                   (4, 1, False)]
    lone = [r for r in near_dedup.near_duplicates(df).collect() if r.component_id is None]
    assert len(lone) == 1 and lone[0].kept
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op6_near_dedup"]).fetchdf().sort_values("doc_id")
    got = near_dedup.op6_near_dedup(spark, SF).toPandas().sort_values("doc_id")
    assert got[list(want.columns)].values.tolist() == want.values.tolist()
