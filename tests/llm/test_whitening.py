"""Whitening against numpy over all rows, one row a vector."""

from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from pintime.llm import whitening
from pintime.llm.common import table
from tests.llm.helpers import SF

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, x string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else list(map(
        lambda c: None if c is None else float(c), v)), i, "clash", "clash", "clash")
        for i, v in vectors], SCHEMA)


def brute(vectors, components=32, each_once=False):
    """{(place, component): expected row}, by plain numpy over the rows."""
    whole = [(k, [floor(64.0 * float(np.float32(c))) + 1_000_000 for c in v])
             for k, v in enumerate(vectors)
             if v is not None and all(c is not None and isfinite(np.float32(c)) for c in v)]
    fitted = [list(x) for x in {tuple(x) for _, x in whole}] if each_once else [
        x for _, x in whole]
    n, sums = len(fitted), [sum(c) for c in zip(*fitted, strict=True)]
    z = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in fitted])
    v = z.T @ z / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for k, x in whole:
        far = [n * a - s for a, s in zip(x, sums, strict=True)]
        y = np.array(far) / n @ axes / np.sqrt(values)
        out[k] = (n, sum(f * f for f in far), y, values / np.trace(v))
    return out


def check(rows, ids, expected):
    """``rows`` are those of ``expected`` (signs free, but the same for all rows)."""
    held = {}
    for r in rows:
        held.setdefault(r.vec_id, {})[r.component] = r
    assert set(held) == {ids[k] for k in expected}
    k0 = len(next(iter(expected.values()))[2])
    assert len(rows) == k0 * len(expected)
    got = np.array([[held[ids[k]][c + 1].whitened for c in range(k0)] for k in expected])
    want = np.array([e[2] for e in expected.values()])
    signs = np.sign((got * want).sum(axis=0))
    assert np.allclose(got, want * signs, atol=1e-7)
    for k, (n, deviation, _, explained) in expected.items():
        for c, r in held[ids[k]].items():
            assert (r.n, r.deviation) == (n, deviation) and int(r.deviation_exact) == deviation
            assert r.explained == pytest.approx(explained[c - 1], rel=1e-9)
            assert r.identity_error < 1e-9
    assert len({r.identity_error for r in rows}) == 1


def test_query_against_numpy(spark):
    rows = table(spark, SF, "embeddings").collect()
    got = whitening.op13_whitening(spark, SF).collect()
    check(got, [r.vec_id for r in rows], brute([r.embedding for r in rows]))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 5)) * [4, 3, 2, 1, 0.5]
    out = [list(v) for v in base]
    out += [out[0]] * 200                       # a hot vector
    out += [list(v) for v in base[:20]]
    out += [None, [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0, 0, 0, 0],
            [0.0, -0.0, 1e-30, -1e-30, 2.0]]
    return out


@pytest.mark.parametrize("weights", ["count", "one"])
def test_copies_nulls_and_clashing_columns(spark, vectors, weights):
    df = frame(spark, list(enumerate(vectors))).repartition(7)
    got = whitening.whiten(df, weights=weights).collect()
    check(got, list(range(len(vectors))), brute(vectors, each_once=weights == "one"))


def test_each_distinct_vector_is_projected_once(spark, vectors):
    df = frame(spark, list(enumerate(vectors)))
    groups = whitening.distinct_vectors(whitening.whole_vectors(df))
    assert groups.count() == 41 and groups.agg(F.sum("weight")).first()[0] == 261


def test_components_are_limited_and_repeated_ids_stay(spark, vectors):
    df = frame(spark, [(i // 2, v) for i, v in enumerate(vectors[:40])] + [(None, vectors[1])])
    got = whitening.whiten(df, components=2).collect()
    assert len(got) == 82 and {r.component for r in got} == {1, 2}
    assert sum(r.vec_id is None for r in got) == 2
    assert sum(r.vec_id == 3 for r in got) == 4


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(1, [0.5, 0.25])], [(1, [2.0, 2.0]), (2, [2.0, 2.0])], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    out = whitening.whiten(frame(spark, rows))
    assert out.collect() == [] and out.columns[:3] == ["vec_id", "component", "n"]


def test_lengths_and_directions_without_variance(spark):
    rows = [(1, [1.0, 5.0, 2.0]), (2, [2.0, 5.0, 4.0]), (3, [4.0, 5.0, 8.0]), (4, [1.0, 2.0]),
            (5, [9.0] * 4)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {(r.vec_id, r.component, r.n) for r in got} == {(1, 1, 3), (2, 1, 3), (3, 1, 3)}
    assert sum(r.whitened for r in got) == pytest.approx(0, abs=1e-9)
    assert {round(r.explained, 9) for r in got} == {1.0}


def test_far_entries_stay_exact(spark):
    far = [[1e30, 0.0], [-1e30, 1.0], [3e12, 2.0], [0.0, 3.0]]
    got = whitening.whiten(frame(spark, list(enumerate(far)))).where("component = 1").collect()
    x = [[max(min(floor(64.0 * float(np.float32(c))), 2**61), -(2**61)) + 1_000_000 for c in v]
         for v in far]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = [sum((4 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    for r in got:
        exact = want[r.vec_id]
        assert r.deviation == (exact if exact < 2**63 else None)
        assert r.deviation_exact is None if exact >= 10**38 else int(r.deviation_exact) == exact
