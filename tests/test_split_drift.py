"""Temporal split and drift tests on hand-made rows."""

from datetime import datetime, timedelta

import pytest

from pintime.operators.drift import chi2_test, drift_report, ks_test, require_rows
from pintime.operators.split import temporal_split

D = datetime.fromisoformat


def test_split_point_goes_to_train(spark):
    df = spark.createDataFrame([("A", D("2021-01-04"), 1.0), ("A", D("2021-01-11"), 2.0),
                                ("A", D("2021-01-18"), 3.0)],
                               "state string, ts timestamp_ntz, y double")
    train, test = temporal_split(df, timedelta(weeks=1), "ts")
    assert sorted(r.y for r in train.collect()) == [1.0, 2.0]
    assert [r.y for r in test.collect()] == [3.0] and test.columns == ["y"]
    train_d, test_d = temporal_split(df, timedelta(days=3), "ts")
    assert train_d.count() == 2 and test_d.count() == 1
    with pytest.raises(ValueError):
        temporal_split(df, timedelta(0), "ts")


def test_ks_identical_and_disjoint(spark):
    a = spark.createDataFrame([(float(i), "s") for i in range(50)], "x double, c string")
    same = ks_test(a, a, ["x"], ranges=4).first()
    assert same.statistic == 0.0 and same.p_value == 1.0
    b = spark.createDataFrame([(float(i + 100), "t") for i in range(50)], "x double, c string")
    far = ks_test(a, b, ["x"], ranges=4).first()
    assert far.statistic == 1.0 and far.p_value < 1e-6
    one = ks_test(a, b, ["x"], ranges=1).first()
    assert one.statistic == far.statistic


def test_ks_buckets_do_not_change_statistic(spark):
    import random
    rnd = random.Random(3)
    a = spark.createDataFrame([(float(rnd.randint(0, 40)),) for _ in range(300)], "x double")
    b = spark.createDataFrame([(float(rnd.randint(5, 45)),) for _ in range(250)], "x double")
    vals = {ks_test(a, b, ["x"], ranges=k).first().statistic
            for k in (1, 3, 16)} | {ks_test(a, b, ["x"]).first().statistic}
    assert len(vals) == 1


def test_chi2_and_empty_window(spark):
    a = spark.createDataFrame([("x",)] * 30 + [("y",)] * 30, "c string")
    assert chi2_test(a, a, "c").first().statistic == 0.0
    b = spark.createDataFrame([("z",)] * 60, "c string")
    r = chi2_test(a, b, "c").first()
    assert r.dof == 2 and r.statistic == 120.0 and r.p_value < 1e-20
    with pytest.raises(ValueError):
        require_rows(a.limit(0), "empty")
    with pytest.raises(ValueError):
        drift_report(a.limit(0), b, [], ["c"], target=None).collect()


def test_exact_quantiles_match_percentile(spark):
    import random

    from pyspark.sql import functions as F

    from pintime.operators.prefix import exact_quantiles
    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b", "c"]), float(rnd.randint(0, 60)) + rnd.choice([0, 0.5]))
            for _ in range(700)] + [("d", 5.0)] + [(None, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    for ranges in (1, 4, 16, None):
        ours = {r.g: r._q for r in exact_quantiles(df, "x", probs, by=["g"],
                                                   ranges=ranges).collect()}
        ref = {r.g: r.q for r in df.groupBy("g").agg(
            F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
        assert ours.keys() == ref.keys()
        for g in ref:
            assert [round(v, 9) for v in ours[g]] == [round(v, 9) for v in ref[g]]
    glob = exact_quantiles(df, "x", [0.5], ranges=3).first()._q[0]
    assert glob == df.agg(F.percentile("x", 0.5)).first()[0]


def test_chi2_matches_mllib(spark):
    """Our SQL statistic and p-value against MLlib's ChiSquareTest on the
    same side x category table."""
    import random

    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    a = spark.createDataFrame([(rnd.choice("pqrs"),) for _ in range(400)], "c string")
    b = spark.createDataFrame([(rnd.choice("pqrst"),) for _ in range(300)], "c string")
    ours = chi2_test(a, b, "c").first()
    both = a.withColumn("side", F.lit(0.0)).unionByName(b.withColumn("side", F.lit(1.0)))
    idx = StringIndexer(inputCol="c", outputCol="ci").fit(both).transform(both)
    vec = VectorAssembler(inputCols=["ci"], outputCol="v").transform(idx)
    ref = ChiSquareTest.test(vec, "v", "side").first()
    assert ours.dof == ref.degreesOfFreedom[0]
    assert abs(ours.statistic - ref.statistics[0]) < 1e-6
    assert abs(ours.p_value - ref.pValues[0]) < 1e-6


def test_nullable_int_rule(spark):
    from pintime.functions.nulls import as_nullable_int
    df = spark.createDataFrame([(1.0, 1.7), (None, 2.0)], "a double, b double")
    out = as_nullable_int(df, ["a", "b"])
    assert dict(out.dtypes) == {"a": "bigint", "b": "double"}
    assert sorted(r.a for r in out.collect() if r.a is not None) == [1]


def test_empty_sides_give_null_rows(spark):
    a = spark.createDataFrame([(1.0, "p"), (2.0, "q")], "x double, c string")
    none = spark.createDataFrame([(None, None)] * 3, "x double, c string")
    ks = ks_test(a, none, ["x"]).first()
    assert (ks.statistic, ks.p_value, ks.n_a, ks.n_b) == (None, None, 2, 0)
    chi = chi2_test(a, none, "c").first()
    assert (chi.statistic, chi.p_value, chi.n_b) == (None, None, 0)
    rows = {r.feature: r for r in drift_report(a, none, ["x"], ["c"], target=None).collect()}
    assert rows["x"].drifted is None and rows["c"].drifted is None


def test_tiny_bounds_are_not_rounded(spark):
    from pintime.operators.drift import out_of_bounds
    base = spark.createDataFrame([(i * 1e-8,) for i in range(101)], "f double")
    cur = spark.createDataFrame([("in", 5e-7), ("low", 5e-9), ("high", 9.95e-7)],
                                "k string, f double")
    got = {r.k: r for r in out_of_bounds(base, cur, ["f"], ["k"]).collect()}
    assert got["in"].lo == pytest.approx(1e-8) and got["in"].hi == pytest.approx(9.9e-7)
    assert [got[k].out_of_bounds for k in ("in", "low", "high")] == [False, True, True]


def test_chi2_survival_at_few_and_very_many_degrees(spark):
    import math
    import time

    from pintime.functions.stats import chi2_sf
    cases = [(3.0, 2, math.exp(-1.5)), (10.0, 4, math.exp(-5) * 6), (1.0, 1, 0.31731050786),
             (700.0, 2, math.exp(-350)), (0.0, 5, 1.0)]
    for k in (500, 4_000, 100_000, 10_000_000):      # Wilson-Hilferty, good to 1e-4 here
        for z in (-2.0, -0.3, 0.5, 1.7, 3.0):
            x = k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3
            cases.append((x, k, 0.5 * math.erfc(z / math.sqrt(2))))
    df = spark.createDataFrame([(x, k) for x, k, _ in cases] + [(None, 3)], "x double, k long")
    t = time.time()
    got = [r.p for r in df.select(chi2_sf("x", "k").alias("p")).collect()]
    assert time.time() - t < 30 and got[-1] is None
    for (x, k, want), p in zip(cases, got[:-1], strict=True):
        assert p == pytest.approx(want, abs=2e-4), (x, k)
