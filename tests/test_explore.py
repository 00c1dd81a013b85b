"""Exploration aggregates on hand-made rows."""

from pyspark.sql import functions as F

from pintime.operators.explore import (
    Stage,
    correlations,
    describe,
    head,
    histogram,
    merged_stage_counts,
    stage_counts,
    stage_marks,
    tail,
)


def test_describe_matches_pandas_quartiles(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)] + [("b", 5.0)],
                               "g string, x double")
    one = describe(df.where("g = 'a'"), "x").first()
    assert (one["count"], one.mean, one.min, one.max) == (4, 2.5, 1.0, 4.0)
    assert (one.p25, one.p50, one.p75) == (1.75, 2.5, 3.25)     # pandas, not nearest rank
    by = {r.g: r for r in describe(df, "x", by=["g"]).collect()}
    assert by["b"].p50 == 5.0 and by["b"].std is None
    approx = describe(df.where("g = 'a'"), "x", approx=True).first()
    assert approx["count"] == 4


def test_histogram_constant_and_edges(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 2.0)], "y int, x double")
    rows = sorted(tuple(r) for r in histogram(df, ["x"], by="y", bins=10).drop("feature").collect())
    assert rows == [(1, 0, 2.0, 2.0, 2), (2, 0, 2.0, 2.0, 1)]
    df2 = spark.createDataFrame([(1, 0.0), (1, 10.0), (1, 5.0)], "y int, x double")
    bins = sorted((r.bin, r.n) for r in histogram(df2, ["x"], by="y", bins=10).collect())
    assert bins == [(0, 1), (5, 1), (9, 1)]       # the maximum falls in the last bin


def test_correlations_overall_and_by_group(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 4.0), (2, 1.0, 1.0), (2, 2.0, 0.0)],
                               "y int, f double, t double")
    df = df.unionByName(spark.createDataFrame([(None, 1.0, 2.0), (None, 2.0, 5.0),
                                               (1, float("nan"), 7.0)], df.schema))
    got = {(r.y, r.overall): (round(r.corr, 9), r.n)
           for r in correlations(df, ["f"], "t", by="y").collect()}
    assert got[(1, False)] == (1.0, 2) and got[(2, False)] == (-1.0, 2)
    assert got[(None, False)] == (1.0, 2) and got[(None, True)][1] == 6


def test_head_tail_and_stage_counts(spark):
    df = spark.createDataFrame([(i, f"k{i % 3}") for i in range(10)], "i int, k string")
    assert [r.i for r in head(df, ["i"], 3).collect()] == [0, 1, 2]
    assert [r.i for r in tail(df, ["i"], 3).collect()] == [7, 8, 9]
    all_rows = [Stage("all", F.lit(True), F.col("k"))]
    sc = {r.stage: (r.n_rows, r.n_keys) for r in stage_counts(df, all_rows).collect()}
    assert sc == {"all": (10, 3)}


def test_stages_in_one_scan_and_by_day(spark, tmp_root):
    rows = [(None if i % 11 == 0 else f"k{i % 700}", i % 50, i % 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, w int, day int")
    df.write.parquet(f"{tmp_root}/rows")
    df = spark.read.parquet(f"{tmp_root}/rows")
    kept = F.col("w") < 30
    stages = [Stage("loaded", F.lit(True), F.col("k")), Stage("kept", kept, F.col("k")),
              Stage("cells", kept, F.col("k"), (F.col("k"), F.col("w"))),
              Stage("none", F.col("w") > 99, F.col("k"))]
    some = [r for r in rows if r[1] < 30]
    keys = lambda part: len({r[0] for r in part} - {None})
    want = {"loaded": (4000, keys(rows)), "kept": (len(some), keys(some)),
            "cells": (len({r[:2] for r in some}), keys(some)), "none": (0, 0)}
    exact = stage_counts(df, stages)
    assert {r.stage: (r.n_rows, r.n_keys) for r in exact.collect()} == want
    plan = stage_counts(df, stages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    stage_marks(df, stages, "day").write.parquet(f"{tmp_root}/marks")
    marks = spark.read.parquet(f"{tmp_root}/marks")
    assert marks.count() == 3
    for r in merged_stage_counts(marks, stages).collect():
        n, k = want[r.stage]
        assert abs(r.n_rows - n) <= 0.05 * n and abs(r.n_keys - k) <= 0.05 * k
    one = {r.stage: r.n_rows for r in merged_stage_counts(marks.where("day = 1"), stages).collect()}
    assert one["loaded"] == sum(r[2] == 1 for r in rows)


def test_nan_and_null_groups(spark):
    nan = float("nan")
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", nan), ("a", 4.0), ("a", 6.0)],
                               "g string, x double")
    by = {r.g: r for r in describe(df, "x", by=["g"]).collect()}
    assert (by[None].p50, by[None]["count"]) == (2.0, 2)
    assert (by["a"].p50, by["a"]["count"], by["a"].mean, by["a"].max) == (5.0, 2, 5.0, 6.0)
    two = histogram(df.withColumn("z", df.x * 2), ["x", "z"], by="g", bins=2).collect()
    assert {(r.g, r.feature, r.bin, r.n) for r in two if r.feature == "z"} == {
        (None, "z", 0, 2), ("a", "z", 1, 2)} and sum(r.n for r in two) == 8
