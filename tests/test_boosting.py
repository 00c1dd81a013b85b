"""Boosted counts: the Poisson deviance falls, and is below that of squared error."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pintime import config
from pintime.plans.boosting import deviance, fit_counts, importance
from pintime.plans.model import ModelRegistry, fit, gbt_pipeline, score


def poisson(rng, mu):
    at, p, limit = 0, rng.random(), math.exp(-mu)
    while p > limit:
        p *= rng.random()
        at += 1
    return at


@pytest.fixture(scope="module")
def counts(spark):
    """Counts whose rate is steep in two features; most are 0, some are large."""
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        x = [rng.random() for _ in config.X_COLS]
        mu = math.exp(5 * x[0] - 3 + 2 * (x[1] > 0.8))
        rows.append((*x, float(poisson(rng, mu)), i % 4 == 0))
    schema = ", ".join(f"{c} double" for c in [*config.X_COLS, config.Y_COL]) + ", held boolean"
    df = spark.createDataFrame(rows, schema).checkpoint()
    return df.where("not held").drop("held"), df.where("held").drop("held")


def mean_deviance(rows):
    mu = F.greatest(F.col("prediction"), F.lit(1e-3))
    return rows.agg(F.avg(deviance(F.col(config.Y_COL), mu))).first()[0]


def test_deviance_falls_and_beats_squared_error(spark, counts, tmp_root):
    train, test = counts
    boosted = fit_counts(train, test, trees=12, depth=3)
    curve = [(r.train_deviance, r.valid_deviance) for r in boosted.rounds]
    assert len(curve) == 12
    assert all(b < a for (a, _), (b, _) in zip(curve, curve[1:], strict=False))
    assert curve[-1][1] < 0.5 * curve[0][1]
    squared = fit(train, gbt_pipeline(trees=12, depth=3))
    mine, theirs = (mean_deviance(m.transform(test)) for m in (boosted.model, squared))
    assert mine < theirs
    # the curve's errors are those of the model, and it is saved and scored as any other
    predicted = boosted.model.transform(test)
    assert predicted.columns == [*test.columns, "features", "prediction"]
    best = min(boosted.rounds, key=lambda r: r.valid_mae)
    got = predicted.agg(F.avg(F.abs(F.col(config.Y_COL) - F.col("prediction")))).first()[0]
    assert got == pytest.approx(best.valid_mae, rel=1e-9)
    registry = ModelRegistry(spark, f"{tmp_root}/m")
    registry.save("counts", boosted.model)
    rows = test.limit(5).withColumn("state", F.lit("a"))
    a = [r.prediction for r in score(boosted.model, rows).collect()]
    assert [r.prediction for r in score(registry.load("counts"), rows).collect()] == a
    weights = {r.feature: r.importance for r in importance(spark, boosted.model).collect()}
    assert sum(weights.values()) == pytest.approx(1)
    assert weights[config.X_COLS[0]] + weights[config.X_COLS[1]] > 0.7


def test_stops_early_and_keeps_the_best(spark, counts):
    train, test = counts
    noise = test.withColumn(config.Y_COL, F.lit(50.0))      # only ever worse
    boosted = fit_counts(train, noise, trees=30, depth=1, patience=2)
    best = min(boosted.rounds, key=lambda r: r.valid_mae)
    assert len(boosted.rounds) <= best.trees + 2
    curve = boosted.curve(spark)
    assert curve.count() == len(boosted.rounds) and curve.columns[0] == "trees"


def test_odd_rows(spark, counts):
    train, _ = counts
    few = train.limit(40)
    odd = few.limit(3).withColumn(config.Y_COL, F.lit(-1.0)).unionByName(
        few.limit(2).withColumn(config.Y_COL, F.lit(None).cast("double"))).unionByName(
        few.limit(2).withColumn(config.X_COLS[0], F.lit(None).cast("double")))
    model = fit_counts(few.unionByName(odd), trees=2, depth=2).model
    out = model.transform(few.unionByName(odd)).collect()
    assert len(out) == 47 and all(r.prediction > 0 for r in out)
    with pytest.raises(ValueError):
        fit_counts(few.where("false"), trees=1)
