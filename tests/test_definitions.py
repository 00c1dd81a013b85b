"""Definitions, registry checks, teardown, model registry."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintime.definitions import (Entity, FeatureRepo, FeatureService, FeatureSource, FeatureView,
                                 Field)


def _view(name="v", table="defs_src", feats=("x",)):
    return FeatureView(name, [Entity("state", ("state",))], timedelta(days=1),
                       [Field(f, T.FloatType()) for f in feats],
                       FeatureSource("s", "date", table=table))


def test_apply_checks_and_projection(spark):
    spark.sql("select 'A' as state, timestamp_ntz'2021-01-04 00:00:00' as date, 1.5D as x") \
        .createOrReplaceTempView("defs_src")
    v = _view()
    repo = FeatureRepo().apply(spark, [v, FeatureService("svc", [v[["x"]]])])
    assert repo.get_feature_service("svc").feature_names() == ["x"]
    assert dict(v.to_df(spark).dtypes)["x"] == "float"
    with pytest.raises(KeyError):
        v[["nope"]]
    with pytest.raises(ValueError):
        repo.apply(spark, [_view()])                    # duplicate name, other object
    with pytest.raises(ValueError):
        FeatureRepo().apply(spark, [_view(name="w", feats=("missing",))])
    with pytest.raises(KeyError):
        repo.get_feature_service("other")
    repo.teardown(spark)
    assert not spark.catalog.tableExists("defs_src")


def test_model_registry_versions(spark, tmp_root):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from pintime.plans.model import ModelRegistry
    df = spark.createDataFrame([(1.0,)], "a double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="v")]).fit(df)
    reg = ModelRegistry(spark, tmp_root)
    assert reg.latest("m") is None
    assert reg.save("m", model) == 1 and reg.save("m", model) == 2
    assert reg.load("m").transform(df).count() == 1


def test_poisson_pipeline_and_unknown_key_scores_null(spark):
    from pyspark.sql import functions as F

    from pintime import config
    from pintime.plans.model import fit, poisson_pipeline, score
    rows = [tuple(float((i * (j + 3)) % 7) for j in range(8)) + (float(i % 5),)
            for i in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in
                                               [*config.X_COLS, config.Y_COL]))
    model = fit(df, poisson_pipeline())
    preds = model.transform(df).select("prediction").collect()
    assert all(p.prediction >= 0 for p in preds)
    unknown = df.limit(1).select(F.lit("Z").alias("state"),
                                 *[F.lit(None).cast("double").alias(c) for c in config.X_COLS])
    from pintime.plans.model import gbt_pipeline
    gbt = fit(df, gbt_pipeline(trees=2))
    assert score(gbt, unknown).first().prediction is None


def test_path_source_registered_and_torn_down(spark, tmp_root):
    spark.sql("select 'A' as state, timestamp_ntz'2021-01-04 00:00:00' as date, 2.5D as x") \
        .write.parquet(f"{tmp_root}/v")
    v = FeatureView("pv", [Entity("state", ("state",))], timedelta(days=1),
                    [Field("x", T.FloatType())], FeatureSource("pv_src", "date", path=f"{tmp_root}/v"))
    repo = FeatureRepo().apply(spark, [v])
    assert spark.sql("select count(*) as n from pv_src").first().n == 1
    repo.teardown(spark)
    assert not spark.catalog.tableExists("pv_src")


def test_teardown_by_kind(spark, tmp_root):
    spark.sql("drop table if exists torn_table")
    spark.sql(f"create table torn_table using parquet location '{tmp_root}/t' as "
              "select 'A' as state, timestamp_ntz'2021-01-04 00:00:00' as date, 2.5D as x")
    spark.sql("select * from torn_table").createOrReplaceTempView("torn_view")
    views = [FeatureView(n, [Entity("state", ("state",))], timedelta(days=1),
                         [Field("x", T.FloatType())], FeatureSource(n, "date", table=n))
             for n in ("torn_view", "torn_table")]
    repo = FeatureRepo().apply(spark, views)
    repo.teardown(spark)
    assert not spark.catalog.tableExists("torn_table")
    assert not spark.catalog.tableExists("torn_view")


def test_registry_after_a_save_that_died(spark, tmp_root):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from pintime.plans.model import ModelRegistry
    df = spark.createDataFrame([(1.0,)], "a double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="v")]).fit(df)
    model.write().save(f"{tmp_root}/m/1")       # no version row was written
    reg = ModelRegistry(spark, tmp_root)
    assert reg.latest("m") is None and reg.save("m", model) == 1
    assert reg.load("m").transform(df).count() == 1


def test_poisson_keeps_rows_with_missing_features_and_curve(spark):
    from pintime import config
    from pintime.plans.model import fit, gbt_pipeline, poisson_pipeline, validation_curve
    rows = [tuple(float((i * (j + 3)) % 7) for j in range(8)) + (float(i % 5),)
            for i in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in
                                               [*config.X_COLS, config.Y_COL]))
    hole = df.limit(1).withColumn(config.X_COLS[0], F.lit(None).cast("double"))
    out = fit(df.unionByName(hole), poisson_pipeline()).transform(df.unionByName(hole)).collect()
    assert len(out) == 61 and sum(r.prediction is None for r in out) == 1
    curve = validation_curve(spark, fit(df, gbt_pipeline(trees=3)), df).collect()
    assert [r.trees for r in curve] == [1, 2, 3] and all(r.mae >= 0 for r in curve)
