"""Model training and batch scoring with MLlib (ML-2..ML-8).

The reference trains a Poisson gradient-boosted tree model; MLlib's GBT has
no Poisson loss, so the tree model uses squared error (binned splits, like
"hist") and a Poisson GLM with log link is offered beside it. Only error
levels (MAE) are comparable across libraries.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintime import config
from pintime.functions.vectors import feature_array
from pintime.sources.versions import VersionLog


def assembler(cols: Sequence[str] = config.X_COLS, out: str = "features") -> VectorAssembler:
    """ML-2: X in contract order; nulls become NaN instead of failing."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def gbt_pipeline(trees: int = config.GBT_TREES, depth: int = config.GBT_DEPTH,
                 seed: int = config.SEED, label: str = config.Y_COL) -> Pipeline:
    """ML-3: boosted trees, depth 4, fixed seed."""
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                       maxIter=trees, maxDepth=depth, seed=seed, maxBins=32)
    return Pipeline(stages=[assembler(), gbt])


def poisson_pipeline(label: str = config.Y_COL, max_iter: int = 50) -> Pipeline:
    """ML-3's count objective: Poisson regression with a log link on standardized
    features. ``fit`` leaves out rows with a missing feature; scoring keeps them and
    gives them a null prediction."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    glm = GeneralizedLinearRegression(featuresCol="scaled", labelCol=label, family="poisson",
                                      link="log", maxIter=max_iter, regParam=1e-3,
                                      predictionCol="_glm")
    missing_null = SQLTransformer(statement="SELECT *, IF(isnan(_glm), NULL, _glm) AS prediction "
                                            "FROM __THIS__")
    return Pipeline(stages=[assembler(), scaler, glm, missing_null])


def fit(data: DataFrame, pipeline: Pipeline | None = None) -> PipelineModel:
    """ML-3 / ML-5: fit on X + y (rows with a null label cannot train)."""
    pipeline = pipeline or gbt_pipeline()
    rows = data.where(F.col(config.Y_COL).isNotNull())
    if any(isinstance(s, GeneralizedLinearRegression) for s in pipeline.getStages()):
        rows = rows.na.drop(subset=list(config.X_COLS))     # a linear model has no missing branch
    return pipeline.fit(rows)


def mae(model: PipelineModel, test: DataFrame, label: str = config.Y_COL) -> DataFrame:
    """ML-4: ``mae, n`` as one distributed aggregate."""
    pred = model.transform(test)
    return pred.agg(F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("mae"),
                    F.count(F.lit(1)).alias("n"))


def validation_curve(spark: SparkSession, model: PipelineModel, test: DataFrame,
                     label: str = config.Y_COL) -> DataFrame:
    """ML-4: ``trees, mae``: the test error after every boosting round."""
    rows = model.stages[0].transform(test.where(F.col(label).isNotNull()))
    errors = model.stages[-1].evaluateEachIteration(rows, "absolute")
    return spark.createDataFrame(list(enumerate(map(float, errors), start=1)),
                                 "trees int, mae double")


def feature_importance(spark: SparkSession, model: PipelineModel,
                       cols: Sequence[str] = config.X_COLS) -> DataFrame:
    """ML-6: ``feature, importance`` (one row per input column)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(list(zip(cols, [float(v) for v in imp])), schema)


def score(model: PipelineModel, features: DataFrame, keys: Sequence[str] = ("state",)) -> DataFrame:
    """ML-7: ``keys, feature_values array<float>, prediction float``: the
    8-wide FP32 feature tensor the lookup step hands to the model (FN-9) and
    the prediction. A key with no stored features at all scores NULL (Q14)."""
    known = F.greatest(*[F.col(c).isNotNull() for c in config.X_COLS])
    pred = model.transform(features.withColumn("_known", known))
    return pred.select(*keys, feature_array(config.X_COLS).alias("feature_values"),
                       F.when(F.col("_known"), F.col("prediction").cast("float"))
                       .alias("prediction"))


class ModelRegistry:
    """ML-8: models saved under integer versions; the next version is the
    largest stored one plus one (Q12). Every save writes a directory of its own;
    a version log names it after the model files are complete, so a save that died
    is never seen and blocks nothing, and of two saves that take the same version
    the second is refused."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, name: str) -> VersionLog:
        return VersionLog(self.spark, f"{self.root}/{name}/_versions")

    def latest(self, name: str) -> int | None:
        return max(self._log(name).versions(), default=None)

    def save(self, name: str, model: PipelineModel) -> int:
        version = (self.latest(name) or 0) + 1
        path = f"{self.root}/{name}/{version}-{uuid.uuid4().hex[:12]}"
        model.write().save(path)
        self._log(name).commit(version, {"path": path})
        return version

    def load(self, name: str, version: int = -1) -> PipelineModel:
        """``version=-1`` loads the latest, as the serving config does."""
        v = self.latest(name) if version == -1 else version
        if v is None or v not in self._log(name).versions():
            raise KeyError(f"no saved model {name!r}, version {version}")
        return PipelineModel.load(self._log(name).read(v)["path"])
