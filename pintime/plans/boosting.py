"""Boosted trees for counts: the Poisson objective over MLlib's own regression trees (ML-3,
ML-4, ML-6).

A round fits one tree to the working residuals of the Poisson loss under a log link,
``(y - mu) / mu`` weighted by ``mu``, so its splits are those of a Newton step. The values of
its leaves are then estimated anew by one aggregate over leaf ids, ``sum(y - mu) / (sum(mu) +
ridge)``, at most ``2^depth`` short rows, and added to a running margin column. The same
rows carry the validation part, so a round's errors are one more small aggregate. Margins are
checkpointed every few rounds, which cuts the lineage. Boosting ends after ``patience`` rounds
without a better validation error; the rounds up to the best one are the model.

The model is an ordinary ``PipelineModel`` (an assembler, the trees with their leaf ids, one SQL
step that adds the leaves' values), so it is saved, loaded and scored as any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime import config
from pintime.plans.model import assembler
from pintime.session import ensure_checkpoint_dir

#: The usual defaults of the objective: step size, largest step of a margin, ridge on leaves.
STEP, LARGEST_STEP, RIDGE = 0.3, 0.7, 1.0
PATIENCE = 10
#: Rounds between two checkpoints of the margins.
CUT = 5


@dataclass(frozen=True)
class Round:
    """Errors after a round: mean absolute error and mean Poisson deviance."""

    trees: int
    train_mae: float
    train_deviance: float
    valid_mae: float | None
    valid_deviance: float | None


@dataclass(frozen=True)
class Boosted:
    model: PipelineModel
    rounds: list[Round]         # all that were tried; the model has the best one's trees

    def curve(self, spark: SparkSession) -> DataFrame:
        """ML-4: one row per boosting round."""
        return spark.createDataFrame(
            [(r.trees, r.train_mae, r.train_deviance, r.valid_mae, r.valid_deviance)
             for r in self.rounds], "trees int, train_mae double, train_deviance double, "
            "valid_mae double, valid_deviance double")


def deviance(y: Column, mu: Column) -> Column:
    """One row's Poisson deviance."""
    return 2 * (F.when(y > 0, y * F.log(y / mu)).otherwise(0.0) - (y - mu))


def fit_counts(train: DataFrame, valid: DataFrame | None = None, trees: int = config.GBT_TREES,
               depth: int = config.GBT_DEPTH, seed: int = config.SEED, label: str = config.Y_COL,
               cols: Sequence[str] = config.X_COLS, step: float = STEP,
               patience: int = PATIENCE, bins: int = 32) -> Boosted:
    """Boost on ``train``; ``valid`` (None: no early stop) only stops it. Rows with a missing
    feature or label, or a negative one, take no part (MLlib's trees train on whole rows
    only; scoring takes a missing feature as larger than any value)."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    assemble = assembler(cols)
    parts = [train.withColumn("_valid", F.lit(False))]
    if valid is not None:
        parts.append(valid.withColumn("_valid", F.lit(True)))
    rows = parts[0] if valid is None else parts[0].unionByName(parts[1])
    rows = assemble.transform(rows.where(F.col(label) >= 0).na.drop(subset=list(cols))).select(
        "features", F.col(label).cast("double").alias("_y"), "_valid").checkpoint()
    mean = rows.where(~F.col("_valid")).agg(F.avg("_y")).first()[0]
    if mean is None:
        raise ValueError("no rows to train on")
    base = math.log(max(mean, 1e-6))
    rows = rows.withColumn("_margin", F.lit(base))
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="_z", weightCol="_mu",
                                 maxDepth=depth, maxBins=bins, seed=seed, leafCol="_leaf",
                                 predictionCol="_tree")
    grown: list[tuple[DecisionTreeRegressionModel, list[float]]] = []
    rounds: list[Round] = []
    best = 0
    for k in range(1, trees + 1):
        work = rows.withColumn("_mu", F.exp("_margin")).withColumn(
            "_z", (F.col("_y") - F.col("_mu")) / F.col("_mu"))
        model = tree.fit(work.where(~F.col("_valid")))
        placed = model.transform(work)
        sums = placed.where(~F.col("_valid")).groupBy("_leaf").agg(
            F.sum(F.col("_y") - F.col("_mu")).alias("g"), F.sum("_mu").alias("h")).collect()
        values = [0.0] * (1 + 2 ** depth)
        for r in sums:
            newton = step * r["g"] / (r["h"] + RIDGE)
            values[int(r["_leaf"])] = max(-LARGEST_STEP, min(LARGEST_STEP, newton))
        grown.append((model, values))
        gain = F.get(F.lit(values), F.col("_leaf").cast("int"))
        rows = placed.select("features", "_y", "_valid", (F.col("_margin") + gain).alias("_margin"))
        if k % CUT == 0:
            rows = rows.checkpoint()
        rounds.append(_errors(rows, k))
        if valid is None or rounds[-1].valid_mae is None:
            best = k
        elif best == 0 or rounds[-1].valid_mae < rounds[best - 1].valid_mae:
            best = k
        elif k - best >= patience:
            break
    return Boosted(_pipeline(assemble, grown[:best], base), rounds)


def _errors(rows: DataFrame, k: int) -> Round:
    mu = F.exp("_margin")
    found = {r["_valid"]: r for r in rows.groupBy("_valid").agg(
        F.avg(F.abs(F.col("_y") - mu)).alias("mae"),
        F.avg(deviance(F.col("_y"), mu)).alias("deviance")).collect()}
    on, off = found[False], found.get(True)
    return Round(k, on["mae"], on["deviance"], off and off["mae"], off and off["deviance"])


def _pipeline(assemble, grown: list[tuple[DecisionTreeRegressionModel, list[float]]],
              base: float) -> PipelineModel:
    stages, terms, helpers = [assemble], [repr(base)], []
    for i, (model, values) in enumerate(grown):
        stages.append(model.copy().setLeafCol(f"_leaf{i}").setPredictionCol(f"_tree{i}"))
        helpers += [f"_leaf{i}", f"_tree{i}"]
        terms.append(f"get(array({', '.join(f'{v!r}D' for v in values)}), int(_leaf{i}))")
    total = f"aggregate(array({', '.join(f'cast({t} as double)' for t in terms)}), 0D, " \
            "(a, x) -> a + x)"
    kept = f"* EXCEPT ({', '.join(helpers)})" if helpers else "*"
    stages.append(SQLTransformer(statement=f"SELECT {kept}, exp({total}) AS prediction "
                                           "FROM __THIS__"))
    return PipelineModel(stages)


def importance(spark: SparkSession, model: PipelineModel,
               cols: Sequence[str] = config.X_COLS) -> DataFrame:
    """ML-6: ``feature, importance``: the trees' mean importances."""
    trees = [s for s in model.stages if isinstance(s, DecisionTreeRegressionModel)]
    total = [sum(float(t.featureImportances[i]) for t in trees) for i in range(len(cols))]
    whole = sum(total) or 1.0
    return spark.createDataFrame([(c, v / whole) for c, v in zip(cols, total, strict=True)],
                                 "feature string, importance double")
