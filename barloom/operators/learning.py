"""Training: scaled and one-hot features, boosted trees one-versus-rest, Bayesian search over group folds."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .trading import class_report, group_folds


def pipeline(numeric: list[str], categorical: list[str], label: str = "target", boosted: bool = False, seed: int = 42, **params) -> Pipeline:
    """Unknown categories have a place of their own. boosted: three binary boosters, else one forest."""
    index = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep") for c in categorical]
    hot = [OneHotEncoder(inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_hot" for c in categorical], handleInvalid="keep")] if categorical else []
    numbers = VectorAssembler(inputCols=numeric, outputCol="numbers", handleInvalid="skip")
    scale = StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True)
    join = VectorAssembler(inputCols=["scaled", *(f"{c}_hot" for c in categorical)], outputCol="features")
    if boosted:
        model = OneVsRest(classifier=GBTClassifier(seed=seed, **({"maxIter": 20} | params)), labelCol=label)
    else:
        model = RandomForestClassifier(labelCol=label, seed=seed, **({"numTrees": 30, "maxDepth": 5} | params))
    return Pipeline(stages=[*index, *hot, numbers, scale, join, model])


def fit(rows: DataFrame, numeric: list[str], categorical: list[str] = (), **options) -> PipelineModel:
    return pipeline(list(numeric), list(categorical), **options).fit(rows)


#: Settings that a search looks among: (depth, trees).
SPACE = tuple((depth, trees) for depth in range(3, 9) for trees in (10, 20, 30, 40))


def _next_setting(tried: dict[tuple[int, int], float], seed: int) -> tuple[int, int]:
    """The setting not tried yet that promises most: its expected improvement under a Gaussian process of the scores so far.

    The first two are drawn at random, far from each other by chance only; ties go to the first in SPACE.
    """
    open_ = [s for s in SPACE if s not in tried]
    if len(tried) < 2:
        return random.Random(seed + len(tried)).choice(open_)
    unit = lambda s: np.array([((d - 3) / 5, (t - 10) / 30) for d, t in s])
    kernel = lambda a, b: np.exp(-((a[:, None] - b[None]) ** 2).sum(2) / (2 * 0.4**2))
    known, y = unit(list(tried)), np.array(list(tried.values()))
    scale = y.std() or 1.0
    inverse = np.linalg.inv(kernel(known, known) + 1e-4 * np.eye(len(y)))
    cross = kernel(unit(open_), known)
    mean = cross @ inverse @ ((y - y.mean()) / scale)
    spread = np.sqrt(np.maximum(1 - np.einsum("ij,jk,ik->i", cross, inverse, cross), 1e-12))
    ahead = mean - (y.max() - y.mean()) / scale
    z = ahead / spread
    density, below = np.exp(-(z**2) / 2) / math.sqrt(2 * math.pi), np.array([(1 + math.erf(v / math.sqrt(2))) / 2 for v in z])
    return open_[int(np.argmax(ahead * below + spread * density))]


def search(rows: DataFrame, numeric: list[str], key: str = "symbol", label: str = "target", trials: int = 5, folds: int = 3, seed: int = 42) -> PipelineModel:
    """The best of `trials` settings, chosen one after the other by what the scores before promise (Bayesian search).

    Each is judged by F1 on folds that no key is split over.
    """
    base = pipeline(numeric, [], label, seed=seed)
    forest = base.getStages()[-1]
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    rows = rows.withColumn("fold", group_folds(key, folds))
    tried: dict[tuple[int, int], float] = {}
    best = None
    while len(tried) < min(trials, len(SPACE)):
        depth, trees = setting = _next_setting(tried, seed)
        grid = ParamGridBuilder().addGrid(forest.maxDepth, [depth]).addGrid(forest.numTrees, [trees]).build()
        found = CrossValidator(estimator=base, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, foldCol="fold").fit(rows)
        tried[setting] = found.avgMetrics[0]
        if best is None or tried[setting] > best[0]:
            best = (tried[setting], found.bestModel)
    return best[1]


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_and_evaluate(rows: DataFrame, cutoff: str, numeric: list[str], categorical: list[str] = (), **options) -> tuple[PipelineModel, DataFrame]:
    """A model of the rows up to the cutoff, and the class report of those after it."""
    model = fit(rows.where(F.col("datetime") <= F.lit(cutoff).cast("timestamp")), numeric, categorical, **options)
    after = model.transform(rows.where(F.col("datetime") > F.lit(cutoff).cast("timestamp")))
    return model, class_report(after, "target", "prediction")
