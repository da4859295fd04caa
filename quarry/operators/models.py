"""Estimators with the settings the notebook jobs use, wired as
``pyspark.ml`` stage lists (fit on a deterministic train split, score the
test split). Training is Spark ML's own distributed implementation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import StringIndexer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame

from quarry.session import materialize

SEED = 42
TREES = (DecisionTreeClassifier, RandomForestClassifier)


def logistic(features="features", label="label") -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label)


def decision_tree(features="features", label="label") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=5, maxBins=32,
                                  impurity="gini", seed=SEED)


def random_forest(features="features", label="label", num_trees=50, max_bins=32) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees,
                                  maxBins=max_bins, seed=SEED)


def naive_bayes(features="features", label="label", smoothing=1.0) -> NaiveBayes:
    return NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing, modelType="multinomial")


def kmeans(k: int, features="features") -> KMeans:
    return KMeans(featuresCol=features, k=k, seed=SEED, maxIter=20, tol=1e-4)


def gaussian_mixture(k: int, features="features") -> GaussianMixture:
    return GaussianMixture(featuresCol=features, k=k, seed=SEED, maxIter=100, tol=0.01)


def linear_regression(features="features", label="label") -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label)


def _indexer_columns(s: StringIndexer) -> tuple[list[str], list[str]]:
    if s.isSet(s.inputCols):
        return s.getInputCols(), s.getOutputCols()
    return [s.getInputCol()], [s.getOutputCol()]


def counted_together(stages: list) -> list:
    """The stages with neighbouring string indexers (that keep invalid
    values) as one, which counts all their columns in one pass."""
    out: list = []
    for s in stages:
        last = out[-1] if out else None
        if not (isinstance(s, StringIndexer) and isinstance(last, StringIndexer)
                and s.getHandleInvalid() == last.getHandleInvalid() == "keep"
                and s.getStringOrderType() == last.getStringOrderType()):
            out.append(s)
            continue
        (ins, outs), (more_in, more_out) = _indexer_columns(last), _indexer_columns(s)
        if set(outs) & {*more_in, *more_out}:
            out.append(s)
        else:
            out[-1] = StringIndexer(inputCols=ins + more_in, outputCols=outs + more_out,
                                    handleInvalid="keep", stringOrderType=s.getStringOrderType())
    return out


def fit_stages(stages: list, train: DataFrame) -> PipelineModel:
    """Fit a chain of feature stages and an estimator. A tree estimator reads
    its rows four times before it holds them (size, statistics, split
    candidates, bags): its label and features are stored first, with the
    rows of every partition in their order, so they are derived once and the
    bags stay the same."""
    *shaping, last = counted_together(stages)
    if not isinstance(last, TREES):
        return Pipeline(stages=[*shaping, last]).fit(train)
    shaped = Pipeline(stages=shaping).fit(train)
    rows = materialize(shaped.transform(train).select(last.getLabelCol(), last.getFeaturesCol()))
    return PipelineModel([*shaped.stages, last.fit(rows)])


def fit_score(stages: list, train: DataFrame, test: DataFrame) -> tuple[PipelineModel, DataFrame]:
    model = fit_stages(stages, train)
    return model, model.transform(test)
