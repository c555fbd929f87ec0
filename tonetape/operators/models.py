"""Classifiers, grid search and what they tell about features."""

from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasSeed,
    HasStepSize,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetape.functions.text import let
from tonetape.operators import boosting as bt
from tonetape.operators.forests import forest_search
from tonetape.operators.ranking import pick_hash
from tonetape.schema import CLASSES

SEED = 42

# The search grids.
LOGISTIC_GRID = {"C": [0.01, 0.1, 1.0, 10.0, 100.0]}
FOREST_GRID = {"numTrees": [50, 100, 200], "maxDepth": [30, 10, 20], "minSplitRows": [2, 5, 10], "minInstancesPerNode": [1, 2, 4]}
ADABOOST_GRID = {"maxIter": [50, 100, 200], "stepSize": [0.01, 0.1, 1.0]}
GBT_GRID = {
    "maxDepth": [3, 5, 7],
    "stepSize": [0.01, 0.1, 0.2],
    "maxIter": [50, 100, 200],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "1.0"],
}
NETWORK_LAYERS = (64, 128, 64)


def random_baseline(df: DataFrame, key: Sequence[str], seed: int = SEED, out: str = "pred") -> DataFrame:
    """A uniform pick of -1, 0, 1 that depends on (seed, key) alone."""
    draw = F.conv(F.substring(pick_hash(key, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn(out, (draw % 3 - 1).cast("int"))


# ---- boosting of stumps ---------------------------------------------------------


class _Stumps(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    pass


class StumpBoost(
    Estimator, _Stumps, HasMaxIter, HasStepSize, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """Multi-class boosting of one-split trees (SAMME).

    Every round is one pass over the binned table, which sums weights by class,
    feature and bin; see `boosting`.
    """

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        maxIter=50,
        stepSize=1.0,
        seed=SEED,
    ):
        super().__init__()
        self._setDefault(maxIter=50, stepSize=1.0, seed=SEED)
        self._set(**self._input_kwargs)

    def setMaxIter(self, value):
        return self._set(maxIter=value)

    def setStepSize(self, value):
        return self._set(stepSize=value)

    def _fit(self, dataset):
        vec, label = self.getFeaturesCol(), self.getLabelCol()
        classes = class_number(dataset, label)
        fit = bt.Fit(self.getMaxIter(), self.getStepSize())
        (grown,), cuts = bt.fit_together(dataset, [fit], classes, vec, label, stumps=True)
        return stump_model(grown, cuts, classes)._set(
            featuresCol=vec, labelCol=label, predictionCol=self.getPredictionCol()
        )


def class_number(dataset, label: str) -> int:
    most = dataset.agg(F.max(label)).first()[0]
    if most is None:
        raise ValueError("no rows to learn from")
    return int(most) + 1


def stump_model(grown: bt.Grown, cuts: list, classes: int) -> "StumpBoostModel":
    """(feature, threshold, left class, right class, weight) of each round; feature -1 when nothing splits."""
    stumps = []
    for feature, cut, value in zip(grown.feature, grown.cut, grown.value):
        j = int(feature[0, 0])
        left, right = (value[:, 1], value[:, 2]) if j >= 0 else (value[:, 0], value[:, 0])
        threshold = cuts[j][int(cut[0, 0])] if j >= 0 else 0.0
        stumps.append([float(j), threshold, float(left.argmax()), float(right.argmax()), float(left.max())])
    if not stumps:
        raise ValueError("no stump does better than chance")
    return StumpBoostModel(stumps=stumps, classes=classes)


class StumpBoostModel(Model, _Stumps, DefaultParamsReadable, DefaultParamsWritable):
    """Weighted vote of stumps, one expression over the feature vector."""

    stumps = Param(
        Params._dummy(),
        "stumps",
        "feature, threshold, left, right, weight of each",
        TypeConverters.toList,
    )
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, stumps=None, classes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def getStumps(self):
        return self.getOrDefault(self.stumps)

    def _transform(self, dataset):
        """The stumps are one literal array, folded over the vector of a row."""
        stumps = F.array(
            *[
                F.struct(F.lit(int(f)).alias("f"), F.lit(float(t)).alias("t"), F.lit(int(lo)).alias("lo"), F.lit(int(hi)).alias("hi"), F.lit(float(w)).alias("w"))
                for f, t, lo, hi, w in self.getStumps()
            ]
        )

        def vote(x):
            def add(votes, s):
                side = F.when((s["f"] < 0) | (F.get(x, F.greatest(s["f"], F.lit(0))) <= s["t"]), s["lo"]).otherwise(s["hi"])
                return let(side, lambda c: F.transform(votes, lambda v, i: F.when(i == c, v + s["w"]).otherwise(v)))

            return F.aggregate(stumps, F.array_repeat(F.lit(0.0), self.getOrDefault(self.classes)), add)

        votes = let(vector_to_array(F.col(self.getFeaturesCol())), vote)
        best = let(votes, lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("double"))
        return dataset.withColumn(self.getPredictionCol(), best)

    def importances(self, size: int) -> list[float]:
        """Vote weight of the stumps on each feature, as shares."""
        held = [0.0] * size
        for feature, *_, weight in self.getStumps():
            if feature >= 0:
                held[int(feature)] += weight
        total = sum(held) or 1.0
        return [h / total for h in held]


class _Boosted(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    pass


class SoftmaxBoost(Estimator, _Boosted, HasMaxIter, HasStepSize, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees for any number of classes: softmax gradients, one tree per class and round.

    Parameters bear the names of the library's boosted trees: maxIter rounds of stepSize
    and maxDepth, subsamplingRate of the rows of a round, featureSubsetStrategy (a
    share) of the columns of a tree.
    """

    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows", TypeConverters.toFloat)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "share of columns", TypeConverters.toString)

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        maxIter=100,
        stepSize=0.3,
        maxDepth=6,
        subsamplingRate=1.0,
        featureSubsetStrategy="1.0",
    ):
        super().__init__()
        self._setDefault(maxIter=100, stepSize=0.3, maxDepth=6, subsamplingRate=1.0, featureSubsetStrategy="1.0")
        self._set(**self._input_kwargs)

    def point(self, rounds: int | None = None) -> bt.Fit:
        get = self.getOrDefault
        return bt.Fit(
            rounds or self.getMaxIter(), self.getStepSize(), get(self.maxDepth), get(self.subsamplingRate), float(get(self.featureSubsetStrategy))
        )

    def _fit(self, dataset):
        vec, label = self.getFeaturesCol(), self.getLabelCol()
        (grown,), cuts = bt.fit_together(dataset, [self.point()], class_number(dataset, label), vec, label)
        return softmax_model(grown, cuts)._set(featuresCol=vec, labelCol=label, predictionCol=self.getPredictionCol())


NODE_FIELDS = ("round", "class", "node", "feature", "threshold", "value", "gain")


def softmax_model(grown: bt.Grown, cuts: list) -> "SoftmaxBoostModel":
    """The reachable nodes of all trees, one list of NODE_FIELDS each; feature -1 in a leaf."""
    nodes = []
    for turn, (feature, cut, value, gain) in enumerate(zip(grown.feature, grown.cut, grown.value, grown.gain)):
        for k in range(len(feature)):
            reached = {0}
            for i in range(feature.shape[1]):
                if i not in reached:
                    continue
                j = int(feature[k, i])
                if j >= 0:
                    reached |= {2 * i + 1, 2 * i + 2}
                threshold = cuts[j][int(cut[k, i])] if j >= 0 else 0.0
                nodes.append([float(turn), float(k), float(i), float(j), threshold, float(value[k, i]), float(gain[k, i])])
    classes = len(grown.feature[0]) if grown.feature else 0
    return SoftmaxBoostModel(nodes=nodes, classes=classes, losses=[x for x in grown.losses])


class SoftmaxBoostModel(Model, _Boosted, DefaultParamsReadable, DefaultParamsWritable):
    """Sums of trees by class, as class probabilities and the most likely class."""

    nodes = Param(Params._dummy(), "nodes", ", ".join(NODE_FIELDS), TypeConverters.toList)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)
    losses = Param(Params._dummy(), "losses", "mean loss before the first round and after each", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, nodes=None, classes=None, losses=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def heaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """feature, threshold and value by round, class and node."""
        t = np.array(self.getOrDefault(self.nodes), float).reshape(-1, len(NODE_FIELDS))
        turn, k, i = t[:, :3].astype(int).T
        width = 2 ** int(i.max(initial=0) + 1).bit_length() - 1
        shape = (int(turn.max(initial=-1)) + 1, self.getOrDefault(self.classes), width)
        out = [np.full(shape, fill) for fill in (-1, 0.0, 0.0)]
        for x, column in zip(out, (3, 4, 5)):
            x[turn, k, i] = t[:, column]
        return tuple(out)

    def _transform(self, dataset):
        feature, threshold, value = self.heaps()
        rounds, classes, width = feature.shape

        @F.pandas_udf("array<double>")
        def chances(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            scores = np.full((len(rows), classes), bt.START)
            place, k = np.arange(len(rows))[:, None], np.arange(classes)
            for turn in range(rounds):
                node = np.zeros((len(rows), classes), np.int64)
                for _ in range((width + 1).bit_length() - 2):
                    f = feature[turn, k, node]
                    # Missing values go right, as their bin does.
                    right = ~(rows[place, np.maximum(f, 0)] <= threshold[turn, k, node])
                    node = np.where(f >= 0, 2 * node + 1 + right, node)
                scores += value[turn, k, node]
            p = np.exp(scores - scores.max(1, keepdims=True))
            return pd.Series(list(p / p.sum(1, keepdims=True)))

        out = dataset.withColumn("probability", array_to_vector(chances(vector_to_array(F.col(self.getFeaturesCol())))))
        p = vector_to_array("probability")
        return out.withColumn(self.getPredictionCol(), (F.array_position(p, F.array_max(p)) - 1).cast("double"))

    def importances(self, size: int) -> list[float]:
        """Mean gain of the splits on each feature, as shares."""
        total, many = np.zeros(size), np.zeros(size)
        for *_, j, _, _, gain in self.getOrDefault(self.nodes):
            if j >= 0:
                total[int(j)] += gain
                many[int(j)] += 1
        mean = total / np.maximum(many, 1)
        return [float(v) for v in mean / (mean.sum() or 1.0)]


# ---- estimators with the parameters searched over -------------------------------


def logistic(rows: int, c: float = 1.0) -> LogisticRegression:
    """Multinomial logistic regression; penalty C on a sum loss is 1 / (C n) on a mean loss."""
    return LogisticRegression(
        family="multinomial",
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
        regParam=1.0 / (c * rows),
    )


def random_forest(trees: int = 100, depth: int = 30, leaf: int = 1) -> RandomForestClassifier:
    """Depth 30 is the library's deepest and stands for 'unlimited'.

    Rows keep the node they are at, by tree, and do not walk down from the root at each level."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="sqrt", seed=SEED, cacheNodeIds=True
    )


def adaboost(rounds: int = 50, rate: float = 1.0) -> StumpBoost:
    return StumpBoost(maxIter=rounds, stepSize=rate, seed=SEED)


def boosted_trees(**params) -> SoftmaxBoost:
    return SoftmaxBoost(**params)


def network(inputs: int, classes: int = 3, hidden: Sequence[int] = NETWORK_LAYERS, epochs: int = 50):
    """Feed-forward net inputs -> hidden -> classes with a softmax output."""
    return MultilayerPerceptronClassifier(
        layers=[inputs, *hidden, classes], maxIter=epochs, blockSize=32, seed=SEED
    )


def param_grid(estimator, axes: dict) -> list:
    """Every combination of the axes, first axis slowest."""
    builder = ParamGridBuilder()
    for name, values in axes.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def logistic_axes(rows: int, folds: int, axes: dict = LOGISTIC_GRID) -> dict:
    """The C axis as regularisation weights of the search's fits.

    Each of them sees (folds - 1) / folds of the rows, and a sum loss weighs the less
    against the penalty the fewer rows it adds up.  `refit_logistic` sets the weight
    of the chosen C on all rows.
    """
    return {"regParam": [1.0 / (c * rows * (folds - 1) / folds) for c in axes["C"]]}


def refit_logistic(found, train: DataFrame, rows: int, axes: dict = LOGISTIC_GRID):
    """The model of a search's best C, fitted on all rows with the penalty that is C's there."""
    best = max(range(len(found.avgMetrics)), key=lambda i: (found.avgMetrics[i], -i))
    return logistic(rows, axes["C"][best]).fit(train)


def grid_search(
    estimator, axes: dict, train: DataFrame, fold_col: str, folds: int, parallelism: int = 4
):
    """Best point of a grid by mean fold accuracy, refit on all rows; equal points: the first."""
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=param_grid(estimator, axes),
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=folds,
        foldCol=fold_col,
        parallelism=parallelism,
    )
    return search.fit(train)


def boosting_search(estimator, axes: dict, train: DataFrame, fold_col: str, folds: int) -> tuple[list, dict, Model]:
    """(point, fold, accuracy) of every point of a grid of StumpBoost or SoftmaxBoost, the best point, its model.

    Points that differ in maxIter are one fit per fold, scored after each number of
    rounds; all fits of the grid and the ones on all rows are grown in the same passes.
    """
    vec, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    stumps, classes = isinstance(estimator, StumpBoost), class_number(train, label)
    grid = param_grid(estimator, axes)
    points = [{p.name: v for p, v in point.items()} for point in grid]
    fits = [
        bt.Fit(e.getMaxIter(), e.getStepSize()) if stumps else e.point() for e in (estimator.copy(point) for point in grid)
    ]
    table, best, grown, cuts = bt.prefix_search(train, fits, folds, classes, vec, label, fold_col, stumps)
    model = stump_model(grown, cuts, classes) if stumps else softmax_model(grown, cuts)
    model._set(featuresCol=vec, labelCol=label, predictionCol=estimator.getPredictionCol())
    return [(points[i], fold, a) for i, fold, a in table], points[best], model


def search(estimator, axes: dict, train: DataFrame, fold_col: str, folds: int, rows: int) -> tuple[list, dict, Model]:
    """(point, fold, accuracy) rows of any of the grids, the best point, and its model on all rows.

    The library's own search keeps means alone: the penalty's rows have fold -1."""
    if "minSplitRows" in axes:
        return forest_search(estimator, axes, train, fold_col, folds)
    if "C" not in axes:
        return boosting_search(estimator, axes, train, fold_col, folds)
    found = grid_search(estimator, logistic_axes(rows, folds, axes), train, fold_col, folds)
    table = [({"C": c}, -1, float(a)) for c, a in zip(axes["C"], found.avgMetrics)]
    best = max(range(len(table)), key=lambda i: (table[i][2], -i))
    return table, table[best][0], refit_logistic(found, train, rows, axes)


def point_name(point: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in point.items())


def point_table(spark, table: list, best: dict) -> DataFrame:
    """A search's points with the accuracy on each fold, and whether the point was chosen."""
    rows = [(point_name(p), fold, float(a), p == best) for p, fold, a in table]
    return spark.createDataFrame(rows, "params string, fold int, accuracy double, chosen boolean")


def search_table(spark, fitted) -> DataFrame:
    """Mean fold accuracy of each point of a finished search."""
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in point.items()), float(m))
        for i, (point, m) in enumerate(zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics))
    ]
    return spark.createDataFrame(rows, "point int, params string, accuracy double")


# ---- what a fitted model tells ---------------------------------------------------


def coefficients(spark, model, names: Sequence[str], classes=CLASSES) -> DataFrame:
    """Coefficient per class and feature of a logistic model."""
    matrix = model.coefficientMatrix.toArray()
    rows = [
        (int(c), name, float(matrix[i][j]))
        for i, c in enumerate(sorted(classes))
        for j, name in enumerate(names)
    ]
    return spark.createDataFrame(rows, "class int, feature string, coefficient double")


def importances(spark, model, names: Sequence[str]) -> DataFrame:
    """Feature importances, largest first."""
    if isinstance(model, (StumpBoostModel, SoftmaxBoostModel)):
        values = model.importances(len(names))
    else:
        values = model.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def training_history(spark, model) -> DataFrame:
    """Loss after each training step."""
    boosted = isinstance(model, SoftmaxBoostModel)
    losses = model.getOrDefault(model.losses) if boosted else model.summary().objectiveHistory
    return spark.createDataFrame(
        [(i, float(v)) for i, v in enumerate(losses)], "step int, loss double"
    )
