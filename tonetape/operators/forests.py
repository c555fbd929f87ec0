"""Forests by their nodes: fewer trees, an earlier end of splitting, gains, and a search that fits little.

A fitted forest is written and its nodes read back as a table.  A forest that may only
split nodes of some rows is the one without that bound, its smaller nodes made leaves; a
shallower one has its deep nodes made leaves; one of fewer trees is its first trees.  So
one fit per leaf size serves every number of trees, depth and bound on splits.  (A forest
fitted with fewer trees or levels draws other samples and columns; it is as good a draw.)

The library goes through all rows at each level of each fit.  A search takes its steps
one by one: rows are binned and drawn once for all leaf sizes, and rows alike in label and
bins become one, which counts for the sum of their draws.  The sums that splits are found
by are the same, so the trees are.
"""

import json
import struct
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from itertools import product
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonetape.session import checkpoint_dir, materialised, release

#: The library's deepest tree.
DEEPEST = 30
#: Points that a task adds up before it hands their sums on, and points of one part of a fit.
HELD, POINTS = 65_536, 2_500


def save_forest(spark: SparkSession, model) -> DataFrame:
    """The model written to the shared folder; its nodes as they are stored, `release` deletes it."""
    path = f"{checkpoint_dir(spark)}/forest-{uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    nodes._written_at = path
    return nodes


def node_table(spark: SparkSession, model) -> DataFrame:
    """One row per node of a fitted tree model: tree, node, rows, weights by class, prediction, and
    in inner nodes gain, feature, threshold, left and right."""
    stored = save_forest(spark, model)
    several = "treeID" in stored.columns
    value = lambda c: F.col(f"nodeData.{c}" if several else c)
    inner = value("leftChild") >= 0
    at = lambda c, name: F.when(inner, c).alias(name)
    out = stored.select(
        (F.col("treeID") if several else F.lit(0)).alias("tree"),
        value("id").alias("node"),
        value("rawCount").alias("rows"),
        value("impurityStats").alias("stats"),
        value("prediction").alias("prediction"),
        at(value("gain"), "gain"),
        at(value("split.featureIndex"), "feature"),
        at(F.get(value("split.leftCategoriesOrThreshold"), F.lit(0)), "threshold"),
        at(value("leftChild"), "left"),
        at(value("rightChild"), "right"),
    )
    out._written_at = stored._written_at
    return out


def gain_shares(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Importances from the nodes of classification trees: gains weighted by rows, as shares of each tree, then of all."""
    weight = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    each = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("g"))
    each = each.withColumn("share", F.col("g") / F.nullif(F.sum("g").over(Window.partitionBy("tree")), F.lit(0.0)))
    # One row per feature from here on.
    total = each.groupBy("feature").agg(F.sum("share").alias("share"))
    whole = F.nullif(F.sum("share").over(Window.partitionBy()), F.lit(0.0))
    given = nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature int, name string")
    out = given.join(total, "feature", "left").withColumn("importance", F.coalesce(F.col("share") / whole, F.lit(0.0)))
    return out.select(F.col("name").alias("feature"), "importance")


# ---- fewer trees, larger splits --------------------------------------------------


def collapse(tree: pd.DataFrame, least: int, depth: int) -> pd.DataFrame:
    """The stored nodes of one tree, those with fewer than least rows or at depth made leaves, numbered anew from the root."""
    nodes = {n["id"]: n for n in tree["nodeData"]}
    number, order, todo = {}, [], [(0, 0)]
    while todo:
        i, level = todo.pop()
        number[i] = len(order)
        order.append(i)
        if nodes[i]["leftChild"] >= 0 and nodes[i]["rawCount"] >= least and level < depth:
            todo += [(nodes[i]["rightChild"], level + 1), (nodes[i]["leftChild"], level + 1)]
    out = []
    for i in order:
        n = dict(nodes[i])
        if n["leftChild"] in number:
            n["leftChild"], n["rightChild"] = number[n["leftChild"]], number[n["rightChild"]]
        else:
            n.update(leftChild=-1, rightChild=-1, gain=-1.0, split={"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1})
        n["id"] = number[i]
        out.append(n)
    return pd.DataFrame({"treeID": tree["treeID"].iloc[0], "nodeData": out})


def cut_forest(spark: SparkSession, model, trees: int | None = None, least: int = 2, depth: int = DEEPEST) -> RandomForestClassificationModel:
    """The forest of the first trees in which nodes of fewer than least rows, or at depth, do not split, as a model of its own."""
    trees = trees or model.getNumTrees
    stored = save_forest(spark, model)
    path, out = stored._written_at, f"{stored._written_at}-cut"
    few = stored.where(F.col("treeID") < trees)
    # A group is one tree.
    pruned = few.groupBy("treeID").applyInPandas(lambda tree: collapse(tree, least, depth), stored.schema)
    pruned.write.parquet(f"{out}/data")
    each = spark.read.parquet(f"{path}/treesMetadata")
    each.where(F.col(each.columns[0]) < trees).write.parquet(f"{out}/treesMetadata")
    about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["numTrees"] = trees
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{out}/metadata")
    again = RandomForestClassificationModel.load(out)
    for folder in (path, out):
        stored._written_at = folder
        release(stored)
    return again


@dataclass(frozen=True)
class Arrays:
    """Nodes of a forest, tree after tree; children are places, a leaf has feature -1."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    rows: np.ndarray
    share: np.ndarray


def arrays_of(nodes: DataFrame) -> Arrays:
    """node_table in the driver: as large as the model, which lives there too."""
    t = nodes.orderBy("tree", "node").toArrow()
    value = lambda c, blank: t[c].fill_null(blank).to_numpy()
    root = np.flatnonzero(value("node", -1) == 0)
    base = np.repeat(root, np.diff(np.append(root, len(t))))
    whole = lambda c: value(c, -1).astype(np.int64)
    stats = t["stats"].combine_chunks().flatten().to_numpy().reshape(len(t), -1)
    return Arrays(
        root, whole("feature"), value("threshold", 0.0).astype(float), base + whole("left"), base + whole("right"),
        whole("rows"), stats / np.maximum(stats.sum(1, keepdims=True), 1e-300),
    )


def votes(x: np.ndarray, forest: Arrays, least: int, prefixes: Sequence[int], depth: int = DEEPEST) -> dict[int, np.ndarray]:
    """Class shares summed over the first trees, for each number of them, where nodes under least rows, or at depth, do not split."""
    total, out = np.zeros((len(x), forest.share.shape[1])), {}
    splits = (forest.feature >= 0) & (forest.rows >= least)
    for n, root in enumerate(forest.root, 1):
        node, going = np.full(len(x), root), np.arange(len(x))
        for _ in range(depth):
            going = going[splits[node[going]]]
            if not len(going):
                break
            at = node[going]
            down = x[going, forest.feature[at]] <= forest.threshold[at]
            node[going] = np.where(down, forest.left[at], forest.right[at])
        total = total + forest.share[node]
        if n in prefixes:
            out[n] = total
    return out


def in_bins(forest: Arrays, size: int) -> tuple[Arrays, list[np.ndarray]]:
    """The thresholds of each feature, and the forest over numbers of thresholds that a value exceeds."""
    cuts, place = [], np.zeros(len(forest.feature))
    for j in range(size):
        at = forest.feature == j
        cuts.append(np.unique(forest.threshold[at]))
        place[at] = np.searchsorted(cuts[j], forest.threshold[at])
    return replace(forest, threshold=place), cuts


def accuracies(df: DataFrame, forest: Arrays, prefixes: Sequence[int], cuts: Sequence[tuple[int, int]], vec: str = "features", label: str = "label") -> dict[tuple[int, int, int], float]:
    """Accuracy on df by number of trees and cut (least rows of a split, depth): a pass that counts
    rows alike in label and in all that the forest asks for, and one that sums the hits of those."""
    prefixes = sorted(min(p, len(forest.root)) for p in prefixes)
    forest, steps = in_bins(forest, int(forest.feature.max(initial=-1)) + 1)

    def count(batches):
        for b in batches:
            n = b.num_rows
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, len(steps)))
            y = b.column("y").to_numpy(zero_copy_only=False)
            # A missing value exceeds all.
            rows = np.column_stack([*(np.searchsorted(c, x[:, j]) for j, c in enumerate(steps)), y]).astype(np.int32)
            alike, many = np.unique(rows, axis=0, return_counts=True)
            arrays = [pa.array([r.tobytes() for r in alike], pa.binary()), pa.array(many, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "n"])

    def score(batches):
        hits, total = np.zeros((len(prefixes), len(cuts)), np.int64), 0
        for b in batches:
            if not b.num_rows:
                continue
            rows = np.frombuffer(b"".join(b.column("row").to_pylist()), np.int32).reshape(b.num_rows, -1)
            x, y, n = rows[:, :-1], rows[:, -1], b.column("n").to_numpy(zero_copy_only=False)
            total += n.sum()
            for j, (least, depth) in enumerate(cuts):
                got = votes(x, forest, least, prefixes, depth)
                hits[:, j] += [n[got[p].argmax(1) == y].sum() for p in prefixes]
        i, j = np.indices(hits.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(hits.ravel()), pa.array(np.full(hits.size, total))], names=["i", "j", "hits", "n"])

    rows = df.select(vector_to_array(F.col(vec)).alias("x"), F.col(label).cast("int").alias("y"))
    alike = rows.mapInArrow(count, "row binary, n long").groupBy("row").agg(F.sum("n").alias("n"))
    sums = alike.mapInArrow(score, "i long, j long, hits long, n long").groupBy("i", "j").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    return {(prefixes[r["i"]], *cuts[r["j"]]): r["hits"] / r["n"] if r["n"] else float("nan") for r in sums.collect()}


# ---- fits by the library's steps -------------------------------------------------


def _raw(column: pa.Array) -> np.ndarray:
    """Values of one length as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _values(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as binary values."""
    n, width = rows.shape
    at = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(rows))])


def _summed(heads: list[bytes], counts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Each head once, and the sums of its rows of counts."""
    number: dict[bytes, int] = {}
    of = np.array([number.setdefault(h, len(number)) for h in heads])
    order = of.argsort(kind="stable")
    return list(number), np.add.reduceat(counts[order], np.searchsorted(of[order], np.arange(len(number))), axis=0)


def added_up(points: DataFrame, trees: int, width: int) -> DataFrame:
    """Drawn rows (value: a serialised point of so many bytes, at whose end the draws by tree stand) with those
    added up that differ in their draws alone."""

    def add(batches):
        heads, counts = [], np.zeros((0, trees), np.int32)
        for b in batches:
            if not b.num_rows:
                continue
            # Buffers may be longer than what was written to them.
            raw = _raw(b.column("value"))[:, :width]
            head = np.ascontiguousarray(raw[:, : -4 * trees])
            own = [h.tobytes() for h in head]
            drawn = np.ascontiguousarray(raw[:, -4 * trees :]).view(">i4").astype(np.int32)
            heads, counts = _summed(heads + own, np.concatenate([counts, drawn]))
            if len(heads) >= HELD:
                yield from put(heads, counts)
                heads, counts = [], counts[:0]
        if heads:
            yield from put(heads, counts)

    def put(heads, counts) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(heads), POINTS):
            few = slice(low, low + POINTS)
            head = np.frombuffer(b"".join(heads[few]), np.uint8).reshape(len(heads[few]), -1)
            value = np.hstack([head, np.ascontiguousarray(counts[few].astype(">i4")).view(np.uint8)])
            yield pa.RecordBatch.from_arrays([pa.array(heads[few], pa.binary()), _values(value)], names=["head", "value"])

    part = points.mapInArrow(add, "head binary, value binary")
    # Alike points that are handed on apart count as much as one.
    return part.repartition("head").select("value").mapInArrow(add, "head binary, value binary").select("value")


@dataclass(frozen=True)
class Drawn:
    """Rows of a fit, binned and drawn for each tree, as points; and what the library found out about them."""

    points: DataFrame
    classes: int
    arities: object
    about: object
    splits: object


def _one(package, name: str):
    """A Scala object of a Java package."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def _as(df: DataFrame, name: str):
    """The objects of a class that the values of df are in serialised form, as an RDD."""
    return getattr(df._jdf, "as")(_coder(df.sparkSession, name)).rdd()


def _coder(spark: SparkSession, name: str):
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    kind = spark._jvm.java.lang.Class.forName(f"org.apache.spark.ml.{name}", True, loader)
    return spark._jvm.org.apache.spark.sql.Encoders.javaSerialization(kind)


def _serialised(spark: SparkSession, value) -> bytes:
    return bytes(_one(spark._jvm.org.apache.spark.util, "Utils").serialize(value))


def _instances(estimator, df: DataFrame, classes: int):
    """The rows that the library's fit learns from, as it checks them; parts and order are those of df."""
    spark = df.sparkSession
    jvm, lib = spark._jvm, spark._jvm.org.apache.spark.ml
    check = _one(lib.util, "DatasetUtils")
    checked = [check.checkClassificationLabels(estimator.getLabelCol(), jvm.scala.Some(classes)), check.checkNonNanVectors(estimator.getFeaturesCol())]
    rows = DataFrame(df._jdf.select(jvm.PythonUtils.toSeq(checked)), spark).toDF("label", "features")
    rows = rows.select("label", vector_to_array("features").alias("x"))
    size = len(rows.first()["x"])
    marks, zeros = (1.25, 1.5), spark.sparkContext._gateway.new_array(jvm.double, size)
    sample = _serialised(spark, lib.feature.Instance(*marks, lib.linalg.DenseVector(zeros)))
    at = sample.index(struct.pack(">dd", *marks))

    def put(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            out = np.tile(np.frombuffer(sample, np.uint8), (n, 1))
            for low, x in ((at, b.column("label")), (len(sample) - 8 * size, b.column("x").flatten())):
                x = x.to_numpy(zero_copy_only=False).reshape(n, -1).astype(">f8").view(np.uint8)
                out[:, low : low + x.shape[1]] = x
            out[:, at + 8 : at + 16] = np.frombuffer(struct.pack(">d", 1.0), np.uint8)
            yield pa.RecordBatch.from_arrays([_values(out)], names=["value"])

    return _as(rows.mapInArrow(put, "value binary"), "feature.Instance")


def draw(estimator, df: DataFrame) -> Drawn:
    """The steps of the library's fit before the trees: bins and draws; rows alike in label and bins become one point."""
    spark, label = df.sparkSession, estimator.getLabelCol()
    jvm, tree = spark._jvm, spark._jvm.org.apache.spark.ml.tree.impl
    estimator._transfer_params_to_java()
    own = estimator._java_obj
    df = df.withColumn(label, F.col(label).cast("double"))
    classes = own.getNumClasses(df._jdf, 100)
    rows = _instances(estimator, df, classes)
    arities = _one(jvm.org.apache.spark.ml.util, "MetadataUtils").getCategoricalFeatures(df._jdf.schema().apply(estimator.getFeaturesCol()))
    kind = _one(jvm.org.apache.spark.mllib.tree.configuration, "Algo").Classification()
    strategy = own.getOldStrategy(arities, classes, kind, own.getOldImpurity())
    trees, seed = estimator.getNumTrees(), estimator.getSeed()
    about = _one(tree, "DecisionTreeMetadata").buildMetadata(rows, strategy, trees, estimator.getFeatureSubsetStrategy())
    splits = _one(tree, "RandomForest").findSplits(rows, about, seed)
    binned = _one(tree, "TreePoint").convertToTreeRDD(rows, splits, about)
    bagging = _one(tree, "BaggedPoint")
    alike = getattr(bagging, "convertToBaggedRDD$default$5")()
    bagged = bagging.convertToBaggedRDD(binned, estimator.getSubsamplingRate(), trees, estimator.getBootstrap(), alike, seed)
    points = DataFrame(spark._jsparkSession.createDataset(bagged, _coder(spark, "tree.impl.BaggedPoint")).toDF(), spark)
    blank = [spark.sparkContext._gateway.new_array(jvm.int, n) for n in (about.numFeatures(), trees)]
    width = len(_serialised(spark, tree.BaggedPoint(tree.TreePoint(0.0, blank[0], 1.0), blank[1], 1.0)))
    return Drawn(materialised(added_up(points, trees, width)), classes, arities, about, splits)


def grow(estimator, drawn: Drawn, leaf: int) -> RandomForestClassificationModel:
    """The forest that the library fits on the rows of drawn, with so many rows at least to a leaf."""
    spark, points = drawn.points.sparkSession, drawn.points
    jvm, lib = spark._jvm, spark._jvm.org.apache.spark.ml
    estimator = estimator.copy({estimator.minInstancesPerNode: leaf})
    estimator._transfer_params_to_java()
    own, a = estimator._java_obj, drawn.about
    kind = _one(jvm.org.apache.spark.mllib.tree.configuration, "Algo").Classification()
    strategy = own.getOldStrategy(drawn.arities, drawn.classes, kind, own.getOldImpurity())
    getattr(strategy, "bootstrap_$eq")(estimator.getBootstrap())
    about = lib.tree.impl.DecisionTreeMetadata(
        a.numFeatures(), a.numExamples(), a.weightedNumExamples(), a.numClasses(), a.maxBins(), a.featureArity(), a.unorderedFeatures(), a.numBins(),
        a.impurity(), a.quantileStrategy(), a.maxDepth(), leaf, a.minWeightFractionPerNode(), a.minInfoGain(), a.numTrees(), a.numFeaturesPerNode(),
    )
    # All points are read at each level.
    rows = _as(points.repartition(max(1, points.count() // POINTS)), "tree.impl.BaggedPoint")
    rows.persist(_one(jvm.org.apache.spark.storage, "StorageLevel").MEMORY_AND_DISK())
    none = jvm.scala.Option.empty()
    splits = spark.sparkContext._jsc.broadcast(drawn.splits)
    grown = _one(lib.tree.impl, "RandomForest").runBagged(
        rows, about, splits, strategy, a.numTrees(), estimator.getFeatureSubsetStrategy(), estimator.getSeed(), none, True, none,
        _one(lib.tree, "TreeConfig").trainingEarlyStopModelSizeThresholdInBytes(),
    )
    rows.unpersist(False)
    splits.destroy()
    set_ = jvm.org.apache.spark.ml.param.ParamMap.empty()
    trees = spark.sparkContext._gateway.new_array(lib.classification.DecisionTreeClassificationModel, len(grown))
    for i, t in enumerate(grown):
        trees[i] = own.copyValues(t, set_)
    model = lib.classification.RandomForestClassificationModel(own.uid(), trees, a.numFeatures(), drawn.classes)
    return estimator._copyValues(RandomForestClassificationModel(own.copyValues(model, set_)))


def forest_search(estimator, axes: dict, train: DataFrame, fold_col: str, folds: int, parallelism: int = 4):
    """Fold accuracies of every point of axes (numTrees, maxDepth, minSplitRows, minInstancesPerNode), the best point, its model.

    rows of the table: (point as dict, fold, accuracy), points in order, first axis
    slowest; best is by mean, equal ones the first.  Rows are drawn once per fold, and a fit
    per leaf size and fold serves all points; the best one is fitted on all rows and cut to its
    point.  Weighted rows are not drawn as points: the library's fit takes them.
    """
    spark = train.sparkSession
    estimator = estimator.copy({estimator.numTrees: max(axes["numTrees"]), estimator.maxDepth: max(axes["maxDepth"])})
    cuts = list(product(axes["minSplitRows"], axes["maxDepth"]))
    weighted = estimator.isSet(estimator.weightCol)

    def learn(fold: int) -> DataFrame:
        return train.where(F.col(fold_col) != fold)

    def fitted(rows: DataFrame, points: Drawn | None, leaf: int) -> RandomForestClassificationModel:
        return estimator.fit(rows, {estimator.minInstancesPerNode: leaf}) if points is None else grow(estimator, points, leaf)

    def one(leaf: int, fold: int) -> dict:
        nodes = node_table(spark, fitted(learn(fold), drawn[fold], leaf))
        forest = arrays_of(nodes)
        release(nodes)
        got = accuracies(train.where(F.col(fold_col) == fold), forest, axes["numTrees"], cuts)
        return {(n, depth, least, leaf, fold): a for (n, least, depth), a in got.items()}

    found, tasks = {}, list(product(axes["minInstancesPerNode"], range(folds)))
    with ThreadPoolExecutor(parallelism) as pool:
        drawn = list(pool.map(inheritable_thread_target(spark)(lambda i: None if weighted else draw(estimator, learn(i))), range(folds)))
        for got in pool.map(inheritable_thread_target(spark)(lambda t: one(*t)), tasks):
            found.update(got)
    release(*(d.points for d in drawn if d))
    points = [
        {"numTrees": n, "maxDepth": d, "minSplitRows": s, "minInstancesPerNode": leaf}
        for n, d, s, leaf in product(axes["numTrees"], axes["maxDepth"], axes["minSplitRows"], axes["minInstancesPerNode"])
    ]
    table = [(p, fold, found[(*p.values(), fold)]) for p in points for fold in range(folds)]
    means = [float(np.nanmean([a for q, _, a in table if q is p])) for p in points]
    best = points[max(range(len(points)), key=lambda i: (means[i], -i))]
    every = None if weighted else draw(estimator, train)
    whole = fitted(train, every, best["minInstancesPerNode"])
    if every:
        release(every.points)
    return table, best, cut_forest(spark, whole, best["numTrees"], best["minSplitRows"], best["maxDepth"])
