"""Preparation, models, metrics, reports and checks."""

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tonetape.operators import checks as ck
from tonetape.operators import evaluate as el
from tonetape.operators import models as m
from tonetape.operators import prep as pp
from tonetape.operators import report as rp
from tonetape.operators.quantiles import exact_quantiles, value_counts
from tonetape.plans import study
from tonetape.plans.study import prepare, run_classification
from tonetape.sources import writers


def labelled(spark, counts, start=0):
    data, i = [], start
    for label, n in counts.items():
        for _ in range(n):
            data.append((i, label))
            i += 1
    return spark.createDataFrame(data, "id int, target int").repartition(5)


def counts_of(df, *by):
    return {tuple(r)[:-1] if len(by) > 1 else r[0]: r[-1] for r in df.groupBy(*by).count().collect()}


@pytest.mark.parametrize("counts,test", [({-1: 9, 0: 20, 1: 30}, 0.5), ({-1: 10, 0: 20, 1: 30}, 0.3)])
def test_holdout_share(spark, counts, test):
    sizes = pp.class_counts(labelled(spark, counts))
    assert pp.holdout_share(sizes).first()["share"] == test
    assert pp.share_number(min(counts.values())) == test


@pytest.mark.parametrize("least,folds", [(3, 2), (7, 3), (40, 5), (1, 2)])
def test_fold_count(spark, least, folds):
    sizes = pp.class_counts(labelled(spark, {-1: least, 0: 50, 1: 60}))
    assert pp.fold_count(sizes).first()["folds"] == folds
    assert pp.fold_number(least) == folds


def plain_quotas(counts, share):
    """Train rows per class: exact share of n - ceil(share * n), by largest remainder."""
    total = sum(counts.values())
    train = total - math.ceil(total * share)
    exact = {c: n * train / total for c, n in counts.items()}
    out = {c: math.floor(x) for c, x in exact.items()}
    rest = sorted(counts, key=lambda c: (-round(exact[c] - out[c], 9), c))
    for c in rest[: train - sum(out.values())]:
        out[c] += 1
    return out


@pytest.mark.parametrize("counts", [{-1: 17, 0: 17, 1: 16}, {-1: 101, 0: 33, 1: 7}, {-1: 10, 0: 10, 1: 10}])
def test_split_quotas(spark, counts):
    cut = pp.stratified_split(labelled(spark, counts), "target", ["id"])
    got = counts_of(cut, "target", "part")
    want = plain_quotas(counts, 0.3)
    assert {c: got[(c, "train")] for c in counts} == want
    assert cut.count() == sum(counts.values()) == cut.select("id").distinct().count()
    again = pp.stratified_split(labelled(spark, counts).repartition(11), "target", ["id"])
    assert rows(cut) == rows(again)
    other = pp.stratified_split(labelled(spark, counts), "target", ["id"], seed=1)
    assert rows(cut) != rows(other)


def test_split_slices_do_not_matter(spark, monkeypatch):
    from tonetape.operators import ranking

    df = labelled(spark, {-1: 300, 0: 40, 1: 11})
    got = [rows(ranking.hash_ranks(df, "target", ["id"], 42, d), "id", "_rank", "_size") for d in (1, 3, 32)]
    assert got[0] == got[1] == got[2]
    ranks = {}
    for r in ranking.hash_ranks(df, "target", ["id"], 42).collect():
        ranks.setdefault(r["target"], []).append(r["_rank"])
    assert {c: sorted(v) for c, v in ranks.items()} == {c: list(range(1, n + 1)) for c, n in {-1: 300, 0: 40, 1: 11}.items()}


def test_grouped_split_keeps_events_whole(spark):
    data = [(i, i % 40, (i % 40) % 3 - 1) for i in range(400)]
    df = spark.createDataFrame(data, "id int, event int, target int")
    cut = pp.stratified_split(df, "target", ["id"], group_cols=["event"])
    assert cut.count() == 400
    assert cut.groupBy("event").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0
    events = counts_of(cut.select("event", "target", "part").distinct(), "target", "part")
    assert {c: events[(c, "train")] for c in (-1, 0, 1)} == plain_quotas({-1: 14, 0: 13, 1: 13}, 0.3)


def test_folds_are_even(spark):
    df = labelled(spark, {-1: 17, 0: 17, 1: 16})
    dealt = pp.assign_folds(df, "target", ["id"], 5)
    assert counts_of(dealt, "fold") == {i: 10 for i in range(5)}
    for n in counts_of(dealt, "target", "fold").values():
        assert n in (3, 4)


def test_scaler_is_population_and_keeps_constants(spark, tmp_path):
    data = [(float(i), 3.0, float(i * i)) for i in range(7)]
    train = spark.createDataFrame(data, "a double, b double, c double")
    test = spark.createDataFrame([(10.0, 5.0, 1.0)], "a double, b double, c double")
    a, b, scaler = pp.standardize(train, test, ["a", "b", "c", "a"])
    x = np.array(data)
    want = np.column_stack([(x[:, i] - x[:, i].mean()) / (x[:, i].std() or 1.0) for i in (0, 1, 2, 0)])
    got = np.array([r["features"].toArray() for r in a.orderBy("a").collect()])
    assert np.allclose(got, want)
    assert np.allclose(b.first()["features"].toArray(), [(10 - 3) / 2, 2.0, (1 - x[:, 2].mean()) / x[:, 2].std(), 3.5])
    writers.save_model(scaler, str(tmp_path / "s"))
    again = PipelineModel.load(str(tmp_path / "s")).transform(test).first()["features"]
    assert np.allclose(again.toArray(), b.first()["features"].toArray())


def test_one_hot_and_feature_list(spark):
    df = spark.createDataFrame([("positive", 0.5, 1.0), ("negative", -0.5, 2.0)], "sentiment string, sentiment_score double, pre_rsi double")
    wide = pp.one_hot(df, "sentiment")
    assert [c for c in wide.columns if c.startswith("sentiment_")] == ["sentiment_score", "sentiment_negative", "sentiment_positive"]
    assert pp.feature_columns(wide) == ["sentiment_score", "pre_rsi", "sentiment_score", "sentiment_negative", "sentiment_positive"]
    assert pp.feature_columns(wide, dedupe=True) == ["sentiment_score", "pre_rsi", "sentiment_negative", "sentiment_positive"]
    fixed = pp.one_hot(df, "sentiment", ["neutral", "positive"])
    assert rows(fixed, "sentiment_neutral", "sentiment_positive") == [(0.0, 0.0), (0.0, 1.0)]


# ---- metrics


PREDS = "true int, pred int"


def confusion_rows(spark, table, classes=(-1, 0, 1)):
    return spark.createDataFrame(
        [(t, p) for t, row in zip(classes, table) for p, n in zip(classes, row) for _ in range(n)], PREDS
    )


def test_published_confusions_give_published_accuracies(spark):
    # counts and accuracies of the published runs
    for table, right in [
        ([[27, 7, 6], [10, 36, 0], [6, 5, 11]], 74),
        ([[12, 28, 0], [10, 34, 2], [4, 16, 2]], 48),
        ([[25, 13, 2], [4, 41, 1], [2, 5, 15]], 81),
        ([[13, 15, 12], [14, 16, 16], [8, 5, 9]], 38),
    ]:
        preds = confusion_rows(spark, table)
        assert el.accuracy(preds).first()["accuracy"] == pytest.approx(right / 108)
        back = [list(r)[1:] for r in el.confusion_matrix(preds).collect()]
        assert sorted(back) == sorted(table)


def test_published_report(spark):
    # 88 published test rows: the first two rows of the matrix and the supports fix the third
    preds = confusion_rows(spark, [[12, 15, 0], [4, 38, 0], [4, 12, 3]])
    got = {r["label"]: r for r in el.classification_report(preds).collect()}
    assert got["-1"]["precision"] == pytest.approx(0.6)
    assert got["-1"]["recall"] == pytest.approx(0.4444444444444444)
    assert got["-1"]["f1"] == pytest.approx(0.5106382978723404)
    assert got["0"]["precision"] == pytest.approx(0.5846153846153846)
    assert got["1"]["f1"] == pytest.approx(0.2727272727272727)
    assert got["accuracy"]["f1"] == pytest.approx(0.6022727272727273)
    assert got["macro avg"]["precision"] == pytest.approx(0.7282051282051283)
    assert got["macro avg"]["f1"] == pytest.approx(0.4978819814771296)
    assert got["weighted avg"]["precision"] == pytest.approx(0.679020979020979)
    assert got["weighted avg"]["support"] == 88


def test_class_never_predicted(spark):
    preds = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], PREDS)
    got = {r["label"]: r for r in el.classification_report(preds).collect()}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["f1"]) == (0.0, 0.0, 0.0)
    matrix = el.confusion_matrix(preds)
    assert matrix.columns == ["label", "Pred_Stable", "Pred_Up"]
    assert rows(matrix) == [("True_Stable", 1, 0), ("True_Up", 2, 0)]
    full = el.confusion_matrix(preds, [-1, 0, 1])
    assert rows(full)[0] == ("True_Down", 0, 0, 0)


def test_class_only_predicted(spark):
    preds = spark.createDataFrame([(1, 5), (1, 1)], PREDS)
    assert rows(el.confusion_matrix(preds)) == [("True_5", 0, 0), ("True_Up", 1, 1)]
    got = {r["label"]: r for r in el.classification_report(preds).collect()}
    assert got["5"]["support"] == 0 and got["5"]["recall"] == 0.0


def test_compare_and_best_with_tie(spark):
    stacked = rp.stack_predictions({
        "b": spark.createDataFrame([(1, 1), (0, 1)], PREDS),
        "a": spark.createDataFrame([(1, 0), (0, 0)], PREDS),
        "c": spark.createDataFrame([(1, 0), (0, 1)], PREDS),
    })
    table = el.compare(stacked)
    assert [tuple(r) for r in table.collect()] == [("a", 0.5), ("b", 0.5), ("c", 0.0)]
    assert rows(el.best_model(table), "model") == [("a",), ("b",)]


def test_accuracy_tables(spark):
    stacked = rp.stack_predictions({
        "x": spark.createDataFrame([(1, 1), (0, 1), (1, 0)], PREDS),
        "y": spark.createDataFrame([(0, 0)], PREDS),
    })
    wide = rp.accuracy_by_class(stacked)
    assert [tuple(r) for r in wide.collect()] == [(0, 0.0, 1.0), (1, 0.5, None)]
    long = rp.accuracy_vs_baseline(wide)
    assert long.count() == 6
    assert rows(long.where("class = 'Up'"), "model", "accuracy") == [(rp.BASELINE, 1 / 3), ("x", 0.5), ("y", None)]


@pytest.mark.parametrize("seed,cuts", [(1, 64), (2, 4), (3, 2), (4, 64)])
def test_quantiles_equal_numpy(spark, seed, cuts):
    rng = random.Random(seed)
    draw = {1: lambda: rng.gauss(0, 1), 2: lambda: float(rng.randrange(4)), 3: lambda: rng.expovariate(1) ** 4, 4: lambda: 0.0 if rng.random() < 0.6 else rng.random()}[seed]
    data = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(3)}", draw()) for _ in range(700)] + [("one", 5.0), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    got = {r["k"]: [r["q0"], r["q1"], r["q2"]] for r in exact_quantiles(value_counts(df, "k", "v"), "k", cuts=cuts).collect()}
    for k in {k for k, _ in data}:
        want = np.quantile([v for k2, v in data if k2 == k], [0.25, 0.5, 0.75])
        assert np.allclose(got[k], want), k


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 2, 3, 4, 4, 5, 100, 100, -50)] + [("b", 7.0), ("b", None)], "k string, v double")
    stats, outliers = rp.box_stats(df, "k", "v")
    got = {r["k"]: r for r in stats.collect()}
    q = np.quantile([1, 2, 2, 3, 4, 4, 5, 100, 100, -50], [0.25, 0.5, 0.75])
    assert [got["a"]["q25"], got["a"]["median"], got["a"]["q75"]] == pytest.approx(list(q))
    assert (got["a"]["whisker_low"], got["a"]["whisker_high"], got["a"]["n_outliers"]) == (1.0, 5.0, 3)
    assert rows(outliers) == [("a", -50.0, 1), ("a", 100.0, 2)]
    lone = spark.createDataFrame([("c", v) for v in (1.0, 1.0, 1.0, 100.0)], "k string, v double")
    box = rp.box_stats(lone, "k", "v")[0].first()
    assert (box["q75"], box["whisker_high"], box["n_outliers"]) == (25.75, 25.75, 1)
    assert got["b"]["n"] == 1 and got["b"]["whisker_low"] == 7.0


def test_display_tables(spark):
    matrix = el.confusion_matrix(confusion_rows(spark, [[1, 0], [2, 3]], (0, 1))).withColumn("model", F.lit("random_forest"))
    long = rp.confusion_long(matrix)
    assert rows(long, "title", "label", "predicted", "n")[0] == ("Random Forest", "True_Stable", "Pred_Stable", 1.0)
    assert long.count() == 4
    merged = rp.merge_comparisons(spark.createDataFrame([("a", 0.5)], "model string, accuracy double"), spark.createDataFrame([("b", 0.6)], "model string, accuracy double"))
    assert rows(merged) == [("a", 0.5), ("b", 0.6)]


# ---- checks


def passed(df):
    return {r["check"]: (r["violations"], r["passed"]) for r in df.collect()}


def test_checks(spark):
    df = spark.createDataFrame([(0.5, -1, "x"), (1.5, 0, "x"), (None, 1, "x")], "s double, t int, k string")
    got = passed(ck.run_checks(df, [
        ck.in_range(df, "s", -1, 1), ck.in_range(df, "k", 0, 1), ck.in_range(df, "none", 0, 1),
        ck.not_empty(df), ck.has_columns(df, ["s", "q"]), ck.classes_equal(df, "t", [-1, 0, 1]),
        ck.at_least(df, "t", 0),
    ]))
    assert list(got.values()) == [(2, False), (1, False), (1, False), (0, True), (1, False), (0, True), (1, False)]
    assert passed(ck.run_checks(df, [ck.classes_equal(df, "t", [-1, 0])]))["t classes"] == (1, False)
    assert passed(ck.run_checks(df, [ck.classes_equal(df, "t", [-1, 0, 1, 2])]))["t classes"] == (1, False)
    empty = df.limit(0)
    assert passed(ck.run_checks(empty, [ck.not_empty(empty)]))["not empty"] == (1, False)
    with pytest.raises(ValueError):
        ck.group_sizes(df, "k", ["rsi"])
    assert rows(ck.group_sizes(df, "k", ["s"])) == [("x", 3, 2)]


def test_square(spark):
    good = spark.createDataFrame([("a", 1, 2), ("b", 0, 3)], "label string, Pred_x int, Pred_y int")
    bad = spark.createDataFrame([("a", 1, -2)], "label string, Pred_x int, Pred_y int")
    assert all(p for _, p in passed(ck.run_checks(good, ck.square_counts(good))).values())
    assert passed(ck.run_checks(bad, ck.square_counts(bad))) == {"square": (1, False), "no negative cell": (1, False)}


# ---- models


@pytest.fixture(scope="module")
def separable(spark):
    """Three classes told apart by two features, as prepared features would be."""
    rng = random.Random(11)
    kinds = ["negative", "neutral", "positive"]
    data = []
    for i in range(240):
        c = i % 3 - 1
        data.append((f"f{i:04}", c, 0.6 * c + rng.uniform(-0.2, 0.2), kinds[c + 1], 3.0 * c + rng.gauss(0, 0.6), rng.gauss(0, 1), 50 + 10 * c + rng.gauss(0, 3)))
    df = spark.createDataFrame(data, "filing_id string, target int, sentiment_score double, sentiment string, pre_return double, pre_volume_change double, pre_rsi double")
    return prepare(df)


def hit_rate(model, ready):
    return el.accuracy(el.predictions(model.transform(ready.test), ["filing_id"])).first()["accuracy"]


def test_prepared(separable):
    assert separable.folds == 5 and separable.train_rows == 168
    assert separable.names[0] == separable.names[4] == "sentiment_score"
    assert separable.test.count() == 72


def test_random_baseline_repeats_and_is_uniform(spark):
    df = spark.range(3000)
    a = m.random_baseline(df, ["id"])
    assert rows(a) == rows(m.random_baseline(df.repartition(9), ["id"]))
    assert all(900 < n < 1100 for n in counts_of(a, "pred").values())


def test_each_model_beats_chance(spark, separable, tmp_path):
    ready = separable
    fits = {
        "logistic": m.logistic(ready.train_rows).fit(ready.train),
        "forest": m.random_forest(10, 5).fit(ready.train),
        "stumps": m.adaboost(12).fit(ready.train),
        "boosted": m.boosted_trees(maxIter=3, maxDepth=3).fit(ready.train),
        "network": m.network(len(ready.names), epochs=50).fit(ready.train),
    }
    for name, model in fits.items():
        assert hit_rate(model, ready) > 0.8, name
        writers.save_model(model, str(tmp_path / name))
        again = type(model).load(str(tmp_path / name))
        a = rows(el.predictions(model.transform(ready.test), ["filing_id"]))
        assert a == rows(el.predictions(again.transform(ready.test), ["filing_id"])), name
    for name in ("forest", "stumps", "boosted"):
        table = m.importances(spark, fits[name], ready.names).collect()
        assert len(table) == len(ready.names) and all(r["importance"] >= 0 for r in table)
        assert [r["importance"] for r in table] == sorted((r["importance"] for r in table), reverse=True)
    assert m.coefficients(spark, fits["logistic"], ready.names).count() == 3 * len(ready.names)
    history = [r["loss"] for r in m.training_history(spark, fits["network"]).orderBy("step").collect()]
    assert history[-1] < history[0]
    shares = el.probabilities(fits["network"].transform(ready.test), ["filing_id"])
    assert shares.where(F.abs(F.col("Prob_Down") + F.col("Prob_Stable") + F.col("Prob_Up") - 1) > 1e-6).count() == 0
    same = shares.join(el.predictions(fits["network"].transform(ready.test), ["filing_id"]).withColumnRenamed("pred", "p"), "filing_id")
    assert same.where("p <> pred").count() == 0


def plain_stumps(x, y, rounds, classes=3):
    """Boosting of stumps by exhaustive search, for the vote weights of well-split data."""
    w, out = np.ones(len(y)) / len(y), []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            for t in (np.unique(x[:, f])[:-1] + np.unique(x[:, f])[1:]) / 2:
                left = x[:, f] <= t
                sides = [np.bincount(y[s], w[s], classes) for s in (left, ~left)]
                gini = sum(s.sum() - (s**2).sum() / s.sum() for s in sides)
                if best is None or gini < best[0] - 1e-12:
                    best = (gini, f, t, sides[0].argmax(), sides[1].argmax())
        _, f, t, a, b = best
        wrong = np.where(x[:, f] <= t, a, b) != y
        error = w[wrong].sum() / w.sum()
        alpha = math.log((1 - error) / error) + math.log(classes - 1)
        out.append((f, a, b, alpha))
        w = w * np.exp(alpha * wrong)
        w /= w.sum()
    return out


def test_stump_weights_follow_the_rule(spark):
    rng = random.Random(3)
    data = []
    for i in range(60):
        c = i % 3
        # few distinct values, so the library's binned thresholds are the exact ones
        data.append((float(c), [float(c + rng.choice([0, 0, 0, 1])), float(rng.randrange(4))]))
    df = spark.createDataFrame([(y, Vectors.dense(x)) for y, x in data], ["label", "features"])
    model = m.adaboost(5).fit(df)
    want = plain_stumps(np.array([x for _, x in data]), np.array([int(y) for y, _ in data]), 5)
    got = [(int(s[0]), int(s[2]), int(s[3])) for s in model.getStumps()]
    assert got == [w[:3] for w in want]
    assert np.allclose([s[4] for s in model.getStumps()], [w[3] for w in want])


def test_grid_search_takes_first_of_equal_points(spark, separable):
    ready = separable
    found = m.grid_search(m.random_forest(3, 4), {"numTrees": [3, 3]}, ready.train, "fold", ready.folds)
    table = m.search_table(spark, found)
    assert table.count() == 2
    assert found.bestModel.getNumTrees == 3
    boosted = m.grid_search(m.adaboost(2), {"maxIter": [1, 3]}, ready.train, "fold", ready.folds)
    assert len(boosted.avgMetrics) == 2


def test_grids_have_the_searched_sizes(spark):
    assert len(m.param_grid(m.logistic(10), m.logistic_axes(10, 5))) == 5
    assert math.prod(map(len, m.FOREST_GRID.values())) == 81
    assert len(m.param_grid(m.adaboost(), m.ADABOOST_GRID)) == 9
    assert len(m.param_grid(m.boosted_trees(), m.GBT_GRID)) == 108


def test_penalty_of_folds_and_of_the_refit(spark, separable):
    """C stands for the same penalty on a sum loss, whatever the number of rows fitted on."""
    axes = m.logistic_axes(100, 5, {"C": [0.5]})
    assert axes == {"regParam": [1 / (0.5 * 80)]}
    found = m.grid_search(m.logistic(separable.train_rows), m.logistic_axes(separable.train_rows, separable.folds, {"C": [1.0]}), separable.train, "fold", separable.folds)
    again = m.refit_logistic(found, separable.train, separable.train_rows, {"C": [1.0]})
    assert again.getOrDefault(again.regParam) == pytest.approx(1 / separable.train_rows)


def test_whole_run(spark, separable):
    chosen = {
        "Logistic Regression": (m.logistic(separable.train_rows), {"C": [1.0, 10.0]}),
        "AdaBoost": (m.adaboost(4), None),
    }
    out = run_classification(separable, chosen)
    table = {r["model"]: r["accuracy"] for r in out.comparison.collect()}
    assert set(table) == {"Random Baseline", "Logistic Regression", "AdaBoost"}
    assert table["Logistic Regression"] > table["Random Baseline"]
    assert out.confusions["AdaBoost"].count() == 3
    assert out.reports["AdaBoost"].count() == 6


def test_group_folds_keep_groups_whole_and_classes_even(spark):
    draw = random.Random(5)
    data, n = [], 0
    for g in range(400):
        kind = draw.choice([-1, 0, 0, 1])
        for _ in range(draw.choice([1, 1, 2, 3, 9]) if g else 300):
            data.append((n, f"t{g % 7}", g, kind))
            n += 1
    df = spark.createDataFrame(data, "id long, t string, g long, target int")
    got = [r.asDict() for r in pp.assign_folds(df, "target", ["id"], 4, group_cols=["t", "g"]).collect()]
    assert len(got) == n and {r["fold"] for r in got} == {0, 1, 2, 3}
    assert len({(r["t"], r["g"], r["fold"]) for r in got}) == 400
    for kind in (-1, 0, 1):
        sizes = [sum(r["fold"] == f and r["target"] == kind for r in got) for f in range(4)]
        largest = max(sum(d[2] == g for d in data if d[3] == kind) for g in range(400))
        assert max(sizes) - min(sizes) <= largest
    again = pp.assign_folds(df.repartition(9), "target", ["id"], 4, group_cols=["t", "g"])
    assert rows(again, "id", "fold") == sorted((r["id"], r["fold"]) for r in got)


def test_folds_of_mixed_groups(spark):
    """A group counts for its most frequent class, of equal ones the smallest; a null in a key joins no group."""
    df = spark.createDataFrame([(i, i // 4, (i % 4) // 2) for i in range(64)], "id long, g long, target int")
    got = pp.assign_folds(df, "target", ["id"], 4, group_cols=["g"]).collect()
    assert len({(r["g"], r["fold"]) for r in got}) == 16
    assert {sum(r["fold"] == f for r in got) for f in range(4)} == {16}




def test_tables_of_fits_are_spread(spark):
    """A table of many rows in one part comes in several, the same rows; a small one stays."""
    df = spark.range(4 * study.TASK_ROWS).coalesce(1).selectExpr("id AS k", "id % 7 AS v")
    out = study.spread(df, 4 * study.TASK_ROWS, ["k"])
    assert out.rdd.getNumPartitions() == 4 and max(out.rdd.glom().map(len).collect()) < 2 * study.TASK_ROWS
    assert out.exceptAll(df).count() == df.exceptAll(out).count() == 0
    assert study.spread(df, 2 * study.TASK_ROWS - 1, ["k"]) is df


def test_forest_rows_keep_their_nodes():
    assert m.random_forest().getCacheNodeIds()
