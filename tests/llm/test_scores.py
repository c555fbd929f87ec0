"""Scorers: held-out accuracy, labels that are not looked at, odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tonetape.llm.quality import quality, statistics
from tonetape.llm.toxicity import FEATURES, INSULTS, YOU, drop_toxic, features, hashes, toxicity

DATA = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable")) + 1
    ones = label == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


CASES = [(toxicity, "toxic", 5, 0, 0.97), (quality, "quality", 3, 1, 0.99)]


@pytest.mark.parametrize("scorer,label,folds,fold,least", CASES)
def test_held_out_accuracy(spark, scorer, label, folds, fold, least):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = scorer(docs, labels).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % folds == fold for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    assert auc(held.score.to_numpy(), held[label].to_numpy()) > least
    assert (held.predicted == held[label]).mean() > 0.97


@pytest.mark.parametrize("scorer,label,folds,fold,least", CASES)
def test_held_out_labels_are_never_looked_at(spark, scorer, label, folds, fold, least):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    other = labels.copy()
    held = np.array([zlib.crc32(str(i).encode()) % folds == fold for i in other.doc_id])
    other.loc[held, label] = 1 - other.loc[held, label]
    runs = [scorer(docs, spark.createDataFrame(x)).toPandas().sort_values("doc_id").score.to_numpy() for x in (labels, other)]
    assert np.array_equal(*runs)


@pytest.mark.parametrize("scorer,label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows(spark, scorer, label):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").limit(400)
    odd = [(None, "no id"), (1, None), (5000, ""), (5001, "x " * 200_000), (5002, " \n"), (5002, " \n")]
    more = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).selectExpr("*", "1 AS score", "'a' AS x", "2 AS label", "3 AS id")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    twice = labels.unionByName(labels.limit(5)).selectExpr("*", "0 AS text")
    got = scorer(more, twice).collect()
    assert len(got) == more.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert scorer(more.limit(0), twice).count() == 0
    none = scorer(more, twice.limit(0)).collect()
    assert len(none) == len(got) and all(r.score == 0 and r.predicted == 0 for r in none)


def test_stage_drops_predicted_rows_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("*", "1 AS score", "2 AS x", "3 AS predicted")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in toxicity(docs, labels).collect() if r.predicted == 0}
    assert {r.doc_id for r in kept.collect()} == want
    # The caller's write sent whole rows to Python 10,000 at a time: 3,008 MB of an executor.
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()


def test_features_of_single_texts():
    texts = ["You are an 1d1ot!!", "idiot", "A calm sentence about trash cans and you", "", None, "STUPID STUPID you", "sooooo calm"]
    whole = features(pa.array(texts), np.zeros(0, np.uint64), np.zeros(0), hashes(INSULTS), hashes(YOU))
    assert whole.shape == (len(texts), len(FEATURES))
    single = np.vstack([features(pa.array([t], pa.string()), np.zeros(0, np.uint64), np.zeros(0), hashes(INSULTS), hashes(YOU)) for t in texts])
    assert np.allclose(whole, single)
    value = lambda t, name: whole[t, FEATURES.index(name)]
    assert value(0, "disguised_insults") > 0 and value(0, "any_insult") == 0
    assert value(1, "insults") == 1 and value(2, "any_insult") == 1
    assert value(2, "insult_near_you") > 0 and value(1, "insult_near_you") == 0
    assert not whole[3].any() and not whole[4].any()
    assert value(5, "all_capitals") > 0 and value(6, "stretched") > 0


def test_statistics_of_single_texts():
    texts = ["Some words. More words!", "", None, "a|b | c %%%", "x x x x y", "\n\n", "é" * 50]
    whole = statistics(pa.array(texts))
    assert np.allclose(whole, np.vstack([statistics(pa.array([t], pa.string())) for t in texts]))
    assert np.isfinite(whole).all()
