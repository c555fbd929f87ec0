"""Category numbers, sparse vectors, long cells and lexicons in one pass."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tonetape.functions import text as tx
from tonetape.operators import categories as ct
from tonetape.operators import evaluate as el
from tonetape.operators import lexicon as lx
from tonetape.operators import prep as pp
from tonetape.operators import sentiment as se


def collects(spark, run):
    """Does `run` bring rows of a table to the driver?"""
    from pyspark.sql import DataFrame

    kept, seen = DataFrame.collect, []
    DataFrame.collect = lambda self: seen.append(self) or kept(self)
    try:
        run()
    finally:
        DataFrame.collect = kept
    return bool(seen)


def test_numbers_are_places_in_order(spark):
    rng = random.Random(5)
    values = [rng.randrange(10**9) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in values + values[:500] + [None]], "v long").repartition(9)
    want = {x: i for i, x in enumerate(sorted(set(values)))}
    assert {r["value"]: r["number"] for r in ct.category_numbers(df, "v").collect()} == want


def test_numbers_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "v string")
    assert ct.category_numbers(df, "v").count() == 0
    with pytest.raises(ValueError):
        ct.category_vectors(df, "v")


def test_vectors_equal_flags(spark):
    data = [(i, v) for i, v in enumerate(["b", "a", None, "c", "b", "", "a b"] * 3)]
    df = spark.createDataFrame(data, "id int, v string")
    flags = {r[0]: list(r[1:]) for r in pp.one_hot(df, "v").collect()}
    got = ct.category_vectors(df, "v").transform(df)
    assert got.columns == ["id", "v", "v_vector"]
    assert {r["id"]: list(r["v_vector"].toArray()) for r in got.collect()} == flags


def test_unseen_values_get_zeros_and_odd_names_work(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], ["id", "a.b"])
    later = spark.createDataFrame([(3, "z"), (4, "y"), (5, None)], "id int, `a.b` string")
    found = ct.category_vectors(df.withColumnRenamed("a.b", "v"), "v").transform(
        later.withColumnRenamed("a.b", "v").withColumn("value", F.lit(0)).withColumn("number", F.lit(1))
    )
    got = {r["id"]: list(r["v_vector"].toArray()) for r in found.collect()}
    assert got == {3: [0, 0], 4: [0, 1], 5: [0, 0]}


def test_many_values_without_a_lookup(spark):
    df = spark.range(100_000).withColumn("v", F.concat(F.lit("k"), F.col("id")))
    out = []
    assert not collects(spark, lambda: out.append(ct.category_vectors(df, "v")))
    assert out[0].size == 100_000
    got = out[0].transform(df.where("id in (0, 77, 99999)"))
    order = {k: i for i, k in enumerate(sorted(f"k{i}" for i in range(100_000)))}
    for r in got.collect():
        assert list(r["v_vector"].indices) == [order[r["v"]]] and r["v_vector"].size == 100_000


def test_one_value_holds_most_rows(spark):
    df = spark.range(30_000).withColumn("v", F.when(F.col("id") < 20_000, 7).otherwise(F.col("id")))
    got = ct.category_vectors(df, "v").transform(df)
    assert got.count() == 30_000
    assert got.where(F.col("v_vector").cast("string").startswith("(10001,[0],")).count() == 20_000


def test_confusion_cells_are_the_matrix(spark):
    rng = random.Random(3)
    data = [(rng.choice([-1, 0, 1]), rng.choice([-1, 1, 1, 5])) for _ in range(400)]
    preds = spark.createDataFrame(data, "true int, pred int")
    cells = ct.confusion_cells(preds).collect()
    places = {c: i for i, c in enumerate(sorted({x for pair in data for x in pair}))}
    assert {(r["true"], r["pred"]): r["n"] for r in cells} == {p: data.count(p) for p in set(data)}
    assert all((r["row"], r["column"]) == (places[r["true"]], places[r["pred"]]) for r in cells)
    matrix = [list(r)[1:] for r in el.confusion_matrix(preds).collect()]
    assert all(matrix[r["row"]][r["column"]] == r["n"] for r in cells)
    for c in {t for t, _ in data}:
        assert sum(r["share"] for r in cells if r["true"] == c) == pytest.approx(1)


def test_confusion_cells_keep_missing_classes(spark):
    preds = spark.createDataFrame([(0, None), (None, 0), (None, None), (0, 0)], "true int, pred int")
    got = rows(ct.confusion_cells(preds), "true", "pred", "row", "column", "n", "share")
    assert sorted(got, key=str) == sorted(
        [(0, 0, 0, 0, 1, 0.5), (0, None, 0, None, 1, 0.5), (None, 0, None, 0, 1, 0.5), (None, None, None, None, 1, 0.5)],
        key=str,
    )


def counted(text, words):
    return sum(text.lower().count(w.lower()) for w in words)


def test_counts_equal_str_count(spark):
    rng = random.Random(11)
    letters = "abé "
    words = {n: ["".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(150)] for n in ("p", "n")}
    texts = ["".join(rng.choices(letters.upper() + letters, k=rng.randint(0, 300))) for _ in range(60)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = df.select("id", lx.lexicon_counts("text", words).alias("c")).collect()
    for r in got:
        t = texts[r["id"]]
        assert (r["c"] and tuple(r["c"])) == (None if t is None else (counted(t, words["p"]), counted(t, words["n"])))


def test_counts_equal_the_expression(spark):
    words = ["anan", "an", "na", "aa", "AN", "xyz"]
    df = spark.createDataFrame([("ananananan aaa aaaa BANANA" * 50,), ("",), ("é",)], "text string")
    got = df.select(tx.lexicon_hits("text", words).alias("a"), lx.lexicon_counts("text", {"w": words})["w"].alias("b"))
    assert all(r["a"] == r["b"] for r in got.collect())


def test_keyword_sentiment_counts_the_same_both_ways(spark):
    head = "<SEC-DOCUMENT>1.txt : 19990310\n"
    data = [("AAPL", i, f"p{i}", t and head + t) for i, t in enumerate(["gain gains loss", "LOSS a", "", None, "growth" * 9])]
    df = spark.createDataFrame(data, "ticker string, filing_id int, path string, text string")
    names = se.companies_dim(spark, {"AAPL": "Apple"})
    dates = {"start": "1995-01-01", "end": "2001-12-31"}
    one, other = (se.keyword_sentiment(df, names, one_pass=x, **dates) for x in (True, False))
    assert rows(one) == rows(other) and one.count() > 0 and one.columns == other.columns
    assert rows(se.keyword_sentiment(df, names, **dates)) == rows(one)


def test_lexicon_edges():
    assert list(lx.counter({"a": [], "b": ["x"]})("xxx")) == [0, 3]
    assert list(lx.counter({"a": []})("xxx")) == [0]
    with pytest.raises(ValueError):
        lx.counter({"a": [""]})


def test_lexicons_of_a_table(spark):
    df = spark.createDataFrame(
        [("p", "Good"), ("p", "good"), ("p", None), ("n", "bad"), ("n", ""), (None, "x")],
        "lexicon string, word string",
    )
    assert lx.read_lexicons(df.where("lexicon is not null")) == {"n": ["bad"], "p": ["good"]}


def test_many_words_cost_about_as_much_as_few():
    import time

    rng = random.Random(2)
    few = ["".join(rng.choices("qxzj", k=6)) for _ in range(24)]
    many = few + ["".join(rng.choices("qxzjkvw", k=7)) for _ in range(1976)]
    text = "the quick brown fox jumps over the lazy dog " * 20_000
    took = {}
    for name, words in (("few", few), ("many", many)):
        run = lx.counter({"w": words})
        best = []
        for _ in range(3):
            start = time.perf_counter()
            run(text)
            best.append(time.perf_counter() - start)
        took[name] = min(best)
    assert took["many"] < 4 * took["few"] + 0.05, took
