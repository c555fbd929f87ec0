"""Readers and writers on small folders."""

import datetime as dt
import math
from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F

from tonetape.operators.evaluate import confusion_matrix
from tonetape.operators.sentiment import keyword_sentiment, companies_dim
from tonetape.operators.series import price_indicators
from tonetape.plans.study import study_features
from tonetape.sources import readers, writers


def put(path, text, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def test_prices(spark, tmp_path):
    put(tmp_path / "AAPL_prices.csv", "Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n"
        "2021-01-04 00:00:00-05:00,1,2,0.5,1.5,100,0.0,0.0\n2021-01-05 00:00:00-05:00,1,2,0.5,,100,0.0,0.0\n")
    put(tmp_path / "MSFT_prices.csv", ",Open,High,Low,Close,Volume\n2021-01-04,1,2,0.5,nan,7\nbad,1,2,3,4,5\n")
    put(tmp_path / "AAPL_earnings_dates.csv", "x\n1\n")
    got = rows(readers.read_prices(spark, str(tmp_path)), "ticker", "d", "close", "volume")
    day = dt.date(2021, 1, 4)
    assert got == [("AAPL", day, 1.5, 100.0), ("AAPL", dt.date(2021, 1, 5), None, 100.0), ("MSFT", day, None, 7.0)]


def test_event_dates(spark, tmp_path):
    put(tmp_path / "AAPL_earnings_dates.csv", "Earnings Date,Earnings Date,EPS Estimate,Reported EPS,Surprise(%)\n"
        "2021-01-31 16:00:00-05:00,2021-01-31,1.0,,0.1\n")
    got = readers.read_event_dates(spark, str(tmp_path)).first()
    assert got["ticker"] == "AAPL" and got["eps_estimate"] == 1.0 and got["reported_eps"] is None
    hour = readers.read_event_dates(spark, str(tmp_path)).select(F.hour("ts")).first()[0]
    assert hour == 21


def test_between_dates_is_pushed_down(spark, tmp_path):
    data = [(i, dt.date(2021, 1, 1) + dt.timedelta(days=i)) for i in range(10)]
    spark.createDataFrame(data, "i int, d date").write.parquet(str(tmp_path / "t"))
    kept = readers.between_dates(spark.read.parquet(str(tmp_path / "t")), "d", "2021-01-02", "2021-01-04")
    assert rows(kept, "i") == [(1,), (2,), (3,)]
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d" in kept._jdf.queryExecution().executedPlan().toString()


def tree(tmp_path):
    root = tmp_path / "filings"
    put(root / "AAPL/8-K/0001/b.txt", "second")
    put(root / "AAPL/8-K/0001/a.txt", b"x : 20210415\r\ngain \xff\xfe growth\rloss")
    put(root / "AAPL/8-K/0002/only.txt", "x : 20220715\nloss é")
    put(root / "MSFT/8-K/0001/f.txt", "x : 20220715\nprofit")
    put(root / "MSFT/8-K/empty/readme.md", "skip")
    put(root / "MSFT/10-K/0001/f.txt", "other form")
    return str(root)


def test_filings(spark, tmp_path):
    got = rows(readers.read_filing_tree(spark, tree(tmp_path)), "ticker", "filing_id", "text")
    assert got == [
        ("AAPL", "0001", "x : 20210415\ngain  growth\nloss"),
        ("AAPL", "0002", "x : 20220715\nloss é"),
        ("MSFT", "0001", "x : 20220715\nprofit"),
    ]


def test_filing_table(spark, tmp_path):
    path = str(tmp_path / "archive")
    data = [("AAPL", "1", "b", "later"), ("AAPL", "1", "a", "x\r\ny\rz"), ("MSFT", "1", "c", "only"), ("MSFT", "2", "d", "one"), ("MSFT", "2", "d", "two")]
    spark.createDataFrame(data, "ticker string, filing_id string, path string, text string").write.parquet(path)
    got = rows(readers.read_filings(spark, path), "ticker", "filing_id", "path", "text")
    assert got == [("AAPL", "1", "a", "x\ny\nz"), ("MSFT", "1", "c", "only"), ("MSFT", "2", "d", "one"), ("MSFT", "2", "d", "two")]


def test_result_files_with_missing_classes_and_text_keys(spark, tmp_path):
    """Columns are found by name in each file, and keys keep their type."""
    preds = spark.createDataFrame([("f-1", -1, 1), ("f-2", 1, 1)], "filing_id string, true int, pred int")
    writers.write_result(confusion_matrix(preds), str(tmp_path), "Two", "confusion")
    writers.write_result(preds, str(tmp_path), "Two", "predictions")
    put(tmp_path / "neural_networks" / "ffnn_confusion.csv", ",Pred_Up,Pred_Down\nTrue_Up,4,5\n")
    put(tmp_path / "neural_networks" / "ffnn_probabilities.csv", ",Prob_Down,Prob_Up\nf-9,0.25,0.75\n")
    put(tmp_path / "neural_networks" / "model_comparison.csv", "Model,Accuracy\nFFNN,0.6\n")
    read = lambda kind: readers.read_results(spark, str(tmp_path), kind, key="string")
    cells = ("model", "label", "Pred_Down", "Pred_Stable", "Pred_Up")
    assert rows(read("confusion"), *cells) == [("two", "True_Down", 0.0, 0.0, 1.0), ("two", "True_Up", 0.0, 0.0, 1.0)]
    assert rows(read("predictions"), "row", "true", "pred") == [("f-1", -1, 1), ("f-2", 1, 1)]
    assert rows(read("network_confusion"), *cells) == [("ffnn", "True_Up", 5.0, 0.0, 4.0)]
    assert rows(read("network_probabilities"), "model", "row", "Prob_Down", "Prob_Stable", "Prob_Up") == [("ffnn", "f-9", 0.25, 0.0, 0.75)]
    assert rows(read("network_comparison"), "model", "accuracy") == [("FFNN", 0.6)]


def test_study_from_files(spark, tmp_path):
    """Files in, labelled feature rows out, and back from every format."""
    start = dt.date(2021, 5, 3)
    for ticker in ("AAPL", "MSFT"):
        lines = [f"{start + dt.timedelta(days=i)},1,1,1,{100 + (i % 7) * (2 if ticker == 'AAPL' else 0.1)},{1000 + i}" for i in range(500)]
        put(tmp_path / "prices" / f"{ticker}_prices.csv", ",Open,High,Low,Close,Volume\n" + "\n".join(lines))
    bars = readers.read_prices(spark, str(tmp_path / "prices"))
    features = study_features(readers.read_filing_tree(spark, tree(tmp_path)), bars, companies_dim(spark))
    got = rows(features, "ticker", "filing_id", "report_date", "target")
    assert got == [
        ("AAPL", "0001", dt.date(2021, 5, 15), -1 if got[0][3] == -1 else 1),
        ("AAPL", "0002", dt.date(2022, 8, 15), got[1][3]),
        ("MSFT", "0001", dt.date(2022, 8, 15), 0),
    ]
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / f"features_{fmt}")
        writers.write_table(features, path, fmt)
        assert rows(readers.read_features(spark, path, fmt)) == rows(features)
    path = str(tmp_path / "indicators")
    table = price_indicators(bars)
    writers.write_indicators(table, path)
    back = spark.read.parquet(path)
    assert rows(back.where("ticker = 'AAPL'"), "d", "rsi") == rows(table.where("ticker = 'AAPL'"), "d", "rsi")
    assert "PartitionFilters: [isnotnull(ticker" in back.where("ticker = 'AAPL'")._jdf.queryExecution().executedPlan().toString()


def test_result_files(spark, tmp_path):
    root = tmp_path / "results"
    put(root / "xgboost_confusion.csv", ",Pred_Down,Pred_Stable,Pred_Up\nTrue_Down,1,2,3\n")
    put(root / "random_forest_predictions.csv", ",true,pred\n5,0,-1\n")
    put(root / "random_forest_feature_importance.csv", "Feature,Importance\na,0.5\n")
    put(root / "random_forest_tuned_feature_importance.csv", "Feature,Importance\na,0.6\n")
    put(root / "adaboost_feature_importance.csv", "Feature,Importance\na,0.7\n")
    put(root / "logistic_regression_coefficients_up.csv", "Feature,Coefficient\na,-0.5\n")
    put(root / "model_comparison.csv", "Model,Accuracy\nXGBoost,0.9\n")
    read = lambda kind: readers.read_results(spark, str(root), kind)
    assert rows(read("confusion"), "model", "label", "Pred_Up") == [("xgboost", "True_Down", 3.0)]
    assert rows(read("predictions"), "model", "row", "true", "pred") == [("random_forest", 5, 0, -1)]
    assert rows(read("coefficients"), "class", "coefficient") == [("up", -0.5)]
    assert rows(read("comparison"), "model", "accuracy") == [("XGBoost", 0.9)]
    shown = read("feature_importance")
    assert rows(shown, "model", "importance") == [("Random Forest", 0.5), ("Random Forest", 0.6), ("adaboost", 0.7)]
    assert shown.select("path").distinct().count() == 3


def test_write_results(spark, tmp_path):
    preds = spark.createDataFrame([(1, 1), (0, 1)], "true int, pred int")
    path = writers.write_result(confusion_matrix(preds, [-1, 0, 1]), str(tmp_path), "Random Forest", "confusion")
    assert path.endswith("random_forest_confusion.csv")
    back = readers.read_results(spark, str(tmp_path), "confusion")
    assert rows(back, "model", "label", "Pred_Up") == [("random_forest", "True_Down", 0.0), ("random_forest", "True_Stable", 1.0), ("random_forest", "True_Up", 1.0)]
    writers.write_report(preds, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 2


def test_prefer(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    assert rows(readers.prefer(a, b)) == [(1,)]
    assert rows(readers.prefer(a.limit(0), b)) == [(2,)]
    assert rows(readers.prefer(None, b)) == [(2,)]


def test_text_is_scored_in_one_unshuffled_pass(spark, tmp_path):
    """Neither tone job moves a text, and only the columns used are read."""
    from tonetape.operators.sentiment import document_sentiment

    path = str(tmp_path / "filings")
    spark.createDataFrame(
        [("AAPL", "1", "p", "x : 20210415\ngain", "unused")],
        "ticker string, filing_id string, path string, text string, more string",
    ).write.parquet(path)
    filings = spark.read.parquet(path)
    for job in (keyword_sentiment, document_sentiment):
        out = job(filings, companies_dim(spark))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SinglePartition" not in plan
        assert "more" not in plan
        assert out.count() == 1


def test_no_files_is_no_rows(spark, tmp_path):
    assert readers.read_prices(spark, str(tmp_path)).count() == 0
    assert readers.read_event_dates(spark, str(tmp_path / "none")).count() == 0
    for kind in readers.RESULT_KINDS:
        assert readers.read_results(spark, str(tmp_path), kind).count() == 0


def test_filing_tree_written_by_tasks(spark, tmp_path):
    """The files the partitioned writer leaves, read back as one row per filing; session settings stay."""
    filings = [("A", 1, "x\ny"), ("A", 2, None), ("B/c", 1, "é " * 300), (None, 7, ""), ("A", 1, "twice")]
    df = spark.createDataFrame(filings, "ticker string, filing_id long, text string").coalesce(1)
    ours, usual = str(tmp_path / "ours"), str(tmp_path / "usual")
    assert writers.write_filing_tree(df, ours) == 4
    rest = df.select("ticker", F.lit("8-K").alias("form"), "filing_id", F.col("text").alias("value"))
    rest.write.partitionBy("ticker", "form", "filing_id").text(usual)
    names = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    got = [{(r.ticker, r.filing_id): r.text for r in readers.read_filing_tree(spark, at).collect()} for at in (ours, usual)]
    folders = [sorted(str(p.parent.relative_to(at)) for p in Path(at).rglob("*.txt")) for at in (ours, usual)]
    assert folders[0] == folders[1]
    # Rows of one key come in either order.
    both = [{k: sorted(v.split("\n")) for k, v in x.items()} for x in got]
    assert both[0] == both[1] and len(both[0]) == 4
    assert got[0]["A", "2"] == "\n" and "twice" in both[0]["A", "1"]
    assert [spark.conf.get(n) for n in names] == before


def test_filing_tree_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Tasks list and read what Spark's own listing shows, whatever the names; roots may be patterns."""
    root = tmp_path / "a tree%20"
    shown = ["ticker=A/form=8-K/filing_id=1/b.txt", "B/8-K/2/x.txt", "deep/er/C/8-K/3/x y.txt", "ticker=A/form=8-K/filing_id=_4/_k=v.txt", "x=y=D/8-K/5/1.txt", "E=/8-K/6/1.txt"]
    other = ["B/8-K/2/_x.txt", "B/8-K/2/.x.txt", "B/8-K/_2/x.txt", "B/8-K/2/a.csv", "B/8-K/2/w.txt._COPYING_", "B/10-K/2/x.txt", "B/x.txt", "x.txt"]
    for i, name in enumerate(shown + other):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"t%d\r\nz\xff" % i)
    # An empty file and a link to nothing are passed over, though their paths are less.
    (root / "B/8-K/2/a.txt").touch()
    (root / "B/8-K/2/b.txt").symlink_to(root / "none")
    columns = ("ticker", "filing_id", "path", "text")
    ours, many = (rows(readers.read_filing_tree(spark, str(at)), *columns) for at in (root, tmp_path / "a*"))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(str(root))
    found = readers._listed(spark, *readers._roots(spark, str(root)))
    assert sorted(r.path for t in found for r in t.where("NOT folder").collect()) == sorted(r.path for r in listed.select("path").collect())
    assert [(r[0], r[1], r[3]) for r in ours] == [("A", "1", "t0\nz"), ("A", "_4", "t3\nz"), ("B", "2", "t1\nz"), ("C", "3", "t2\nz"), ("D", "5", "t4\nz")]
    monkeypatch.setattr(readers, "_roots", lambda *_: None)
    assert ours == many == rows(readers.read_filing_tree(spark, str(root)), *columns)


def test_filing_tree_in_batches(spark, tmp_path, monkeypatch):
    """Small batches and many tasks read the same filings; tasks begin at different tickers."""
    df = spark.createDataFrame([(f"T{i % 7}", i, f"text {i}") for i in range(300)], "ticker string, filing_id long, text string")
    filings = df.repartition(3)
    writers.write_filing_tree(filings, str(tmp_path / "tree"))
    for name, value in (("FOLDERS", 40), ("FILES", 30), ("ROWS", 7), ("BYTES", 20)):
        monkeypatch.setattr(readers, name, value)
    got = rows(readers.read_filing_tree(spark, str(tmp_path / "tree")), "ticker", "filing_id", "text")
    assert got == sorted((f"T{i % 7}", str(i), f"text {i}\n") for i in range(300))
    parts = [{}, {}, {}]
    for p in (tmp_path / "tree").rglob("*.txt"):
        ticker, made = p.parts[-4], parts[int(p.stem[-5:])]
        made[ticker] = min(made.get(ticker, math.inf), p.stat().st_mtime_ns)
    assert len({tuple(sorted(made, key=made.get)) for made in parts}) > 1


def test_filing_tree_is_read_once(spark, tmp_path):
    """Its rows come from a written table, also where a later path is passed over."""
    df = spark.createDataFrame([("A", i, f"t{i}") for i in range(40)], "ticker string, filing_id long, text string")
    writers.write_filing_tree(df.coalesce(1), str(tmp_path / "tree"))
    (tmp_path / "tree/ticker=A/form=8-K/filing_id=3/zz.txt").write_text("later")
    out = readers.read_filing_tree(spark, str(tmp_path / "tree"))
    assert rows(out, "filing_id", "text") == sorted((str(i), f"t{i}\n") for i in range(40))
    assert all(f.endswith(".parquet") for f in out.inputFiles())
