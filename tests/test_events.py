"""As-of join, windows around an event, and the feature table against pandas."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_series import SCHEMA, assert_close, pandas_indicators, random_bars

from tonetape.functions.labels import class_name, decode_label, encode_label, label_move
from tonetape.operators.asof import asof_forward
from tonetape.operators.events import (
    build_features,
    covered,
    event_windows,
    post_return,
    pre_window,
    quarter_anchor,
)

DAY = dt.date


def test_label_edges(spark):
    df = spark.createDataFrame([(1.0,), (1.0001,), (-1.0,), (-1.0001,), (None,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(label_move("x")).collect()]
    assert got == [0, 1, 0, -1, None, None]


def test_codes_and_names(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (7,)], "c int")
    got = df.select(encode_label("c").alias("e"), class_name("c").alias("n"))
    back = got.select("e", "n", decode_label("e").alias("b")).collect()
    assert [tuple(r) for r in back] == [(0.0, "Down", -1), (1.0, "Stable", 0), (2.0, "Up", 1), (0.0, "7", -1)]
    assert spark.range(1).select(decode_label(F.lit(9))).first()[0] == 0


def test_anchor(spark):
    df = spark.createDataFrame([(2021, 1), (2021, 2), (2021, 3), (2021, 4), (1899, 1), (2101, 1), (2021, 0), (2021, 5)], "year int, quarter int")
    got = [r[0] for r in df.select(quarter_anchor("year", "quarter")).collect()]
    assert got[:4] == [DAY(2021, 2, 15), DAY(2021, 5, 15), DAY(2021, 8, 15), DAY(2021, 11, 15)]
    assert got[4:] == [None] * 4


@pytest.mark.parametrize("width", [2, 512])
def test_asof_on_the_day_weekend_and_past_end(spark, width):
    right = spark.createDataFrame([("A", DAY(2021, 1, d), d) for d in (8, 11, 12, 20)], "k string, d date, v int")
    left = spark.createDataFrame(
        [(1, "A", DAY(2021, 1, 8)), (2, "A", DAY(2021, 1, 9)), (3, "A", DAY(2021, 1, 21)),
         (4, "B", DAY(2021, 1, 8)), (5, "A", None), (6, "A", DAY(2021, 1, 13)), (7, "A", DAY(2021, 1, 9))],
        "id int, k string, at date",
    )
    inner = asof_forward(left, right, ["k"], "at", "d", width=width)
    assert rows(inner, "id", "v") == [(1, 8), (2, 11), (6, 20), (7, 11)]
    outer = asof_forward(left, right, ["k"], "at", "d", how="left", width=width)
    assert rows(outer, "id", "v") == [(1, 8), (2, 11), (3, None), (4, None), (5, None), (6, 20), (7, 11)]
    near = asof_forward(left, right, ["k"], "at", "d", tolerance=2, width=width)
    assert rows(near, "id", "v") == [(1, 8), (2, 11), (7, 11)]


def test_asof_gives_one_row_per_left_row(spark):
    """Right rows that tie in key and time: the smallest by the other columns."""
    left = spark.createDataFrame([("a", 1, 10), ("a", 2, 10)], "k string, id int, day int").selectExpr("k", "id", "date_add(date'2020-01-01', day) AS at")
    right = spark.createDataFrame([("a", 12, "y", 1), ("a", 12, "x", 2), ("a", 12, "x", 1), ("a", 30, "z", 0)], "k string, day int, v string, w int")
    right = right.selectExpr("k", "date_add(date'2020-01-01', day) AS d", "v", "w")
    assert rows(asof_forward(left, right, ["k"], "at", "d"), "id", "v", "w") == [(1, "x", 1), (2, "x", 1)]


@pytest.mark.parametrize("seed,width", [(1, 3), (2, 50), (3, 512)])
def test_asof_equals_pandas(spark, seed, width):
    rng = random.Random(seed)
    day = lambda: DAY(2020, 1, 1) + dt.timedelta(days=rng.randrange(400))
    # key 'a' holds most rows of both sides
    key = lambda: rng.choice("aaaab")
    left = [(i, key(), day()) for i in range(300)]
    right = sorted({(key(), day()) for _ in range(80)})
    got = asof_forward(
        spark.createDataFrame(left, "id int, k string, at date"),
        spark.createDataFrame(right, "k string, d date"),
        ["k"], "at", "d", how="left", width=width,
    )
    want = [(i, min((d for k2, d in right if k2 == k and d >= at), default=None)) for i, k, at in left]
    assert sorted(rows(got, "id", "d")) == sorted(want)


def bars_on(spark, days, returns=None):
    data = [("A", d, 1.0 if returns is None else returns[i], 2.0, 50.0 + i) for i, d in enumerate(days)]
    return spark.createDataFrame(data, "ticker string, d date, daily_return double, volume_change double, rsi double")


@pytest.mark.parametrize("width", [4, 512])
def test_next_bar_five_or_six_days_later(spark, width):
    kept = post_return(bars_on(spark, [DAY(2021, 1, 1), DAY(2021, 1, 6), DAY(2021, 1, 12)], [1.0, 2.0, 3.0]), width=width)
    assert rows(kept, "d", "return_1d") == [(DAY(2021, 1, 1), 2.0)]


@pytest.mark.parametrize("width", [4, 512])
def test_pre_window_bounds(spark, width):
    days = [DAY(2021, 1, 1), DAY(2021, 1, 8), DAY(2021, 1, 16)]
    got = rows(pre_window(bars_on(spark, days, [5.0, 6.0, 7.0]), width=width), "d", "pre_return", "pre_rsi")
    # seven days back is in, the day itself and eight days back are out
    assert got == [(days[0], None, None), (days[1], 5.0, 50.0), (days[2], None, None)]


def plain_features(bars, tone, up=1.0, down=-1.0):
    """The study in pandas: windows per bar by position, then a forward merge of anchors."""
    wide = []
    for _, part in bars.groupby("ticker"):
        at = np.array([d.toordinal() for d in part["d"]])
        low = np.searchsorted(at, at - 7)
        part = part.assign(
            day=pd.to_datetime(part["d"]),
            return_1d=part["daily_return"].shift(-1),
            near=np.append(np.diff(at) <= 5, False),
            pre_return=[part["daily_return"].iloc[i:j].mean() for j, i in enumerate(low)],
            pre_volume_change=[part["volume_change"].iloc[i:j].mean() for j, i in enumerate(low)],
            pre_rsi=[part["rsi"].iloc[j - 1] if i < j else np.nan for j, i in enumerate(low)],
        )
        wide.append(part)
    wide = pd.concat(wide).drop(columns="ts").sort_values("day")
    asked = pd.DataFrame(tone, columns=["ticker", "company", "year", "quarter", "score", "kind", "filing_id"])
    asked = asked[asked["year"].between(1900, 2100) & asked["quarter"].between(1, 4)]
    asked = asked.assign(
        anchor=pd.to_datetime(dict(year=asked["year"], month=3 * asked["quarter"] - 1, day=15))
    ).astype({"anchor": wide["day"].dtype})
    out = pd.merge_asof(
        asked.sort_values("anchor"), wide, left_on="anchor", right_on="day", by="ticker", direction="forward"
    )
    out = out[out["near"].eq(True) & out["return_1d"].notna()]
    target = (out["return_1d"] > up).astype(int) - (out["return_1d"] < down).astype(int)
    return out.assign(target=target, report_date=out["d"])


@pytest.mark.parametrize("seed,width", [(1, 9), (2, 64), (5, 512)])
def test_features_equal_pandas(spark, seed, width):
    data = random_bars(seed, tickers=3, n=260)
    rng = random.Random(seed)
    tone = []
    for i in range(150):
        year = rng.choice([1900, 2015, 2020, 2021, 2021, 2022, 2022, 2023, 2024, 2030, 2200])
        ticker = rng.choice(["T0", "T0", "T0", "T1", "T2", "NONE"])
        tone.append((ticker, "Co", year, rng.choice([0, 1, 2, 3, 4, 4, 5]), rng.uniform(-1, 1), "neutral", f"f{i:03}"))
    schema = "ticker string, company string, year int, quarter int, sentiment_score double, sentiment string, filing_id string"
    got = build_features(spark.createDataFrame(tone, schema), spark.createDataFrame(data, SCHEMA), width=width)
    got = got.toPandas().sort_values("filing_id").reset_index(drop=True)
    want = plain_features(pandas_indicators(data), tone).sort_values("filing_id").reset_index(drop=True)
    assert len(want) > 20
    assert list(got["filing_id"]) == list(want["filing_id"])
    assert list(got["report_date"]) == list(want["report_date"])
    assert list(got["target"]) == list(want["target"])
    assert_close(got, want, ["return_1d", "pre_return", "pre_volume_change", "pre_rsi"])


def test_event_day_equals_asof(spark):
    """The lag form of the search gives what the general as-of join gives."""
    bars = spark.createDataFrame(random_bars(8, n=300, nulls=0.0), SCHEMA)
    days = event_windows(bars).select("ticker", "quarter_number", "report_date")
    asked = days.select(
        "ticker",
        F.col("quarter_number"),
        F.make_date(F.floor(F.col("quarter_number") / 4).cast("int"), (F.col("quarter_number") % 4 + 1) * 3 - 1, F.lit(15)).alias("anchor"),
    )
    found = asof_forward(asked, bars.select("ticker", F.col("d").alias("bar_date")), ["ticker"], "anchor", "bar_date")
    assert rows(days, "ticker", "quarter_number", "report_date") == rows(found, "ticker", "quarter_number", "bar_date")


def test_covered(spark):
    tone = spark.createDataFrame([("A", 1), ("B", 2)], "ticker string, x int")
    bars = spark.createDataFrame([("A", 1), ("A", 2)], "ticker string, y int")
    assert rows(covered(tone, bars)) == [("A", 1)]
