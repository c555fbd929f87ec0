"""Indicators against hand-made answers and against pandas, at any slice width."""

import datetime as dt
import math
import random

import pandas as pd
import pytest

from tonetape.operators.events import event_windows, flag_after
from tonetape.operators.ordered import over_series
from tonetape.operators.series import gains_and_losses, price_indicators, volatility
from tonetape.functions.series import rolling_mean

D0 = dt.date(2021, 1, 1)


def bars_of(spark, closes, volumes=None, days=None, ticker="A"):
    volumes = volumes or [100.0 + i for i in range(len(closes))]
    days = days or [D0 + dt.timedelta(days=i) for i in range(len(closes))]
    data = [
        (ticker, dt.datetime.combine(d, dt.time()), d, None if c is None else float(c), v)
        for d, c, v in zip(days, closes, volumes)
    ]
    return spark.createDataFrame(data, "ticker string, ts timestamp, d date, close double, volume double")


def column(df, name):
    return [r[name] for r in df.orderBy("ticker", "d").collect()]


def rsi_of(spark, closes, width=512):
    return column(price_indicators(bars_of(spark, closes), width=width), "rsi")


def test_rsi_rising(spark):
    assert rsi_of(spark, range(1, 17)) == [None] * 13 + [100.0] * 3


def test_rsi_falling(spark):
    assert rsi_of(spark, range(30, 14, -1)) == [None] * 13 + [0.0] * 3


def test_rsi_flat(spark):
    assert rsi_of(spark, [5] * 16) == [None] * 16


@pytest.mark.parametrize("width", [4, 512])
def test_rsi_with_gap(spark, width):
    closes = [1, 2, None, *range(3, 20)]
    assert rsi_of(spark, closes, width) == [None] * 13 + [100.0] * 7


@pytest.mark.parametrize("width", [1, 2, 3, 512])
def test_change_with_pad_and_zero(spark, width):
    bars = bars_of(spark, [1, 2, None, 4, 0, 3])
    got = column(price_indicators(bars, width=width), "daily_return")
    assert got == [None, 100.0, 0.0, 100.0, -100.0, math.inf]


def test_zero_to_zero_is_missing_and_sign_of_infinity(spark):
    bars = bars_of(spark, [0, 0, -2])
    assert column(price_indicators(bars), "daily_return") == [None, None, -math.inf]


@pytest.mark.parametrize("width", [2, 512])
def test_rolling_with_gap(spark, width):
    bars = bars_of(spark, [1, 2, None, 4, 5, 6, 7])
    out = over_series(
        bars, lambda w: [{"m": rolling_mean("close", 3, w)}], needs=("close",), before=2, width=width
    )
    assert column(out, "m") == [None] * 5 + [5.0, 6.0]


def test_gain_and_loss_of_missing_difference(spark):
    out = gains_and_losses(bars_of(spark, [1, 3, None, 2, 1]), width=2)
    assert column(out, "gain") == [0.0, 2.0, 0.0, 0.0, 0.0]
    assert column(out, "loss") == [0.0, 0.0, 0.0, 0.0, 1.0]


def random_bars(seed, tickers=3, n=120, nulls=0.08):
    rng = random.Random(seed)
    data = []
    for t in range(tickers):
        d, price = D0 + dt.timedelta(days=rng.randrange(30)), 100.0
        for _ in range(n):
            d += dt.timedelta(days=rng.choice([1, 1, 1, 1, 3, 6, 40 if rng.random() < 0.1 else 2]))
            price = max(1.0, price + rng.uniform(-4, 4))
            close = None if rng.random() < nulls else round(price, 2)
            volume = None if rng.random() < nulls else float(rng.randrange(1, 500))
            data.append((f"T{t}", dt.datetime.combine(d, dt.time()), d, close, volume))
    return data


SCHEMA = "ticker string, ts timestamp, d date, close double, volume double"


def pandas_indicators(data):
    """The indicator columns, ticker by ticker, on padded and raw series."""
    table = pd.DataFrame(data, columns=["ticker", "ts", "d", "close", "volume"])
    table = table.sort_values(["ticker", "d"], ignore_index=True).astype({"close": float, "volume": float})
    by = table["ticker"]

    def mean(x, n):
        return x.groupby(by).transform(lambda v: v.rolling(n).mean())

    for source, name in (("close", "daily_return"), ("volume", "volume_change")):
        padded = table.groupby("ticker")[source].ffill()
        table[name] = 100 * (padded / padded.groupby(by).shift() - 1)
    table["ma5"], table["ma10"] = mean(table["close"], 5), mean(table["close"], 10)
    step = table.groupby("ticker")["close"].diff().fillna(0.0)
    rise, drop = mean(step.clip(lower=0), 14), mean(-step.clip(upper=0), 14)
    table["rsi"] = 100 * rise / (rise + drop)
    return table


def assert_close(got, want, names):
    assert len(got) == len(want)
    for n in names:
        for a, b in zip(got[n], want[n]):
            if b is None or (isinstance(b, float) and math.isnan(b)):
                assert a is None or math.isnan(a), (n, a, b)
            else:
                assert a == pytest.approx(b, abs=1e-6), (n, a, b)


@pytest.mark.parametrize("seed,width", [(1, 7), (2, 30), (3, 512)])
def test_indicators_equal_pandas(spark, seed, width):
    """Gaps longer than a slice, missing values, several tickers."""
    data = random_bars(seed)
    got = price_indicators(spark.createDataFrame(data, SCHEMA), width=width)
    got = got.toPandas().sort_values(["ticker", "d"]).reset_index(drop=True)
    assert_close(got, pandas_indicators(data), ["daily_return", "volume_change", "ma5", "ma10", "rsi"])


@pytest.mark.parametrize("width", [5, 40])
def test_slices_do_not_change_windows(spark, width):
    bars = spark.createDataFrame(random_bars(9, tickers=4, n=200), SCHEMA)
    plain = event_windows(bars, width=10**6).toPandas()
    sliced = event_windows(bars, width=width).toPandas()
    key = ["ticker", "quarter_number"]
    plain, sliced = (x.sort_values(key).reset_index(drop=True) for x in (plain, sliced))
    assert len(plain) > 0
    pd.testing.assert_frame_equal(plain, sliced)


def test_slices_survive_uneven_coalescing(spark):
    """Both sides of the union must stay aligned when partitions are merged at run time."""
    bars = spark.createDataFrame(random_bars(4, tickers=12, n=300), SCHEMA).repartition(5)
    names = ["daily_return", "rsi", "ma10"]
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    shuffles = "spark.sql.shuffle.partitions"
    try:
        spark.conf.set(size, "16k")
        spark.conf.set(least, "8k")
        spark.conf.set(shuffles, "40")
        got = price_indicators(bars, width=20).toPandas()
    finally:
        spark.conf.unset(size)
        spark.conf.unset(least)
        spark.conf.set(shuffles, "7")
    want = pandas_indicators([tuple(r) for r in bars.collect()])
    got = got.sort_values(["ticker", "d"]).reset_index(drop=True)
    assert_close(got, want, names)


def test_one_exchange_of_the_series(spark, tmp_path):
    """The borrowed rows come from the exchange the slices use, and their union adds none."""
    path = str(tmp_path / "bars")
    spark.createDataFrame(random_bars(5), SCHEMA).write.parquet(path)
    out = event_windows(spark.read.parquet(path), width=30)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    assert plan.count("FileScan") == 1
    above = plan[: plan.index("Union")]
    assert "Exchange hashpartitioning" not in above


def test_volatility(spark):
    data = random_bars(6, nulls=0.0)
    got = volatility(spark.createDataFrame(data, SCHEMA), 5, width=11).toPandas()
    got = got.sort_values(["ticker", "d"]).reset_index(drop=True)
    want = pandas_indicators(data)
    want["volatility"] = want.groupby("ticker")["daily_return"].transform(lambda x: x.rolling(5).std())
    assert_close(got, want, ["volatility"])


def events_of(spark, *days):
    return spark.createDataFrame([("A", d) for d in days], "ticker string, ts timestamp")


def flags(spark, n, events, width=512):
    out = flag_after(bars_of(spark, [1.0] * n), events, width=width)
    assert out.count() == n
    return column(out, "post_earnings")


def at(day, hour=0):
    return dt.datetime.combine(D0, dt.time()) + dt.timedelta(days=day, hours=hour)


@pytest.mark.parametrize("width", [2, 512])
def test_flag_covers_six_rows(spark, width):
    assert flags(spark, 10, events_of(spark, at(2)), width) == [0, 0, 1, 1, 1, 1, 1, 1, 0, 0]


def test_flag_after_close_lands_on_next_bar(spark):
    assert flags(spark, 10, events_of(spark, at(2, 17)))[:4] == [0, 0, 0, 1]


def test_flag_at_series_end(spark):
    assert flags(spark, 10, events_of(spark, at(7), at(40))) == [0] * 7 + [1] * 3


def test_flag_of_overlapping_events(spark):
    assert flags(spark, 12, events_of(spark, at(1), at(4), at(4))) == [0] + [1] * 9 + [0, 0]


def test_flag_column_only_with_events(spark):
    bars = bars_of(spark, [1.0] * 3)
    assert "post_earnings" not in price_indicators(bars).columns
    assert "post_earnings" in price_indicators(bars, events_of(spark, at(1))).columns
