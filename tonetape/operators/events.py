"""The event study: flags, anchors, windows around an event, the feature table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetape.functions.labels import label_move
from tonetape.operators.ordered import DAY, SLICE_DAYS, first_on_or_after, over_series
from tonetape.operators.steps import (
    FILLED,
    FLAG,
    FLAG_ROWS,
    RSI_ROWS,
    flag_steps,
    indicator_steps,
    post_steps,
    pre_steps,
)


# Years taken for real.
FIRST_YEAR, LAST_YEAR = 1900, 2100


def with_starts(bars: DataFrame, events: DataFrame, width: int = SLICE_DAYS) -> DataFrame:
    """Bars with `_start`, 1 on the first bar at or after an event, else 0.

    Times are compared as instants (`ts` on both sides): an announcement after
    the close lands on the next bar.
    """
    starts = (
        first_on_or_after(
            events.select("ticker", F.col("ts").alias("at")).where(F.col("at").isNotNull()),
            bars.select("ticker", F.col("ts").alias("at")),
            ["ticker"],
            width,
        )
        .where(F.col("match").isNotNull())
        .select("ticker", F.col("match").alias("ts"))
        .distinct()
        .withColumn("_start", F.lit(1))
    )
    return bars.join(starts, ["ticker", "ts"], "left").select(
        *bars.columns, F.coalesce("_start", F.lit(0)).alias("_start")
    )


def flag_after(
    bars: DataFrame, events: DataFrame, n: int = FLAG_ROWS, column: str = FLAG, width: int = SLICE_DAYS
) -> DataFrame:
    """1 on the first bar at or after each event and the n - 1 bars after it, else 0."""
    return over_series(
        with_starts(bars, events, width),
        lambda w: flag_steps(w, n, column),
        needs=("_start",),
        before=n - 1,
        width=width,
    ).drop("_start")


def valid_quarter(year, quarter) -> Column:
    return F.col(year).between(FIRST_YEAR, LAST_YEAR) & F.col(quarter).between(1, 4)


def quarter_anchor(year: str, quarter: str, day: int = 15) -> Column:
    """Day `day` of the quarter's middle month; NULL outside 1900-2100 or quarters 1-4."""
    return F.when(
        valid_quarter(year, quarter),
        F.make_date(F.col(year), F.col(quarter) * 3 - 1, F.lit(day)),
    )


def post_return(indicators: DataFrame, days: int = 5, width: int = SLICE_DAYS) -> DataFrame:
    """Return of the bar after each bar, kept where it lies within `days` days."""
    return (
        over_series(
            indicators,
            lambda w: post_steps(w, days),
            needs=("daily_return",),
            after=1,
            width=width,
        )
        .where("has_post")
        .drop("has_post")
    )


def pre_window(indicators: DataFrame, days: int = 7, width: int = SLICE_DAYS) -> DataFrame:
    """Mean return, mean volume change and last RSI over the days before each bar."""
    return over_series(
        indicators,
        lambda w: pre_steps(w, days),
        needs=("daily_return", "volume_change", "rsi"),
        before=days,
        width=width,
    )


def quarter_number(year: str, quarter: str) -> Column:
    """Quarters counted through, so that the anchors of neighbours differ by one."""
    return F.col(year) * 4 + F.col(quarter) - 1


def anchors_passed(date: Column, day: int = 15) -> Column:
    """Quarter number of the last anchor on or before a date."""
    months = F.year(date) * 12 + F.month(date) - 1 - F.when(F.dayofmonth(date) < day, 1).otherwise(0)
    return F.floor((months - 1) / 3).cast("int")


def event_windows(
    bars: DataFrame, pre_days: int = 7, post_days: int = 5, width: int = SLICE_DAYS
) -> DataFrame:
    """One row per (ticker, quarter) with an event day and a bar after it.

    Anchors are a fixed calendar, so the first bar on or after an anchor is the
    bar whose predecessor lies before it: the as-of search needs a lag and no
    join.  A series' first bar answers for every anchor before it.  Indicators,
    both windows and the lag share one pass over the sliced series.
    """
    passed = over_series(
        bars.select("ticker", "d", "close", "volume"),
        lambda w: [
            *indicator_steps(w),
            *post_steps(w, post_days),
            *pre_steps(w, pre_days),
            {"_prev": F.lag(DAY, 1).over(w)},
        ],
        before=pre_days + RSI_ROWS + 1,
        after=1,
        fill=FILLED,
        width=width,
    ).where("has_post")
    first = F.coalesce(
        anchors_passed(F.date_from_unix_date("_prev")) + 1, F.lit(FIRST_YEAR * 4)
    )
    last = anchors_passed(F.col("d"))
    return (
        passed.withColumns({"_first": first, "_last": last})
        .where("_first <= _last")
        .select(
            "ticker",
            F.col("d").alias("report_date"),
            "return_1d",
            "pre_return",
            "pre_volume_change",
            "pre_rsi",
            F.explode(F.sequence("_first", "_last")).alias("quarter_number"),
        )
    )


def covered(sentiment: DataFrame, bars: DataFrame) -> DataFrame:
    """Rows whose ticker has prices."""
    return sentiment.join(bars.select("ticker").distinct(), "ticker", "left_semi")


def labelled(features: DataFrame) -> DataFrame:
    """Rows with a known class."""
    return features.na.drop(subset=["target"])


def build_features(
    sentiment: DataFrame,
    bars: DataFrame,
    up: float = 1.0,
    down: float = -1.0,
    pre_days: int = 7,
    post_days: int = 5,
    width: int = SLICE_DAYS,
) -> DataFrame:
    """One labelled row per filing whose quarter has an event day with a return.

    Filings are read once, and meet one row per (ticker, quarter) in an equi-join
    that adaptive execution broadcasts while the events' measured size allows; past
    that it splits the partition of a quarter that holds too many filings.
    """
    dated = sentiment.where(valid_quarter("year", "quarter")).withColumn(
        "quarter_number", quarter_number("year", "quarter")
    )
    events = event_windows(bars, pre_days, post_days, width).withColumn(
        "target", label_move("return_1d", up, down)
    )
    return dated.join(labelled(events), ["ticker", "quarter_number"]).select(
        "ticker",
        "company",
        "year",
        "quarter",
        "report_date",
        "sentiment_score",
        "sentiment",
        "return_1d",
        "target",
        "pre_return",
        "pre_volume_change",
        "pre_rsi",
        "filing_id",
    )
