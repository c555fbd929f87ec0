"""Expressions over one ordered price series.

Every function takes a window `w` that is partitioned by series and ordered by
time; frames are set here.  Missing values are NULL, never NaN.
"""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def forward_fill(c, w) -> Column:
    """Last known value up to and including this row."""
    return F.last(_col(c), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)
    )


def pct_change(c, w) -> Column:
    """Percent change (x100) against the previous row of an already filled column.

    Zero before a non-zero value gives a signed infinity, 0/0 is missing.
    """
    c = _col(c)
    prev = F.lag(c, 1).over(w)
    return (
        F.when(prev != 0, (c / F.when(prev != 0, prev) - 1) * 100)
        .when((prev == 0) & (c > 0), F.lit(float("inf")))
        .when((prev == 0) & (c < 0), F.lit(float("-inf")))
    )


def _full(value, c, n, w):
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(frame) == n, value(c).over(frame))


def rolling_mean(c, n, w) -> Column:
    """Mean of the last n rows, missing unless all n hold a value."""
    return _full(F.avg, _col(c), n, w)


def rolling_std(c, n, w) -> Column:
    """Sample standard deviation of the last n rows, missing unless all n hold a value."""
    return _full(F.stddev_samp, _col(c), n, w)


def diff(c, w) -> Column:
    c = _col(c)
    return c - F.lag(c, 1).over(w)


def gain_loss(delta) -> tuple[Column, Column]:
    """Split a difference into gain and loss; a missing difference is 0 in both."""
    delta = _col(delta)
    return (
        F.when(delta > 0, delta).otherwise(F.lit(0.0)),
        F.when(delta < 0, -delta).otherwise(F.lit(0.0)),
    )


def rsi(gain, loss, n, w) -> Column:
    """Relative strength index on simple n-row means of gain and loss."""
    up = rolling_mean(gain, n, w)
    down = rolling_mean(loss, n, w)
    return (
        F.when((up == 0) & (down == 0), F.lit(None).cast("double"))
        .when(down == 0, F.lit(100.0))
        .otherwise(100 - 100 / (1 + F.try_divide(up, down)))
    )
