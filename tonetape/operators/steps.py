"""Groups of window columns for `over_series`, each group built on the ones before."""

from pyspark.sql import functions as F

from tonetape.functions.series import diff, gain_loss, pct_change, rolling_mean, rsi
from tonetape.operators.ordered import DAY, filled

RSI_ROWS = 14
# columns the indicators read forward-filled
FILLED = ("close", "volume")
# Bars flagged from an event on, and the flag's name.
FLAG_ROWS, FLAG = 6, "post_earnings"


def indicator_steps(w, window: int = RSI_ROWS):
    """Indicator columns in order of need; later groups read earlier ones."""
    gain, loss = gain_loss("_delta")
    return [
        {
            "daily_return": pct_change(filled("close"), w),
            "volume_change": pct_change(filled("volume"), w),
            "ma5": rolling_mean("close", 5, w),
            "ma10": rolling_mean("close", 10, w),
            "_delta": diff("close", w),
        },
        {"_gain": gain, "_loss": loss},
        {"rsi": rsi("_gain", "_loss", window, w)},
    ]


def flag_steps(w, n: int = FLAG_ROWS, column: str = FLAG):
    """The flag: 1 on a start and the n - 1 bars after it."""
    return [{column: F.max("_start").over(w.rowsBetween(-(n - 1), 0))}]


def post_steps(w, days: int = 5):
    """`has_post`: a second bar within `days` calendar days; `return_1d`: its return."""
    return [
        {
            "has_post": F.coalesce(F.lead(DAY, 1).over(w) <= F.col(DAY) + days, F.lit(False)),
            "return_1d": F.when(
                F.lead(DAY, 1).over(w) <= F.col(DAY) + days, F.lead("daily_return", 1).over(w)
            ),
        }
    ]


def pre_steps(w, days: int = 7):
    """Means and last RSI over the bars of the `days` calendar days before each bar."""
    span = w.rangeBetween(-days, -1)
    return [
        {
            "pre_return": F.avg("daily_return").over(span),
            "pre_volume_change": F.avg("volume_change").over(span),
            "pre_rsi": F.last("rsi").over(span),
        }
    ]
