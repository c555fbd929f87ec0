"""Price indicators: returns, moving averages, RSI, per ticker."""

from pyspark.sql import DataFrame

from tonetape.functions.series import diff, gain_loss, pct_change, rolling_std
from tonetape.operators.events import with_starts
from tonetape.operators.ordered import SLICE_DAYS, filled, over_series
from tonetape.operators.steps import FILLED, FLAG_ROWS, RSI_ROWS, flag_steps, indicator_steps

OUTPUTS = ("daily_return", "ma5", "ma10", "volume_change", "rsi")
_HELPERS = ("_delta", "_gain", "_loss")


def price_indicators(
    bars: DataFrame, events: DataFrame | None = None, window: int = RSI_ROWS, width: int = SLICE_DAYS
) -> DataFrame:
    """Bars with daily_return, ma5, ma10, volume_change and rsi.

    With an events table, `post_earnings` flags the six bars from each event on;
    without one the column is absent.
    """
    needs, flags = ["close", "volume"], lambda w: []
    if events is not None:
        bars, flags = with_starts(bars, events, width), flag_steps
        needs.append("_start")
    return over_series(
        bars,
        lambda w: [*indicator_steps(w, window), *flags(w)],
        needs=needs,
        before=max(window, 10, FLAG_ROWS),
        fill=FILLED,
        width=width,
    ).drop(*_HELPERS, "_start")


def gains_and_losses(bars: DataFrame, width: int = SLICE_DAYS) -> DataFrame:
    """First difference of close and its split into gain and loss."""
    def steps(w):
        gain, loss = gain_loss("delta")
        return [{"delta": diff("close", w)}, {"gain": gain, "loss": loss}]

    return over_series(bars, steps, needs=("close",), before=1, width=width)


def volatility(bars: DataFrame, n: int, width: int = SLICE_DAYS) -> DataFrame:
    """Sample standard deviation of the last n daily returns."""
    return over_series(
        bars,
        lambda w: [
            {"daily_return": pct_change(filled("close"), w)},
            {"volatility": rolling_std("daily_return", n, w)},
        ],
        needs=("close",),
        before=n + 1,
        fill=("close",),
        width=width,
    )
