"""Forward as-of join."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetape.operators.ordered import SLICE_DAYS, first_on_or_after


def asof_forward(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    how: str = "inner",
    tolerance: int | None = None,
    width: float = SLICE_DAYS,
) -> DataFrame:
    """Give each left row the earliest right row of the same key at or after it.

    The search runs on the distinct (key, time) pairs of the left side, so a key
    or time that many left rows share is looked up once.  The answer is then an
    equi-join; adaptive execution broadcasts it while its measured size allows
    and splits skewed keys of a sort-merge join beyond that.  `tolerance` is a
    largest gap in days; `width` is the length of a search slice in days, a fraction
    of one for series with many rows a day; `how` is "inner" or "left".  Of right rows that tie in key
    and time the smallest is given, by their other columns in order.
    """
    by = list(by)
    wanted = left.where(F.col(left_on).isNotNull()).select(*by, F.col(left_on).alias("at"))
    marks = right.where(F.col(right_on).isNotNull()).select(*by, F.col(right_on).alias("at"))
    hits = first_on_or_after(wanted, marks, by, width).where(F.col("match").isNotNull())
    if tolerance is not None:
        gap = F.datediff("match", "at")
        hits = hits.where(gap <= tolerance)
    shared = [c for c in right.columns if c in left.columns and c not in by and c != right_on]
    if shared or right_on in left.columns:
        raise ValueError(f"columns on both sides: {shared or [right_on]}")
    rest = [c for c in right.columns if c not in by and c != right_on]
    if rest:
        one = right.groupBy(*by, right_on).agg(F.min(F.struct(*rest)).alias("_row"))
        one = one.select(*by, right_on, "_row.*")
    else:
        one = right.select(*by, right_on).distinct()
    found = hits.withColumnRenamed("match", right_on).join(one, [*by, right_on])
    return left.join(found.withColumnRenamed("at", left_on), [*by, left_on], how)
