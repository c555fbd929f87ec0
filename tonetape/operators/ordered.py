"""Windows over long ordered series, without one task per series.

A plain `Window.partitionBy("ticker")` puts a whole series into one task.  Here
a series is cut into calendar slices of `width` days, and each slice borrows the
few rows before and after it that its frames reach into.  With one row per key
and day a slice holds at most `width` rows plus the borrowed ones, whatever the
length of the series or its share of the table.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SLICE_DAYS = 512

DAY, SLICE, _EXTRA, _PACK = "_day", "_slice", "_extra", "_pack"


def with_slices(df: DataFrame, date: str, width: int) -> DataFrame:
    return df.withColumn(DAY, F.unix_date(date)).withColumn(
        SLICE, F.floor(F.col(DAY) / width).cast("int")
    )


def filled(name: str) -> str:
    """Name of the forward-filled copy `over_series` makes of a column."""
    return f"_{name}_filled"


def _borrowed(rows: DataFrame, key: str, names, before: int, after: int, fill) -> DataFrame:
    """Rows each slice borrows from its neighbours, keyed by the borrowing slice.

    Works on the first and last rows of every slice only.  A slice may be short,
    so up to `before` slices back are looked at; that always covers the last
    `before` rows.
    """
    w = Window.partitionBy(key, SLICE).orderBy(DAY)
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    item = [F.col(DAY), *[F.col(n) for n in names]]
    item += [F.last(n, ignorenulls=True).over(to_here).alias(filled(n)) for n in fill]
    edges = rows.select(
        key,
        SLICE,
        (F.lead(DAY, before).over(w).isNull() if before else F.lit(False)).alias("_is_tail"),
        (F.lag(DAY, after).over(w).isNull() if after else F.lit(False)).alias("_is_head"),
        F.struct(*item).alias("_row"),
    )
    ends = edges.groupBy(key, SLICE).agg(
        F.array_sort(F.collect_list(F.when(F.col("_is_tail"), F.col("_row")))).alias("_tail"),
        F.array_sort(F.collect_list(F.when(F.col("_is_head"), F.col("_row")))).alias("_head"),
        *[
            F.max_by(
                F.col("_row")[n], F.when(F.col("_row")[n].isNotNull(), F.col("_row")[DAY])
            ).alias(f"_last_{n}")
            for n in fill
        ],
    )
    # one row per slice from here on: a series has span / width of them
    across = Window.partitionBy(key).orderBy(SLICE)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    tail = F.col("_tail")
    if fill:
        ends = ends.withColumns(
            {f"_carry_{n}": F.last(f"_last_{n}", ignorenulls=True).over(earlier) for n in fill}
        )

        def carried(x):
            for n in fill:
                x = x.withField(filled(n), F.coalesce(x[filled(n)], F.col(f"_carry_{n}")))
            return x

        tail = F.transform("_tail", carried)
    parts = []
    if before:
        ends = ends.withColumn("_tail", tail)
        seen = F.flatten(F.collect_list("_tail").over(across.rowsBetween(-before, -1)))
        ends = ends.withColumn("_seen", seen)
        parts.append(
            F.when(F.size("_seen") > before, F.slice("_seen", -before, before)).otherwise(
                F.col("_seen")
            )
        )
    if after:
        ahead = F.flatten(F.collect_list("_head").over(across.rowsBetween(1, after)))
        ends = ends.withColumn("_ahead", ahead)
        parts.append(F.slice("_ahead", 1, after))
    borrowed = ends.select(key, SLICE, F.explode(F.concat(*parts)).alias("_row"))
    # laid out like `rows`, so that their union needs no further exchange
    return borrowed.select(key, SLICE, "_row.*").repartition(key, SLICE)


def over_series(
    df: DataFrame,
    steps: Callable[[WindowSpec], Sequence[dict[str, Column]]],
    *,
    key: str = "ticker",
    date: str = "d",
    needs: Sequence[str] = ("close", "volume"),
    before: int = 0,
    after: int = 0,
    fill: Sequence[str] = (),
    width: int = SLICE_DAYS,
) -> DataFrame:
    """Add window columns to a table with one row per (key, date).

    `steps(w)` lists groups of columns, each group built on the ones before;
    `w` is ordered by day number, so both row and day-range frames work on it.
    `needs` are the columns the steps read, `fill` those they read forward-filled
    (as `filled(name)`), `before` / `after` how many rows back and ahead their
    frames reach in all.  What `needs` names are numbers that a double holds exactly.
    """
    # The date itself travels as its day number, and the columns the steps read as one
    # array: whatever of them is used later on, both uses of the dealt rows then read
    # the same exchange, and `df` is worked out once.
    names = [n for n in needs if n not in (key, date)]
    kinds = {n: df.schema[n].dataType for n in names}
    dealt = (
        with_slices(df, date, width)
        .withColumn(_PACK, F.array(*[F.col(n).cast("double") for n in names]))
        .drop(date, *names)
        .repartition(key, SLICE)
    )
    rows = dealt.withColumns(
        {n: F.get(_PACK, F.lit(i)).cast(kinds[n]) for i, n in enumerate(names)}
    ).drop(_PACK)
    w = Window.partitionBy(key, SLICE).orderBy(DAY)
    out = rows.withColumn(_EXTRA, F.lit(False))
    for n in fill:
        out = out.withColumn(filled(n), F.lit(None).cast(df.schema[n].dataType))
    if before or after or fill:
        extra = _borrowed(rows, key, names, max(before, 1 if fill else 0), after, fill)
        out = out.unionByName(
            extra.withColumn(_EXTRA, F.lit(True)), allowMissingColumns=True
        )
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    if fill:
        out = out.withColumns(
            {
                filled(n): F.last(F.coalesce(n, filled(n)), ignorenulls=True).over(to_here)
                for n in fill
            }
        )
    for step in steps(w):
        out = out.withColumns(step)
    out = out.where(~F.col(_EXTRA)).withColumn(date, F.date_from_unix_date(DAY))
    made = [c for c in out.columns if c not in {*df.columns, DAY, SLICE, _EXTRA, *map(filled, fill)}]
    return out.select(*df.columns, *made)


def first_on_or_after(
    wanted: DataFrame, marks: DataFrame, by: Sequence[str], width: float = SLICE_DAYS
) -> DataFrame:
    """For distinct (by, at) rows of `wanted`, the least `at` of `marks` not before it.

    Returns by, at, match (NULL when nothing follows).  Both sides are cut down to
    distinct rows first; slices look up what follows them in one row per slice.
    """
    by = list(by)
    unmarked = F.lit(None).cast(marks.schema["at"].dataType)
    asked = wanted.select(*by, "at").distinct().withColumn("mark", unmarked)
    found = marks.select(*by, "at").distinct().withColumn("mark", F.col("at"))
    both = (
        asked.unionByName(found)
        .withColumn(SLICE, F.floor(F.unix_seconds(F.col("at").cast("timestamp")) / (86_400 * width)))
        .repartition(*by, SLICE)
    )
    # newest first, so a running minimum gives the nearest mark at or after each row
    newest = Window.partitionBy(*by, SLICE).orderBy(F.col("at").desc())
    inside = both.withColumn(
        "match",
        F.min("mark").over(newest.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
    ).where(F.col("mark").isNull())
    later = Window.partitionBy(*by).orderBy(F.col(SLICE).desc())
    # asks for `at` as well, so that it shares the exchange of the other branch
    least = F.min(F.when(F.col("mark").isNotNull(), F.struct("mark", "at")))["mark"]
    ahead = (
        both.groupBy(*by, SLICE)
        .agg(least.alias("first"))
        .withColumn("next", F.min("first").over(later.rowsBetween(Window.unboundedPreceding, -1)))
        .select(*by, SLICE, "next")
    )
    return inside.join(ahead, [*by, SLICE], "left").select(
        *by, "at", F.coalesce("match", "next").alias("match")
    )
