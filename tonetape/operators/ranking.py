"""Exact ranks in a repeatable hash order, without one task per class.

Rows of a class are cut by the leading hex digits of an md5.  A hash spreads
rows evenly, so a class that holds a third of the table still falls into
thousands of near-equal slices; a rank is the count of rows in the slices before
plus the position inside the slice.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_DIGITS = 3
#: Rows of one slice, about, when the number of rows is known.
SLICE_ROWS = 50_000


def slice_digits(rows: int) -> int:
    """Hex digits that cut so many rows into slices of about SLICE_ROWS."""
    digits = SLICE_DIGITS
    while rows > SLICE_ROWS * 16**digits:
        digits += 1
    return digits


def pick_hash(key: Sequence[str], seed: int) -> Column:
    """md5 of 'seed:key[:key...]', a stable stand-in for a random draw."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def hash_ranks(
    df: DataFrame, by: str, key: Sequence[str], seed: int, digits: int = SLICE_DIGITS
) -> DataFrame:
    """Add `_rank`, 1.. within each class in (hash, key) order, and `_size`, the class count."""
    hashed = df.withColumn("_h", pick_hash(key, seed)).withColumn(
        "_p", F.substring("_h", 1, digits)
    )
    across = Window.partitionBy(by).orderBy("_p")
    before = (
        hashed.groupBy(by, "_p")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            by,
            "_p",
            (F.sum("_n").over(across) - F.col("_n")).alias("_before"),
            F.sum("_n").over(Window.partitionBy(by)).alias("_size"),
        )
    )
    inside = Window.partitionBy(by, "_p").orderBy("_h", *key)
    return (
        hashed.withColumn("_at", F.row_number().over(inside))
        .join(before, [by, "_p"])
        .withColumn("_rank", F.col("_before") + F.col("_at"))
        .drop("_h", "_p", "_at", "_before")
    )
