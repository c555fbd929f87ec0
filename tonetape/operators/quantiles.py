"""Exact quantiles per group, without one task or one value list per group."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CUTS = 64
#: Distinct values of one slice, about, when their number is known.
SLICE_VALUES = 50_000


def value_counts(df: DataFrame, by: str, column: str) -> DataFrame:
    """Rows per distinct (group, value); combined before the shuffle, so repeats collapse."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(by, F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cuts_for(counts: DataFrame, by: str) -> int:
    """Slices that keep those of the largest group near SLICE_VALUES values; reads `counts`."""
    most = counts.groupBy(by).count().agg(F.max("count")).first()[0] or 0
    return max(CUTS, -(-most // SLICE_VALUES))


def exact_quantiles(
    counts: DataFrame, by: str, probs: Sequence[float] = (0.25, 0.5, 0.75), cuts: int = CUTS
) -> DataFrame:
    """Linear-interpolated quantiles q0, q1, .. of each group of `value_counts` rows.

    A sketch cuts a group's values into about `cuts` even slices.  Slice totals
    tell which slices hold the wanted ranks; only those are ordered, one task
    each, to read the ranks off exactly.  The sketch steers the work, never the
    answer.
    """
    grid = [i / cuts for i in range(1, cuts)]
    edges = counts.groupBy(by).agg(
        F.array_distinct(F.percentile_approx("value", grid, max(1000, 10 * cuts))).alias("_edges")
    )
    sliced = counts.join(edges, by).select(
        by,
        "value",
        "n",
        F.size(F.filter("_edges", lambda e: e < F.col("value"))).alias("_slice"),
    )
    order = Window.partitionBy(by).orderBy("_slice")
    totals = (
        sliced.groupBy(by, "_slice")
        .agg(F.sum("n").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(order))
        .withColumn("_all", F.sum("_n").over(Window.partitionBy(by)))
    )
    # zero-based ranks on either side of each quantile's place
    ranks = F.array(
        *[
            F.struct(
                F.lit(i).alias("q"),
                edge(F.lit(float(p)) * (F.col("_all") - 1)).cast("long").alias("rank"),
            )
            for i, p in enumerate(probs)
            for edge in (F.floor, F.ceil)
        ]
    )
    wanted = (
        totals.withColumn(
            "_ranks",
            F.array_distinct(
                F.filter(
                    ranks,
                    lambda r: (r["rank"] >= F.col("_upto") - F.col("_n"))
                    & (r["rank"] < F.col("_upto")),
                )
            ),
        )
        .where(F.size("_ranks") > 0)
        .select(by, "_slice", "_ranks", "_all", (F.col("_upto") - F.col("_n")).alias("_before"))
    )
    inside = Window.partitionBy(by, "_slice").orderBy("value")
    placed = (
        sliced.join(wanted, [by, "_slice"])
        .withColumn("_end", F.col("_before") + F.sum("n").over(inside))
        .select(
            by,
            "value",
            "_all",
            F.explode(
                F.filter(
                    "_ranks",
                    lambda r: (r["rank"] < F.col("_end"))
                    & (r["rank"] >= F.col("_end") - F.col("n")),
                )
            ).alias("_r"),
        )
    )
    picked = placed.groupBy(by).agg(
        F.first("_all").alias("_all"),
        *[
            agg(F.when(F.col("_r.q") == i, F.col("value"))).alias(f"_{side}{i}")
            for i in range(len(probs))
            for side, agg in (("lo", F.min), ("hi", F.max))
        ],
    )

    def between(i, p):
        place = F.lit(float(p)) * (F.col("_all") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return (lo + (hi - lo) * (place - F.floor(place))).alias(f"q{i}")

    return picked.select(by, *[between(i, p) for i, p in enumerate(probs)])
