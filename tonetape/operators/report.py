"""The tables under the charts."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetape.functions.labels import class_name
from tonetape.operators.quantiles import cuts_for, exact_quantiles, value_counts
from tonetape.session import materialised

BASELINE = "Random Baseline (Expected)"


def stack_predictions(tables: dict[str, DataFrame]) -> DataFrame:
    """All prediction tables in one, with a model column."""
    named = [df.withColumn("model", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, named)


def accuracy_by_class(stacked: DataFrame, models=None) -> DataFrame:
    """Share of right predictions, one row per true class, one column per model.

    A model without rows of a class leaves its cell missing.
    """
    correct = (F.col("pred") == F.col("true")).cast("double")
    return (
        stacked.groupBy("true").pivot("model", models).agg(F.avg(correct)).orderBy("true")
    )


def accuracy_vs_baseline(by_class: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """Class x model accuracies in long form, with the expected random share added."""
    models = [c for c in by_class.columns if c != "true"]
    wide = by_class.select(class_name("true").alias("class"), *[F.col(f"`{m}`") for m in models])
    return wide.withColumn(baseline, F.lit(1 / 3)).unpivot(
        "class", [f"`{m}`" for m in [*models, baseline]], "model", "accuracy"
    )


def box_stats(
    df: DataFrame, by: str, column: str, whis: float = 1.5
) -> tuple[DataFrame, DataFrame]:
    """Quartiles and whiskers per group, and the values outside the whiskers.

    Whiskers are the outermost values within whis * IQR of the box, and never end
    inside the box, whose edges may lie between two values.  Works on
    one row per distinct value; outliers come with their number of rows.
    """
    # Written: it is read for the edges, the slices and the whiskers.
    counts = materialised(value_counts(df, by, column))
    quartiles = exact_quantiles(counts, by, cuts=cuts_for(counts, by))
    reach = whis * (F.col("q2") - F.col("q0"))
    low, high = (F.col("q0") - reach).alias("_lo"), (F.col("q2") + reach).alias("_hi")
    fenced = counts.join(
        quartiles.select(by, "q0", "q1", "q2", low, high), by
    )
    near = F.col("value").between(F.col("_lo"), F.col("_hi"))
    stats = fenced.groupBy(by, "q0", "q1", "q2").agg(
        F.least("q0", F.min(F.when(near, F.col("value")))).alias("whisker_low"),
        F.greatest("q2", F.max(F.when(near, F.col("value")))).alias("whisker_high"),
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~near, F.col("n"))), F.lit(0)).alias("n_outliers"),
    )
    outliers = fenced.where(~near).select(by, F.col("value").alias(column), "n")
    names = {"q0": "q25", "q1": "median", "q2": "q75"}
    return stats.withColumnsRenamed(names), outliers


def rank_coefficients(df: DataFrame) -> DataFrame:
    return df.orderBy("class", F.col("coefficient").desc(), "feature")


def rank_importances(df: DataFrame) -> DataFrame:
    return df.orderBy("model", F.col("importance").desc(), "feature")


def merge_comparisons(classical: DataFrame, network: DataFrame) -> DataFrame:
    return classical.unionByName(network)


def display_title(c):
    """file_style_name -> File Style Name."""
    return F.initcap(F.replace(F.col(c) if isinstance(c, str) else c, F.lit("_"), F.lit(" ")))


def confusion_long(matrix: DataFrame, model: str = "model") -> DataFrame:
    """One row per cell of a confusion matrix, as a double, with a display title."""
    cells = [c for c in matrix.columns if c.startswith("Pred_")]
    return matrix.select(
        display_title(model).alias("title"), "label", *[F.col(c).cast("double") for c in cells]
    ).unpivot(["title", "label"], cells, "predicted", "n")
