"""Scoring of predictions: accuracy, per-class report, confusion matrix, comparison."""

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetape.functions.labels import class_name, decode_label
from tonetape.operators.prep import present_values
from tonetape.schema import CLASS_NAMES, CLASSES


def _hit():
    return (F.col("true") == F.col("pred")).cast("double")


def accuracy(preds: DataFrame) -> DataFrame:
    return preds.agg(F.avg(_hit()).alias("accuracy"))


def class_cells(preds: DataFrame) -> DataFrame:
    """Count per (true, pred): the small table all class metrics are made from."""
    return preds.groupBy("true", "pred").agg(F.count(F.lit(1)).alias("n"))


def classification_report(preds: DataFrame) -> DataFrame:
    """precision, recall, f1, support per class, then accuracy, macro and weighted means.

    Classes are those in true or pred; a ratio with nothing below the line is 0.
    The predictions are read once, into at most classes^2 counts.
    """
    right = F.when(F.col("true") == F.col("pred"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")

    def side(c, support, said, hits):
        return F.struct(
            F.col(c).alias("c"), support.alias("t"), said.alias("p"), hits.cast("long").alias("r")
        )

    both = F.array(side("true", F.col("n"), none, right), side("pred", none, F.col("n"), none))
    sides = class_cells(preds).select(F.explode(both).alias("x")).select("x.*")
    zero = F.lit(0.0)
    per_class = (
        sides.groupBy("c")
        .agg(F.sum("t").alias("support"), F.sum("p").alias("said"), F.sum("r").alias("right"))
        .withColumn("precision", F.coalesce(F.try_divide("right", "said"), zero))
        .withColumn("recall", F.coalesce(F.try_divide("right", "support"), zero))
        .withColumn(
            "f1",
            F.coalesce(
                F.try_divide(
                    2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
                ),
                zero,
            ),
        )
    )
    metrics = ("precision", "recall", "f1")
    rows = F.sum("support")
    totals = per_class.agg(
        rows.alias("support"),
        (F.sum("right") / rows).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[(F.sum(F.col(m) * F.col("support")) / rows).alias(f"weighted_{m}") for m in metrics],
    )
    blank = F.lit(None).cast("double")
    summary = totals.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("label"),
                    blank.alias("precision"),
                    blank.alias("recall"),
                    F.col("accuracy").alias("f1"),
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("label"),
                        *[F.col(f"{kind}_{m}").alias(m) for m in metrics],
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        ).alias("x"),
        "support",
    ).select("x.*", "support")
    label = F.col("c").cast("string").alias("label")
    return per_class.select(label, *metrics, "support").unionByName(summary)


def confusion_matrix(preds: DataFrame, labels: Sequence[int] | None = None) -> DataFrame:
    """Rows True_<class>, columns Pred_<class>, counts in the cells.

    `labels` are the classes to show; by default those in true or pred, which a job
    looks up from the class counts when this is called.
    """
    cells = class_cells(preds)
    if labels is None:
        labels = present_values(cells.select(F.explode(F.array("true", "pred")).alias("c")), "c")
    labels = sorted(labels)
    names = {c: _title(c) for c in labels}
    spine = preds.sparkSession.createDataFrame([(c,) for c in labels], "true int")
    counted = cells.groupBy("true").agg(
        *[
            F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"Pred_{names[c]}")
            for c in labels
        ]
    )
    return (
        F.broadcast(spine)
        .join(counted, "true", "left")
        .na.fill(0)
        .select(
            F.concat(F.lit("True_"), class_name("true")).alias("label"),
            *[f"Pred_{names[c]}" for c in labels],
        )
    )


def _title(c) -> str:
    return CLASS_NAMES.get(c, str(c))


def predictions(scored: DataFrame, key: Sequence[str], label: str = "target", classes=CLASSES) -> DataFrame:
    """Row key, true class and decoded predicted class of a model's output."""
    return scored.select(
        *key,
        F.col(label).cast("int").alias("true"),
        decode_label("prediction", classes).cast("int").alias("pred"),
    )


def probabilities(scored: DataFrame, key: Sequence[str], classes=CLASSES) -> DataFrame:
    """One column per class probability and the class of the largest."""
    p = vector_to_array("probability")
    wide = scored.select(*key, p.alias("_p"))
    return wide.select(
        *key,
        *[F.col("_p")[i].alias(f"Prob_{_title(c)}") for i, c in enumerate(sorted(classes))],
        decode_label(F.array_position("_p", F.array_max("_p")) - 1, classes)
        .cast("int")
        .alias("pred"),
    )


def compare(stacked: DataFrame) -> DataFrame:
    """Accuracy per model, best first, equal ones by name."""
    return (
        stacked.groupBy("model")
        .agg(F.avg(_hit()).alias("accuracy"))
        .orderBy(F.col("accuracy").desc(), "model")
    )


def best_model(comparison: DataFrame) -> DataFrame:
    """The model or models with the highest accuracy."""
    top = comparison.agg(F.max("accuracy").alias("accuracy"))
    # one row: safe to broadcast
    return comparison.join(F.broadcast(top), "accuracy", "left_semi")
