"""What the two scorers share: labels that may be learnt from, and isotonic calibration."""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

#: Share of the raw score in a calibrated one: it orders what calibration makes equal.
ORDER = 0.01


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether a row's label must not be learnt from: crc32 of its id as text modulo folds is fold.  A null id is not."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def labelled(labels: DataFrame, label: str, folds: int, fold: int, most: int) -> DataFrame:
    """(id, label) of the rows to learn from, one per id; of more than most rows, those with the smallest hashes."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    own = own.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    return own.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(most)


def part(id_col: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit(2)), F.lit(parts))


def calibrated(scored: DataFrame, train: DataFrame) -> DataFrame:
    """scored with score, the isotonic fit of train's label on raw (in [0, 1]), and predicted.

    Rows of one raw score are one point with their number as weight, which fits alike."""
    points = train.groupBy("raw").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    model = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight", predictionCol="fitted").fit(points)
    score = (1 - ORDER) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("fitted"))) + ORDER * F.col("raw")
    out = model.transform(scored).withColumn("score", score)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def constant(rows: DataFrame, score: float) -> DataFrame:
    return rows.withColumns({"score": F.lit(score), "predicted": F.lit(int(score >= 0.5))})


def classes(train: DataFrame) -> tuple[int, int]:
    """Rows of train, and those with label 1."""
    n, ones = train.agg(F.count(F.lit(1)), F.sum("label")).first()
    return n, ones or 0
