"""Category columns of any number of values: numbers, sparse vectors and long cells.

No value goes to the driver and none becomes a column, so a column may have millions.
"""

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonetape.operators.evaluate import class_cells
from tonetape.session import materialised

#: The number of a value that has none: encoders take it for an unknown value.
UNKNOWN = float(2**31 - 1)


def category_numbers(df: DataFrame, column: str) -> DataFrame:
    """(value, number): the distinct values of a column in order, numbered from 0.

    Missing values get no number.  Values are cut into ranges that are written, so that
    they stay what they are; a number is the count of values in the ranges before plus
    the place in its own range.  Only the counts per range meet in one task.
    """
    value = F.col(column).alias("value")
    ranges = materialised(
        df.select(value)
        .where("value is not null")
        .distinct()
        .repartitionByRange("value")
        .withColumn("_range", F.spark_partition_id())
    )
    n = F.count(F.lit(1)).alias("_n")
    before = ranges.groupBy("_range").agg(n).select(
        "_range",
        (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"),
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy("value")) - 1
    return (
        ranges.withColumn("_place", place)
        .join(before, "_range")
        .select("value", (F.col("_before") + F.col("_place")).alias("number"))
    )


class CategoryVectors:
    """One-hot vectors of a category column, as `one_hot` has flags.

    Place i of a vector stands for the value with number i; missing values, and values
    that the fitted table does not have, get a vector of zeros.
    """

    def __init__(self, numbers: DataFrame, model: OneHotEncoderModel, column: str):
        self.numbers, self.model, self.column = numbers, model, column

    @property
    def size(self) -> int:
        return self.model.categorySizes[0]

    def transform(self, df: DataFrame) -> DataFrame:
        """The vector column added as `<column>_vector`, rows and other columns as they are."""
        values = self.numbers.select(F.col("value").alias("_value"), F.col("number").alias("_number"))
        joined = df.join(values, df[f"`{self.column}`"] == F.col("_value"), "left")
        known = F.coalesce(F.col("_number").cast("double"), F.lit(UNKNOWN))
        return self.model.transform(joined.withColumn("_number", known)).drop("_value", "_number")


def category_vectors(df: DataFrame, column: str) -> CategoryVectors:
    """Number the values of a column; a column without any is an error."""
    numbers = materialised(category_numbers(df, column))
    if numbers.isEmpty():
        raise ValueError(f"no values in {column}")
    # An unknown value takes the place after the last one, and that place is dropped.
    encoder = OneHotEncoder(
        inputCol="_number", outputCol=f"{column}_vector", dropLast=True, handleInvalid="keep"
    )
    model = encoder.fit(numbers.select(F.col("number").cast("double").alias("_number")))
    return CategoryVectors(numbers, model, column)


def confusion_cells(preds: DataFrame) -> DataFrame:
    """A confusion matrix with one row per cell that holds rows.

    `row` and `column` are the places of the true and the predicted class among all
    classes in order, as `confusion_matrix` lays them out; `share` is the part of the
    true class's rows.  Missing classes count as a class without a place.
    """
    cells = class_cells(preds)
    numbers = category_numbers(cells.select(F.explode(F.array("true", "pred")).alias("c")), "c")
    row = numbers.select(F.col("value").alias("_t"), F.col("number").alias("row"))
    column = numbers.select(F.col("value").alias("_p"), F.col("number").alias("column"))
    support = cells.groupBy(F.col("true").alias("_class")).agg(F.sum("n").alias("_support"))
    return (
        cells.join(support, F.col("true").eqNullSafe(F.col("_class")))
        .join(row, F.col("true") == F.col("_t"), "left")
        .join(column, F.col("pred") == F.col("_p"), "left")
        .select("true", "pred", "row", "column", "n", (F.col("n") / F.col("_support")).alias("share"))
    )


def accuracy_cells(stacked: DataFrame) -> DataFrame:
    """Share of right predictions, one row per true class and model that meet.

    The long form of `accuracy_by_class`, in one pass: no look-up of the models before.
    """
    right = (F.col("pred") == F.col("true")).cast("double")
    return stacked.groupBy("true", "model").agg(F.avg(right).alias("accuracy"))
