"""Preparation for classification: encoding, split, folds, scaling."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonetape.operators.ranking import SLICE_DIGITS, hash_ranks

# The named features, before the one-hot columns.
NAMED_FEATURES = ("sentiment_score", "pre_return", "pre_volume_change", "pre_rsi")


def complete_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def present_values(df: DataFrame, column: str) -> list:
    """The distinct values of a category column, sorted.

    They become columns, so there are as many as a table can have columns; for a
    column of free values use an indexer and one vector column instead.
    """
    found = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in found)


def one_hot(df: DataFrame, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column per category, the category column dropped.

    Without `values` the categories present are looked up.
    """
    if values is None:
        values = present_values(df, column)
    flags = {
        f"{column}_{v}": F.when(F.col(column) == v, 1.0).otherwise(0.0) for v in sorted(values)
    }
    return df.withColumns(flags).drop(column)


def feature_columns(df: DataFrame, dedupe: bool = False) -> list[str]:
    """Named features that are present, then every `sentiment_*` column.

    `sentiment_score` matches both rules and so appears twice, unless `dedupe`.
    """
    names = [c for c in NAMED_FEATURES if c in df.columns]
    names += [c for c in df.columns if c.startswith("sentiment_")]
    return list(dict.fromkeys(names)) if dedupe else names


def class_counts(df: DataFrame, label: str = "target") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def holdout_share(counts: DataFrame, share: float = 0.3, small: int = 10) -> DataFrame:
    """The share to test on: `share`, or half when a class has fewer than `small` rows."""
    return counts.agg(
        F.when(F.min("n") < small, F.lit(0.5)).otherwise(F.lit(share)).alias("share")
    )


def fold_count(counts: DataFrame, most: int = 5) -> DataFrame:
    """max(2, min(most, smallest class // 2))."""
    half = F.floor(F.min("n") / 2)
    return counts.agg(
        F.greatest(F.lit(2), F.least(F.lit(most), half)).cast("int").alias("folds")
    )


def train_quotas(sizes: DataFrame, label: str, share: float) -> DataFrame:
    """Rows of each class that train: its exact share rounded by largest remainder.

    `sizes` has one row per class (label, n).  In all, ceil(share * total) rows test.
    """
    everything = Window.partitionBy()
    total = F.sum("n").over(everything)
    wanted = sizes.withColumn("_train", total - F.ceil(total * F.lit(float(share)))).withColumn(
        "_exact", F.col("n") * F.col("_train") / total
    )
    parts = wanted.withColumn("_whole", F.floor("_exact")).withColumn(
        "_left", F.col("_train") - F.sum("_whole").over(everything)
    )
    by_rest = Window.partitionBy().orderBy(
        F.round(F.col("_exact") - F.col("_whole"), 9).desc(), F.col(label)
    )
    return parts.select(
        label,
        (F.col("_whole") + F.when(F.row_number().over(by_rest) <= F.col("_left"), 1).otherwise(0))
        .cast("long")
        .alias("quota"),
    )


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    share: float = 0.3,
    seed: int = 42,
    group_cols: Sequence[str] | None = None,
    digits: int = SLICE_DIGITS,
) -> DataFrame:
    """Add `part`, 'train' or 'test', with exact class quotas and a repeatable draw.

    `key` names the columns that tell rows apart.  With `group_cols` whole groups
    are drawn instead of rows, so near-copies of an event stay on one side; a
    group's class is that of its rows.  `digits` cuts the draw into slices, see
    `slice_digits`.
    """
    units, draw = (df, list(key)) if group_cols is None else (
        df.select(label, *group_cols).distinct(), list(group_cols)
    )
    ranked = hash_ranks(units, label, draw, seed, digits)
    sizes = units.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    part = F.when(F.col("_rank") <= F.col("quota"), "train").otherwise("test").alias("part")
    # one row per class: safe to broadcast
    quotas = F.broadcast(train_quotas(sizes, label, share))
    drawn = ranked.join(quotas, label).select(*units.columns, part)
    return drawn if group_cols is None else df.join(drawn, [label, *group_cols])


def assign_folds(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    k: int,
    seed: int = 42,
    out: str = "fold",
    digits: int = SLICE_DIGITS,
    group_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Add a fold number 0..k-1: class sizes in any two folds differ by one at most.

    Each class starts dealing where the class before it stopped, which evens out
    the fold sizes as well.  With `group_cols` whole groups are dealt, see `group_folds`.
    """
    if group_cols is not None:
        dealt = group_folds(df, label, group_cols, k, seed, out, digits)
        return df.join(dealt, list(group_cols))
    ranked = hash_ranks(df, label, key, seed, digits)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    dealt = sizes.select(
        label,
        (F.sum("_c").over(Window.partitionBy().orderBy(label)) - F.col("_c")).alias("_offset"),
    )
    fold = ((F.col("_rank") - 1 + F.col("_offset")) % k).cast("int").alias(out)
    # one row per class: safe to broadcast
    return ranked.join(F.broadcast(dealt), label).select(*df.columns, fold)


def group_folds(
    df: DataFrame,
    label: str,
    group_cols: Sequence[str],
    k: int,
    seed: int = 42,
    out: str = "fold",
    digits: int = SLICE_DIGITS,
) -> DataFrame:
    """(group_cols, fold): every group in one fold, classes spread evenly.

    A group counts for the class that most of its rows have (equal: the smallest).  The
    groups of a class are dealt from the largest to the smallest, back and forth over the
    folds, so of groups with one class each any two folds hold numbers of rows of that
    class that differ by the size of its largest group at most.  Ranks come from counts
    per size and hash ranks of groups of a size, so no task sees a whole class.
    """
    groups = list(group_cols)
    each = df.groupBy(*groups, label).agg(F.count(F.lit(1)).alias("_n"))
    units = each.groupBy(*groups).agg(
        F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias("_class"),
        F.sum("_n").alias("_rows"),
    )
    cell = F.concat_ws(":", F.col("_class").cast("string"), F.col("_rows").cast("string"))
    units = units.withColumn("_cell", cell)
    cells = units.groupBy("_cell", "_class", "_rows").agg(F.count(F.lit(1)).alias("_c"))
    # one row per class and size of group
    larger = Window.partitionBy("_class").orderBy(F.desc("_rows"))
    before = cells.withColumn("_before", F.sum("_c").over(larger) - F.col("_c"))
    classes = cells.groupBy("_class").agg(F.sum("_c").alias("_c"))
    first = Window.partitionBy().orderBy("_class")
    starts = classes.select("_class", (F.sum("_c").over(first) - F.col("_c")).alias("_start"))
    ranked = hash_ranks(units, "_cell", groups, seed, digits).drop("_size")
    ranked = ranked.join(before.select("_cell", "_before"), "_cell")
    # one row per class: safe to broadcast
    ranked = ranked.join(F.broadcast(starts), "_class")
    at = F.col("_before") + F.col("_rank") - 1
    turn, step = F.floor(at / k), at % k
    forth = F.when(turn % 2 == 0, step).otherwise(k - 1 - step)
    return ranked.select(*groups, ((forth + F.col("_start")) % k).cast("int").alias(out))


def fit_scaler(train: DataFrame, names: Sequence[str], out: str = "features") -> PipelineModel:
    """Scaler by train mean and *population* deviation; a constant column is only centred.

    One row of statistics reaches the driver; applying the model is a map.
    """
    factors = train.agg(
        *[
            F.when(F.min(c) < F.max(c), 1 / F.stddev_pop(c)).otherwise(1.0).alias(c)
            for c in dict.fromkeys(names)
        ]
    ).first()
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(names), outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False),
            ElementwiseProduct(
                scalingVec=Vectors.dense([factors[c] for c in names]),
                inputCol="_centred",
                outputCol=out,
            ),
        ]
    ).fit(train)


def standardize(
    train: DataFrame, test: DataFrame, names: Sequence[str], out: str = "features"
) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Both sides scaled by the statistics of the train side, as a vector column."""
    scaler = fit_scaler(train, names, out)
    scaled = [scaler.transform(df).drop("_raw", "_centred") for df in (train, test)]
    return scaled[0], scaled[1], scaler


def smallest_class(df: DataFrame, label: str) -> int:
    """Size of the rarest class, one number."""
    n = df.groupBy(label).count().agg(F.min("count")).first()[0]
    return int(n or 0)


def fold_number(smallest: int, most: int = 5) -> int:
    return max(2, min(most, smallest // 2))


def share_number(smallest: int, share: float = 0.3, small: int = 10) -> float:
    return 0.5 if smallest < small else share

