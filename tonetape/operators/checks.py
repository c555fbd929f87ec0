"""Data checks as one aggregate pass over a table."""

from dataclasses import dataclass
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Check:
    """A named aggregate that counts violations."""

    name: str
    violations: Column


def _missing(df: DataFrame, columns: Sequence[str]) -> int:
    return sum(c not in df.columns for c in columns)


def in_range(df: DataFrame, column: str, low: float, high: float) -> Check:
    """Values outside [low, high]; missing ones count, a non-numeric column fails."""
    name = f"{column} within [{low}, {high}]"
    if _missing(df, [column]) or not isinstance(df.schema[column].dataType, T.NumericType):
        return Check(name, F.lit(1))
    ok = F.coalesce(F.col(column).between(low, high), F.lit(False))
    return Check(name, F.coalesce(F.sum(F.when(ok, 0).otherwise(1)), F.lit(0)))


def not_empty(df: DataFrame) -> Check:
    return Check("not empty", F.when(F.count(F.lit(1)) > 0, 0).otherwise(1))


def has_columns(df: DataFrame, columns: Sequence[str]) -> Check:
    return Check(f"columns {', '.join(columns)}", F.lit(_missing(df, columns)))


def classes_equal(df: DataFrame, column: str, classes: Sequence[int]) -> Check:
    """Classes missing from the column, plus rows of a class (or NULL) not asked for."""
    seen = [F.max(F.when(F.col(column) == c, 1).otherwise(0)) for c in classes]
    absent = sum((1 - F.coalesce(s, F.lit(0)) for s in seen), F.lit(0))
    strange = F.sum(F.when(F.coalesce(F.col(column).isin(*classes), F.lit(False)), 0).otherwise(1))
    return Check(f"{column} classes", absent + F.coalesce(strange, F.lit(0)))


def at_least(df: DataFrame, column: str, low: float) -> Check:
    name = f"{column} at least {low}"
    if _missing(df, [column]) or not isinstance(df.schema[column].dataType, T.NumericType):
        return Check(name, F.lit(1))
    ok = F.coalesce(F.col(column) >= low, F.lit(False))
    return Check(name, F.coalesce(F.sum(F.when(ok, 0).otherwise(1)), F.lit(0)))


def square_counts(df: DataFrame, prefix: str = "Pred_") -> list[Check]:
    """A confusion matrix has as many rows as cell columns, and no negative cell."""
    cells = [c for c in df.columns if c.startswith(prefix)]
    low = F.least(*cells) if len(cells) > 1 else F.col(cells[0])
    return [
        Check("square", F.abs(F.count(F.lit(1)) - len(cells))),
        Check("no negative cell", F.coalesce(F.sum(F.when(low >= 0, 0).otherwise(1)), F.lit(0))),
    ]


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, number of violations, passed."""
    row = df.agg(*[c.violations.cast("long").alias(f"v{i}") for i, c in enumerate(checks)])
    found = F.array(
        *[
            F.struct(F.lit(c.name).alias("check"), F.col(f"v{i}").alias("violations"))
            for i, c in enumerate(checks)
        ]
    )
    return row.select(F.explode(found).alias("x")).select(
        "x.check", "x.violations", (F.col("x.violations") == 0).alias("passed")
    )


def group_sizes(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Rows per group of a table that must carry the given columns."""
    if _missing(df, columns):
        raise ValueError(f"missing columns: {[c for c in columns if c not in df.columns]}")
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"n_{c}") for c in columns]
    )
