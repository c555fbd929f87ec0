"""The whole study: filings and bars to features, features to fitted and scored models."""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tonetape.functions.labels import encode_label
from tonetape.operators import models as m
from tonetape.operators.evaluate import (
    classification_report,
    compare,
    confusion_matrix,
    predictions,
)
from tonetape.operators.events import build_features
from tonetape.operators.prep import (
    NAMED_FEATURES,
    assign_folds,
    complete_rows,
    feature_columns,
    fold_number,
    present_values,
    one_hot,
    share_number,
    smallest_class,
    standardize,
    stratified_split,
)
from tonetape.operators.ranking import slice_digits
from tonetape.operators.report import stack_predictions
from tonetape.operators.sentiment import keyword_sentiment
from tonetape.session import materialised, release


#: Rows of one part of a table that models are fitted on, about.
TASK_ROWS = 2_500


def study_features(filings, bars, companies, *, lexicon=None, dates=None, moves=None) -> DataFrame:
    """Lexicon tone and price action joined into one labelled row per filing."""
    tone = keyword_sentiment(filings, companies, **(lexicon or {}), **(dates or {}))
    return build_features(tone, bars, **(moves or {}))


def spread(df: DataFrame, rows: int, key: Sequence[str]) -> DataFrame:
    """df dealt by key into parts of about TASK_ROWS; a small table is left as it is.

    Rows are narrow and fits are bound by CPU, so parts of the usual number of bytes
    would leave a fit to a few tasks."""
    parts = rows // TASK_ROWS
    return df if parts < 2 else df.repartition(parts, *key).sortWithinPartitions(*key)


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    names: list[str]
    scaler: PipelineModel
    folds: int
    train_rows: int
    classes: list[int]
    raw_test: DataFrame


def prepare(
    features: DataFrame,
    key: Sequence[str] = ("filing_id",),
    label: str = "target",
    share: float = 0.3,
    seed: int = m.SEED,
    group_cols: Sequence[str] | None = None,
    dedupe: bool = False,
) -> Prepared:
    """Complete rows, one-hot classes, split, scale, deal into folds.

    The narrow prepared table is written out once, since every later fit reads it.
    """
    plain = [c for c in NAMED_FEATURES if c in features.columns]
    kept = list(dict.fromkeys([*key, label, *(group_cols or []), *plain, "sentiment"]))
    # Written first: looking the categories up must not run the study once more.
    rows = materialised(complete_rows(features).select(*kept))
    classes = present_values(rows, label)
    digits = slice_digits(rows.count())
    coded = rows.withColumn("label", encode_label(label, classes))
    wide = one_hot(coded, "sentiment")
    names = feature_columns(wide, dedupe)
    share = share_number(smallest_class(wide, label), share)
    split = materialised(stratified_split(wide, label, key, share, seed, group_cols, digits))
    release(rows)
    train, test = split.where("part = 'train'"), split.where("part = 'test'")
    folds = fold_number(smallest_class(train, label))
    dealt = train = materialised(
        assign_folds(train, label, key, folds, seed, digits=digits, group_cols=group_cols)
    )
    raw_test = test.select(*dict.fromkeys([*key, label, "label", *names]))
    train, test, scaler = standardize(train, test, names)
    columns = [*key, label, "label", "features"]
    n_train, n_test = dealt.count(), split.where("part = 'test'").count()
    train = materialised(spread(train.select(*columns, "fold"), n_train, key))
    test = materialised(spread(test.select(*columns), n_test, key))
    release(dealt)
    return Prepared(train, test, names, scaler, folds, n_train, classes, raw_test)


@dataclass
class Outcome:
    models: dict = field(default_factory=dict)
    searches: dict = field(default_factory=dict)
    chosen: dict = field(default_factory=dict)
    predictions: dict = field(default_factory=dict)
    reports: dict = field(default_factory=dict)
    confusions: dict = field(default_factory=dict)
    comparison: DataFrame | None = None


def default_models(rows: int, inputs: int, classes: int = 3) -> dict:
    """Display name -> (estimator, grid) for the four classical models and the network."""
    return {
        "Logistic Regression": (m.logistic(rows), m.LOGISTIC_GRID),
        "Random Forest": (m.random_forest(), m.FOREST_GRID),
        "AdaBoost": (m.adaboost(), m.ADABOOST_GRID),
        "Boosted Trees": (m.boosted_trees(), m.GBT_GRID),
        "FFNN": (m.network(inputs, classes), None),
    }


def run_classification(
    ready: Prepared, models: dict | None = None, key: Sequence[str] = ("filing_id",), label: str = "target"
) -> Outcome:
    """Fit and score the models and the random baseline on one prepared split."""
    out = Outcome()
    chosen = models or default_models(ready.train_rows, len(ready.names), len(ready.classes))
    guess = m.random_baseline(ready.test.withColumnRenamed(label, "true"), key)
    out.predictions["Random Baseline"] = guess.select(*key, "true", "pred")
    for name, (estimator, axes) in chosen.items():
        if axes is None:
            fitted = estimator.fit(ready.train)
        else:
            out.searches[name], out.chosen[name], fitted = m.search(estimator, axes, ready.train, "fold", ready.folds, ready.train_rows)
        out.models[name] = fitted
        # Written: reports, matrices and the comparison each read it.
        out.predictions[name] = materialised(predictions(fitted.transform(ready.test), key, label, ready.classes))
    for name, table in out.predictions.items():
        out.reports[name] = classification_report(table)
        out.confusions[name] = confusion_matrix(table)
    out.comparison = compare(stack_predictions(out.predictions))
    return out
