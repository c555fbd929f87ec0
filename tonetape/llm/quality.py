"""Quality: ridge regression on random Fourier features of a text's statistics, calibrated.

The features approximate a Gaussian kernel over standardised statistics of the whole
text.  Every partition sums its normal equations, their sum is solved once, and an
isotonic fit on other labelled rows turns the scores into chances of label 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tonetape.llm import words as W
from tonetape.llm.calibration import calibrated, classes, constant, held_out, labelled, part
from tonetape.llm.common import slices, written
from tonetape.llm.toxicity import CAPITAL, DIGIT, PUNCTUATION

SLICE = 2 << 20
#: Bound on the labelled rows that are learnt from.
MOST_ROWS = 100_000
#: Fourier features, ridge penalty per row, and the kernel's width in standard deviations per statistic.
WAVES, RIDGE, WIDTH = 256, 1e-3, 1.0
STATISTICS = 26


def statistics(texts: pa.Array) -> np.ndarray:
    """STATISTICS numbers for each text; an empty text has zeros."""
    flat, begin = W.joined(texts)
    start, end = W.words(flat)
    first = np.searchsorted(start, begin)
    n = np.diff(first).astype(float)
    per_word, size = 1 / np.maximum(n, 1), np.maximum(np.diff(begin) - 1, 1)
    at_words = lambda x: W.per_text(x, first) * per_word
    per_byte = lambda x: W.per_text(x, begin) / size
    length = (end - start).astype(float)
    mean = at_words(length)
    spread = np.sqrt(np.maximum(at_words(length**2) - mean**2, 0))
    h = W.spans_hash(W.LOWER[flat], start, end)
    doc = np.searchsorted(first, np.arange(len(start)), side="right") - 1
    same = np.append(False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]))[: len(h)]
    order = np.lexsort((h, doc))
    new = np.append(True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1]))[: len(h)]
    group = np.flatnonzero(new)
    count = np.diff(np.append(group, len(h)))
    owner = doc[order][group]
    distinct = np.bincount(owner, minlength=len(n))[: len(n)]
    most = np.zeros(len(n))
    np.maximum.at(most, owner, count)
    alone = np.bincount(owner[count == 1], minlength=len(n))[: len(n)]
    marks = np.append(0, np.cumsum(PUNCTUATION[flat]))
    letters = np.append(0, np.cumsum(~(PUNCTUATION | DIGIT | W.SPACE)[flat]))
    digits = np.append(0, np.cumsum(DIGIT[flat]))
    own_marks = marks[end] - marks[start]
    closing = np.isin(flat[end - 1], [ord("."), ord("!"), ord("?")]) if len(end) else np.zeros(0, bool)
    opening = CAPITAL[flat[start]] | (flat[start] == 0xC3) if len(start) else np.zeros(0, bool)
    lines = np.diff(np.searchsorted(np.flatnonzero(flat == 10), begin)) + 1.0
    return np.column_stack(
        [
            np.log1p(n),
            np.log1p(size * (n > 0)),
            mean,
            spread,
            distinct * per_word,
            alone * per_word,
            most * per_word,
            at_words(same),
            at_words(letters[end] == letters[start]),
            at_words(own_marks >= 2),
            at_words(own_marks >= 3),
            at_words((own_marks > 0) & ~closing),
            at_words(digits[end] > digits[start]),
            at_words(closing),
            at_words(opening),
            at_words(length > 20),
            at_words(length <= 2),
            per_byte(PUNCTUATION[flat]),
            per_byte(DIGIT[flat]),
            per_byte(CAPITAL[flat]),
            per_byte(flat >= 0x80),
            per_byte(flat == ord("|")),
            per_byte(np.isin(flat, [ord(c) for c in "#$%&*@~^<>{}[]\\_="])),
            lines * per_word * (n > 0),
            np.log1p(n / lines),
            per_byte(flat < 0x20),
        ]
    ).astype(np.float64)


def waves(count: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11)
    return draw.normal(size=(dims, count)) / (WIDTH * np.sqrt(dims)), draw.uniform(0, 2 * np.pi, count)


def lifted(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, count: int) -> np.ndarray:
    """Random Fourier features of standardised x, and a constant."""
    w, b = waves(count, x.shape[1])
    z = np.clip((x - mean) / scale, -8, 8)
    return np.column_stack([np.sqrt(2 / count) * np.cos(z @ w + b), np.ones(len(x))])


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def normal_equations(train: DataFrame, mean: np.ndarray, scale: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over train (x, label) of z z' and z label: (count + 1) squared numbers however many rows."""

    def partial(batches):
        a = np.zeros((count + 1, count + 2))
        for rows in batches:
            if rows.num_rows:
                z = lifted(matrix(rows.column("x")), mean, scale, count)
                y = rows.column("label").to_numpy(zero_copy_only=False).astype(float)
                a += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count + 1)), pa.array(list(a))], names=["i", "a"])

    rows = train.select("x", "label").mapInArrow(partial, "i long, a array<double>")
    # Summed cell by cell, so that no task holds the matrices of all partitions.
    cells = rows.select("i", F.posexplode("a").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    got = np.zeros((count + 1, count + 2))
    got[cells["i"], cells["j"]] = cells["v"]
    return got[:, :-1], got[:, -1]


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
    folds: int = 3,
    fold: int = 1,
    most_rows: int = MOST_ROWS,
    count: int = WAVES,
) -> DataFrame:
    """One row per row of docs: id, held_out, score (0 to 1), predicted (score >= 0.5).

    labels (doc_id, label) are learnt from only where crc32 of the id modulo folds is
    not fold, from most_rows rows at most (those with the smallest hashes): four fifths
    fit the scores, the rest their calibration.  Scores come from the text alone, all
    of it, which is read once.

    A null or empty text is scored by statistics that are 0.  A null id has no label and
    is not held out.  Rows that repeat are scored alike; of labels that repeat the
    largest counts.  Without labels of both kinds every score is their share of ones (0
    without any).  An empty table gives an empty one.  Other columns are not read,
    whatever their names.
    """
    own = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    out = [F.col("id").alias(id_col), held_out(F.col("id"), folds, fold).alias("held_out"), "score", "predicted"]

    def measure(batches):
        for rows in slices(batches, "text", SLICE):
            x = statistics(rows.column("text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows.column("id"), flat], names=["id", "x"])

    schema = T.StructType([T.StructField("id", own.schema["id"].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])
    measured = written(own.mapInArrow(measure, schema), "statistics")
    train = measured.join(labelled(labels, label, folds, fold, most_rows), "id")
    train = train.groupBy("id").agg(F.max("x").alias("x"), F.first("label").alias("label"))
    train = written(train.withColumn("part", part(F.col("id"), 5)), "train")
    fit_on, calibrate_on = train.where("part > 0"), train.where("part = 0")
    (n, ones), (m, more) = classes(fit_on), classes(calibrate_on)
    if min(ones, n - ones) < 5 or min(more, m - more) < 1:
        return constant(measured, (ones + more) / (n + m) if n + m else 0.0).select(*out)
    each = [f(F.col("x")[j]) for j in range(STATISTICS) for f in (F.avg, F.stddev_pop)]
    moments = np.array(fit_on.agg(*each).first(), float)
    mean, scale = moments[::2], np.where(moments[1::2] > 1e-9, moments[1::2], 1.0)
    a, b = normal_equations(fit_on, mean, scale, count)
    weight = np.linalg.solve(a + RIDGE * n * np.eye(count + 1), b)

    def score(batches):
        for rows in batches:
            raw = lifted(matrix(rows.column("x")), mean, scale, count) @ weight if rows.num_rows else np.zeros(0)
            squashed = 1 / (1 + np.exp(-4 * (raw - 0.5)))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in rows.schema.names if c != "x"), pa.array(squashed)], names=[*(c for c in rows.schema.names if c != "x"), "raw"])

    kind = T.StructType([schema["id"], T.StructField("raw", T.DoubleType())])
    with_label = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("raw", T.DoubleType())])
    calibrate = calibrate_on.select("label", "x").mapInArrow(score, with_label)
    return calibrated(measured.mapInArrow(score, kind), calibrate).select(*out)
