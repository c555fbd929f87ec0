"""Class labels: movement classes, codes and names."""

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonetape.schema import CLASS_NAMES, CLASSES


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def label_move(c, up: float = 1.0, down: float = -1.0) -> Column:
    """1 above `up`, -1 below `down`, 0 between, missing stays missing."""
    c = _col(c)
    return (
        F.when(c.isNull() | F.isnan(c), F.lit(None).cast("int"))
        .when(c > up, F.lit(1))
        .when(c < down, F.lit(-1))
        .otherwise(F.lit(0))
    )


def _lookup(pairs):
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(pairs)])


def encode_label(c, classes=CLASSES) -> Column:
    """Class -> 0..k-1 in sorted class order; an unknown class becomes 0."""
    codes = _lookup((v, float(i)) for i, v in enumerate(sorted(classes)))
    return F.coalesce(F.try_element_at(codes, _col(c)), F.lit(0.0))


def decode_label(c, classes=CLASSES) -> Column:
    """0..k-1 -> class; an unknown code becomes 0."""
    values = _lookup(enumerate(sorted(classes)))
    return F.coalesce(F.try_element_at(values, _col(c).cast("int")), F.lit(0))


def class_name(c, names=None) -> Column:
    """Class code -> display name; an unknown code is kept as text."""
    table = _lookup((CLASS_NAMES if names is None else names).items())
    c = _col(c)
    return F.coalesce(F.try_element_at(table, c), c.cast("string"))
