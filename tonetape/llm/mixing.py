"""Mixing of sources to target weights by entropy balancing.

Targets come from the sources' weights, capped at a multiple of each source's size.
The rates at which a source's documents are taken solve a convex problem: as close to
one copy each as can be (in a relative entropy between 0 and the cap) with the target
number of words.  Its dual has one unknown per source; Newton's method solves all of
them at once over the counts of documents by source and size.  The rates, tilted
exponentially in the square root of a document's size, are then rounded to copies,
large documents first, each making up for the error of those before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from tonetape.llm import words as W
from tonetape.llm.common import clashing, columns, discard, frugal, slices, written, written_texts

SLICE = 2 << 20
#: Documents that are rounded one after another, about.
CELL = 4096
#: Sources up to which their table (a row each) is broadcast.
BROADCAST_ROWS = 100_000
#: Newton's method ends at this relative error of a source's words, or after so many steps.
CLOSE, STEPS = 1e-11, 60
#: Decimals of a tilt.  Sums differ in their last bits from run to run; what is rounded so far does not.
DECIMALS = 7


def key(column: Column) -> Column:
    """A join key that null values share."""
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), column.cast("string")))


def sized(docs: DataFrame) -> DataFrame:
    """docs (row, id, source, text) with size, its number of words, instead of text."""

    def count(batches):
        for part in slices(batches, "text", SLICE):
            flat, begin = W.joined(part.column("text"))
            n = np.diff(np.searchsorted(W.words(flat)[0], begin))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "id", "source")), pa.array(n, pa.int64())], names=["row", "id", "source", "size"])

    schema = T.StructType([*(docs.schema[c] for c in ("row", "id", "source")), T.StructField("size", T.LongType())])
    return docs.select("row", "id", "source", "text").mapInArrow(frugal(count), schema)


def numbered(sources: DataFrame) -> DataFrame:
    """sources with place, their number in code point order, null last: ranges are sorted apart and their counts added up."""
    ranged = sources.repartitionByRange(F.col("source").isNull(), F.col("source")).sortWithinPartitions(F.col("source").isNull(), "source")
    ranged = written(ranged.withColumn("range", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "ranges")
    # One row for each partition.
    before = ranged.groupBy("range").count().withColumn("before", F.sum("count").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("range", F.coalesce("before", F.lit(0)).alias("before"))
    out = ranged.join(before, "range").withColumn("place", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1))
    return out.drop("range", "at", "before", "count")


def targets(sources: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """sources (place, total) with target: total words shared by weight, none above cap * total.

    The shares settle at one level of words per weight; each round only brings three
    numbers to the driver."""
    table = F.array(*(F.lit(float(w)) for w in weights))
    own = written(sources.withColumn("weight", F.get(table, (F.col("place") % len(weights)).cast("int"))), "weighted")
    most = cap * F.col("total")
    words = own.agg(F.sum("total")).first()[0] or 0
    full, level = -1, 0.0
    while words:
        above = F.col("weight") * level > most
        number, held, weight = own.agg(
            F.sum(above.cast("long")), F.sum(F.when(above, most).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        if number == full or not weight:
            break  # no more sources are full than at the level before
        full, level = number, (words - held) / weight
    return own.withColumn("target", F.least(most, F.col("weight") * F.lit(float(level)))).drop("weight")


def rate(tilt: Column, x: Column, cap: float) -> Column:
    """Copies of a document: 1 without tilt, between 0 and cap, exponential in tilt * x."""
    e = F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), tilt * x)))
    return cap * e / (cap - 1 + e)


def is_full(cap: float) -> Column:
    return F.col("target") >= cap * F.col("total") * (1 - 1e-12)


def balanced(sizes: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """sources (source_key, total, docs, target) with tilt, by Newton's method on the dual."""
    counts = written(sizes.where("size > 0").groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    state = sources.select("source_key", (F.col("total") / F.col("docs")).alias("mean"), "target", F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("lo"), F.lit(1e6).alias("hi"), is_full(cap).alias("done"))
    # No tilt is enough for a source at its cap, which takes every document cap times.
    state = written(state, "state")
    for _ in range(STEPS):
        x = F.sqrt(F.col("size") / F.col("mean"))
        r = rate(F.col("tilt"), x, cap)
        each = counts.join(state, "source_key").where(~F.col("done"))
        sums = each.groupBy("source_key").agg(
            F.sum(F.col("n") * F.col("size") * r).alias("taken"), F.sum(F.col("n") * F.col("size") * x * r * (1 - r / cap)).alias("slope")
        )
        off = F.col("taken") - F.col("target")
        lo, hi = F.when(off < 0, F.col("tilt")).otherwise(F.col("lo")), F.when(off > 0, F.col("tilt")).otherwise(F.col("hi"))
        step = F.col("tilt") - off / F.col("slope")
        inside = (F.col("slope") > 0) & (step > lo) & (step < hi)
        middle = F.when(lo == -1e6, F.least(2 * F.col("tilt"), F.lit(-1.0))).when(hi == 1e6, F.greatest(2 * F.col("tilt"), F.lit(1.0))).otherwise((lo + hi) / 2)
        done = F.col("done") | F.col("taken").isNull() | (F.abs(off) <= CLOSE * F.col("target"))
        after = written(
            state.join(sums, "source_key", "left").select(
                "source_key", "mean", "target",
                F.when(done, F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
                F.when(done, F.col("lo")).otherwise(lo).alias("lo"),
                F.when(done, F.col("hi")).otherwise(hi).alias("hi"),
                done.alias("done"),
            ),
            "state",
        )
        discard(state)
        state = after
        if state.where(~F.col("done")).isEmpty():
            break
    discard(counts)
    return sources.join(state.select("source_key", "mean", F.round("tilt", DECIMALS).alias("tilt")), "source_key")


def rounded(rates: DataFrame, cap: float) -> DataFrame:
    """rates (source_key, cell, size, id, row, rate) as copies: whole numbers whose words add up to what the rates say."""
    most = int(cap)

    def run(batches):
        cell, error = None, 0.0
        for batch in batches:
            copies = np.zeros(batch.num_rows, np.int64)
            for i, (source, part, size, r) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("source_key", "cell", "size", "rate")))):
                if (source, part) != cell:
                    cell, error = (source, part), 0.0
                copies[i] = min(most, max(0, round(r + error / size))) if size else 1
                error += (r - copies[i]) * size
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(copies)], names=names)

    names = ["row", "id", "size", "total", "target", "rate", "copies"]
    schema = T.StructType([*(rates.schema[c] for c in names[:-1]), T.StructField("copies", T.LongType())])
    dealt = rates.repartition("source_key", "cell").sortWithinPartitions("source_key", "cell", F.desc("size"), "id", "row")
    return dealt.select("source_key", "cell", *names[:-1]).mapInArrow(frugal(run), schema)


def decided(docs: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """(row, id, size, total, target, rate, copies) of every row of docs (row, id, source, text)."""
    sizes = written_texts(sized(docs).withColumn("source_key", key(F.col("source"))), "sizes")
    sources = sizes.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("total"), F.count(F.lit(1)).alias("docs"))
    sources = written(targets(numbered(sources), weights, cap), "targets")
    found = written(balanced(sizes, sources, cap), "tilts").drop("source", "place")
    n = found.count()
    found = F.broadcast(found) if n <= BROADCAST_ROWS else found
    r = F.when(F.col("size") == 0, 1.0).when(is_full(cap), float(cap)).otherwise(rate(F.col("tilt"), F.sqrt(F.col("size") / F.col("mean")), cap))
    cell = F.pmod(F.xxhash64("id", "size"), F.ceil(F.col("docs") / CELL))
    return rounded(sizes.join(found, "source_key").withColumn("rate", r).withColumn("cell", cell), cap)


def mixture(
    docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """One row per row of docs: id, size, source_size, target, taken, copies, rate.

    size is the number of words (runs of bytes other than ASCII white space).  Sources
    in code point order, null last, have the weights in turn and share all words by
    them; none gets more than cap times its own, the excess is shared again by weight.
    taken = copies * size, copies a whole number up to cap.  Reruns agree.

    A null or empty text has size 0, is taken once and weighs nothing.  A source of no
    words has target 0.  Repeated rows are decided one by one, the same whichever comes
    first.  A null id is an id like any other.  An empty table gives an empty one.
    Columns other than the id, text and source are not read, whatever their names.
    """
    row = F.monotonically_increasing_id().alias("row")
    own = docs.select(row, docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), docs[text_col].cast("string").alias("text"))
    out = decided(own, weights, cap)
    return out.select(
        F.col("id").alias(id_col), "size", F.col("total").alias("source_size"), "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate"
    )


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """docs, all columns, each row as often as mixture takes it.

    A null or empty text is taken once; repeated rows, null ids and null sources are as
    in mixture.  An empty table gives an empty one.  Columns may have any names."""
    row, copy = clashing(docs, "mix_row"), clashing(docs, "mix_copy")
    tagged = written(docs.withColumn(row, F.monotonically_increasing_id()), "tagged")
    own = tagged.select(F.col(row).alias("row"), tagged[id_col].alias("id"), tagged[source_col].cast("string").alias("source"), tagged[text_col].cast("string").alias("text"))
    copies = decided(own, weights, cap).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copy))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copy)))
    return tagged.join(copies, row).withColumn(copy, times).transform(lambda df: df.select(*columns(df, docs.columns)))
