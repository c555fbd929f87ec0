"""Similarity join on word shingles by prefix filtering of the document-shingle matrix, with verification.

A row of the matrix is a distinct set of shingles (documents with equal sets are one
class), a column is a shingle.  Two sets link when their Jaccard similarity reaches
the threshold, and then they share many of their smallest shingles, in hash order.
So candidates come from those columns only, and no overlap is summed over them:

1. Each set's smallest shingles are dealt into column blocks.  A block passes on the
   entries of columns that two sets or more have; all others cannot make a pair.
2. Each set leaves out its most frequent columns, as many as the bound allows.
   Passages that very many documents share thus go away first.
3. The rows of a column meet its first row, then its last, then, in blocks of bounded
   size, all rows they are not yet linked with.  Pairs whose sizes or parity bits (a lower bound of the
   difference of two sets) rule the threshold out are discarded before they leave the
   join.  What is left is counted exactly, on the whole sets.
4. Links are joined to components between 3's steps and after them, so that a
   group of near copies costs a star and not all its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from tonetape.llm import words as W
from tonetape.llm.common import clashing, columns, discard, frugal, slices, written, written_texts
from tonetape.llm.components import components
from tonetape.llm.shared import blocks_for, packed, packed_schema, shared_entries

SLICE = 2 << 20
#: Rows of a column in one row block.
ROW_BLOCK = 512
#: Rows up to which a table of row numbers (a few dozen bytes each) is broadcast.
BROADCAST_ROWS = 500_000
#: Words of parity bits: a few go with every entry of the matrix, all with those that meet all others.
PARITY = [f"p{k}" for k in range(4)]
LONG_PARITY = [f"q{k}" for k in range(16)]
#: Smallest columns of a set that say whether a pair has met before.
FIRST = 16


def least_overlap(n: int, percent: int) -> int:
    """The smallest number of its n shingles that a set shares with one it links to."""
    return -(-n * percent // 100)


def set_schema() -> T.StructType:
    long = T.LongType()
    return T.StructType([T.StructField(c, long) for c in ("row", "n", "f0", "f1", *PARITY, *LONG_PARITY)] + [T.StructField("least", T.BinaryType())])


def summarised(rows: list[np.ndarray], percent: int) -> list[pa.Array]:
    """For each set: size, two fingerprints, parity bits, and its smallest shingles."""
    n = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate(rows) if rows else np.zeros(0, W.U)
    begin = np.append(0, np.cumsum(n))
    has = n > 0

    def each(op, values):
        out = np.zeros(len(n), W.U)
        if has.any():
            out[has] = op.reduceat(values, begin[:-1][has])
        return out.view(np.int64)

    bit, word = W.U(1) << (flat & W.U(63)), (flat >> W.U(6)) & W.U(15)
    long = [each(np.bitwise_xor, np.where(word == W.U(k), bit, W.U(0))) for k in range(16)]
    parity = [long[k] ^ long[k + 4] ^ long[k + 8] ^ long[k + 12] for k in range(4)]
    # One more tenth of the shingles than a pair needs: see frequent().
    least = [r[: len(r) - least_overlap(len(r), percent) + 1 + len(r) // 10].tobytes() if len(r) else b"" for r in rows]
    prints = [each(np.add, W.mixed(flat, salt)) for salt in (3, 4)]
    return [pa.array(n), *map(pa.array, prints), *map(pa.array, parity), *map(pa.array, long), pa.array(least, pa.binary())]


def frequent(n: Column, percent: int) -> Column:
    """How many of its most frequent columns a set of n may leave out.

    Two linked sets of n and m >= n * percent / 100 shingles have at least
    1 + min(n // 10, m // 10) shared ones among their listed columns, more than either
    leaves out; the rarest of those stays in both."""
    return F.floor(n * percent / 1000)


def shared_columns(sets: DataFrame, entries: int) -> DataFrame:
    """(column, row) of the listed shingles that several rows of sets have."""
    blocks, fields = blocks_for(entries), {"column": "long", "row": "long"}

    def deal(batches):
        for part in slices(batches, "least", SLICE):
            raw = part.column("least").to_pylist()
            size = np.array([len(v) // 8 for v in raw], np.int64)
            yield packed({"column": np.frombuffer(b"".join(raw), np.int64), "row": np.repeat(part.column("row").to_numpy(), size)}, blocks)

    return shared_entries(sets.select("row", "least").mapInArrow(frugal(deal), packed_schema(fields)), fields, blocks)


def may_link(a: str, b: str, percent: int, bits: list[str] = PARITY) -> Column:
    """Whether sizes and parity bits leave room for a link of rows a and b."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in bits), F.lit(0))
    # Linked: overlap o with 100 o >= percent (n + m - o), and the difference is n + m - 2 o.
    return (
        (F.least(n, m) * 100 >= F.greatest(n, m) * percent)
        & (differ * (100 + percent) <= (n + m) * (100 - percent))
    )


def small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def counted(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of rows of reps that link, by their whole sets, made anew from docs (id, text)."""
    wanted = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct()
    wanted = written(wanted.join(reps.select("row", "id", "f0", "f1"), "row"), "wanted")
    texts = docs.select("id", "text")
    both = texts.join(small(wanted, wanted.count()), texts["id"].eqNullSafe(wanted["id"])).select("row", "f0", "f1", "text")

    def whole(batches):
        for part in slices(batches, "text", SLICE):
            sets = W.shingle_sets(part.column("text"))
            prints = [np.array([W.mixed(s, salt).sum(dtype=W.U) for s in sets], W.U).view(np.int64) for salt in (3, 4)]
            mine = np.flatnonzero(np.logical_and(*(p == part.column(c).to_numpy() for p, c in zip(prints, ("f0", "f1")))))
            arrays = [part.column("row").take(pa.array(mine)), pa.array([sets[i].view(np.int64) for i in mine], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "shingles"])

    # Rows with the same id and the same set would come twice.
    sets = written_texts(both.mapInArrow(frugal(whole), "row long, shingles array<long>").dropDuplicates(["row"]), "sets")
    side = lambda c: sets.select(F.col("row").alias(c), F.col("shingles").alias(f"s{c}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    linked = written(joined.where(common * (100 + percent) >= (F.size("sa") + F.size("sb")) * percent).select("a", "b"), "linked")
    discard(wanted, sets)
    return linked


def labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """rows with the component of each, which is its own row if it has no link."""
    return rows.join(label.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))


def classes(docs: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Of docs (row, id, text): (row, id, n, f0, f1) of every row, and (f0, f1, n, rep, component_row, component_id) of every class."""

    def read(batches):
        for part in slices(batches, "text", SLICE):
            own = summarised(W.shingle_sets(part.column("text")), percent)
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), *own], names=["row", "id", *set_schema().names[1:]])

    schema = T.StructType([set_schema()["row"], docs.schema["id"], *set_schema().fields[1:]])
    sets = written_texts(docs.select("row", "id", "text").mapInArrow(frugal(read), schema), "summaries")
    prints = ["f0", "f1", "n"]
    # A null id is nobody's smallest.
    first = F.min(F.struct(F.col("id").isNull().alias("void"), "id", "row")).alias("first")
    groups = written(
        sets.where("n > 0").groupBy(*prints).agg(first, *(F.first(p).alias(p) for p in [*PARITY, *LONG_PARITY])).select(
            F.col("first.row").alias("row"), F.col("first.id").alias("id"), *prints, *PARITY, *LONG_PARITY
        ),
        "classes",
    )
    # Only classes' first rows go on; copies would make every column of theirs look shared.
    own = sets.select("row", "least").join(small(groups.select("row"), groups.count()), "row", "left_semi")
    entries = own.agg(F.sum(F.length("least"))).first()[0] or 0
    found = written(shared_columns(own, entries // 8), "shared")
    cells = written(found.join(groups.select("row", "n"), "row"), "cells")
    discard(found)
    df = written(cells.groupBy("column").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "columns")
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("df"), F.desc("column")))
    kept = cells.join(df, "column").withColumn("place", place).where(F.col("place") > frequent(F.col("n"), percent))
    product = written(kept.select("column", "row", "df").join(groups.select("row", "n", *PARITY), "row"), "product")
    discard(cells, df)

    # Two stars of every column: its first row with each other, then its last with those not linked to it yet.
    links = label = None
    for pick in (F.min, F.max):
        if label is None:
            mine = product.withColumn("component", F.col("row"))
        else:
            mine = labelled(product, label)
        mine = written(mine, "labelled")
        leader = written(mine.groupBy("column").agg(pick(F.struct("row", "n", *PARITY, "component")).alias("l")).select("column", "l.*"), "leaders")
        a, b = leader.alias("a"), mine.alias("b")
        on = (F.col("a.column") == F.col("b.column")) & (F.col("a.component") != F.col("b.component")) & may_link("a", "b", percent)
        pairs = a.join(b, on).select(F.least("a.row", "b.row").alias("a"), F.greatest("a.row", "b.row").alias("b"))
        pairs = written(pairs.distinct(), "star")
        found = counted(pairs, groups, docs, percent)
        links = found if links is None else written(links.unionByName(found), "links")
        discard(leader, pairs, mine)
        label = written(components(links), "labels")

    # All pairs of rows of a column that are not linked yet, block by block.
    mine = written(labelled(product, label), "labelled")
    open_columns = mine.groupBy("column").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    place = F.row_number().over(Window.partitionBy("row").orderBy("column"))
    first = F.collect_list(F.when(F.col("place") <= FIRST, F.col("column"))).over(Window.partitionBy("row"))
    rest = mine.select("column", "row", "df", "component").join(open_columns.select("column"), "column")
    rest = rest.withColumn("place", place).withColumn("first", first).drop("place").join(groups.select("row", "n", *LONG_PARITY), "row")
    rest = written(rest, "open")
    discard(mine, product, label)
    blocks = F.ceil(F.col("df") / ROW_BLOCK)
    rest = rest.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    left = rest.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1))).alias("a")
    right = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "block"))).alias("b")
    on = (
        (F.col("a.column") == F.col("b.column"))
        & (F.col("a.block") == F.col("b.other"))
        & (F.col("a.other") == F.col("b.block"))
        & ((F.col("a.block") < F.col("b.block")) | (F.col("a.row") < F.col("b.row")))
        & (F.col("a.component") != F.col("b.component"))
        & may_link("a", "b", percent, LONG_PARITY)
        # A pair that shares an earlier column leaves the join there.
        & ~F.arrays_overlap(F.filter("a.first", lambda c: c < F.col("a.column")), F.col("b.first"))
    )
    pairs = left.join(right, on).select(F.least("a.row", "b.row").alias("a"), F.greatest("a.row", "b.row").alias("b"))
    pairs = written(pairs.distinct(), "pairs")
    links = written(links.unionByName(counted(pairs, groups, docs, percent)), "links")
    label = components(links).withColumnRenamed("node", "row")
    named = groups.select("row", "id", *prints).join(label, "row", "left").withColumn("component", F.coalesce("component", "row"))
    named = written(named, "named")
    discard(rest, pairs)
    least = F.min(F.struct(F.col("id").isNull().alias("void"), "id", "row")).alias("least")
    best = named.groupBy("component").agg(least).select("component", F.col("least.row").alias("component_row"), F.col("least.id").alias("component_id"))
    best = written(best, "components")
    return sets.drop("least", *PARITY, *LONG_PARITY), named.join(best, "component").select(*prints, F.col("row").alias("rep"), "component_row", "component_id")


def placed(docs: DataFrame, percent: int) -> DataFrame:
    """(row, id, n, component_row, component_id) of every row of docs (row, id, text)."""
    rows, groups = classes(docs, percent)
    groups = written(groups, "placed")
    out = rows.join(groups, ["f0", "f1", "n"], "left")
    return out.select("row", "id", "n", F.coalesce("component_row", "row").alias("component_row"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; a set holds
    the distinct 5-word shingles of the whole text, or all words as one if there are
    fewer.  Two rows link when 100 * intersection >= percent * union; component_id is
    the smallest id that links reach.  No link between different texts is lost.

    A null or empty text, or one without words, has no shingles and links with nothing.
    A null id can be in a component but names it only if no other id does.  Repeated
    rows are one class.  An empty table gives an empty one.  Columns other than the id
    and the text are not read, whatever their names.
    """
    own = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    out = placed(own, percent)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """docs, all columns, with one row of each component: that with the smallest id.

    Rows without shingles all stay: null and empty texts, and those without words.  Of
    rows that repeat with the same id one stays; a null id comes after all others.  An
    empty table gives an empty one.  Columns may have any names."""
    row = clashing(docs, "dedup_row")
    tagged = written(docs.withColumn(row, F.monotonically_increasing_id()), "tagged")
    own = tagged.select(F.col(row).alias("row"), tagged[id_col].alias("id"), tagged[text_col].cast("string").alias("text"))
    gone = placed(own, percent).where(F.col("row") != F.col("component_row"))
    return tagged.join(gone.select(F.col("row").alias(row)), row, "left_anti").transform(lambda df: df.select(*columns(df, docs.columns)))
