"""Prefix trie of conversations: which of them begin alike, and what sharing would save.

A node is a distinct sequence of first turns, named by 128 bits that each turn, with its
place, adds to the name of the sequence before it; so names are running sums, taken in
bands of places.  A node knows its ancestors inside its band of depths, at most `height`.
Subtree totals take one step a band: nodes add to their ancestors in the band, the roots
of bands form a smaller trie that is summed the same way, and the completed totals of
band roots are added to the ancestors in the band above.  A trie of depth D takes
log(D) rounds to the base `height`, and no node explodes to more than `height` rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tonetape.llm.common import discard, written

HEIGHT = 32
#: Turns that a rebuilt conversation may take from another, conversations that share one, and ids in one piece (as bits).
HEADS, FAMILY, PIECE_BITS = 6, 100, 10


def turn_rows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv, place (from 1), digest of role and text, and code points of the text.

    Turns are ordered by number (null first), those that tie by digest; a null role or
    text is empty; rows without a conversation are none.  Rows are dealt to slices by
    range and numbered inside them, and the sizes of the slices before are added, so a
    conversation of any length spreads over tasks.  Texts are not shuffled."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    own = turns.select(turns[conv_col].cast("long").alias("conv"), turns[turn_col].alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    own = written(own.where("conv IS NOT NULL"), "turns")
    by = [F.asc_nulls_first("turn"), "digest", "tie"]
    sliced = own.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("conv", *by)
    sliced = written(sliced.withColumn("slice", F.spark_partition_id()), "slices")
    discard(own)
    here = F.row_number().over(Window.partitionBy("conv", "slice").orderBy(*by))
    before = F.sum("count").over(Window.partitionBy("conv").orderBy("slice")) - F.col("count")
    sizes = sliced.groupBy("conv", "slice").count().select("conv", "slice", before.alias("before"))
    out = sliced.withColumn("here", here).join(sizes, ["conv", "slice"])
    out = written(out.select("conv", (F.col("here") + F.col("before")).alias("place"), "digest", "chars"), "places")
    discard(sliced)
    return out


def with_family_heads(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows of turn_rows where conversation c begins with the first h turns of c - c % FAMILY
    instead of its own first h, h being crc32 of c as text modulo HEADS; and all conversations.

    Turns are taken as far as there are any; a conversation may end up without one."""
    family, h = F.col("conv") - F.col("conv") % FAMILY, F.crc32(F.col("conv").cast("string")) % HEADS
    convs = rows.groupBy("conv").agg(F.max("place").alias("n")).withColumns({"family": family, "h": h})
    convs = written(convs, "convs")
    first = convs.select(F.col("conv").alias("family"), F.col("n").alias("there"))
    taken = F.least(F.col("h"), F.coalesce(F.col("there"), F.lit(0)))
    own = rows.where(F.col("place") > h).join(convs.join(first, "family", "left").select("conv", "h", taken.alias("taken")), "conv")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "chars")
    heads = rows.where(F.col("place") < HEADS).withColumnRenamed("conv", "family")
    lent = convs.join(heads, "family").where("place <= h").select("conv", "place", "digest", "chars")
    return own.unionByName(lent), convs.select("conv")


def running(rows: DataFrame, most: int, height: int) -> DataFrame:
    """rows (conv, place from 0 to most, x1, x2, ...) with p1 and p2, the running sums of x1 and x2.

    Sums run inside bands of height places; those of whole bands are summed the same way."""
    rows = rows.withColumn("band", F.expr(f"place div {height}"))
    w = Window.partitionBy("conv", "band").orderBy("place")
    out = rows.withColumns({f"p{i}": F.bit_xor(f"x{i}").over(w) for i in (1, 2)})
    if most < height:
        return out.drop("band")
    bands = rows.groupBy("conv", F.col("band").alias("place")).agg(*(F.bit_xor(f"x{i}").alias(f"x{i}") for i in (1, 2)))
    above = running(bands, most // height, height)
    above = above.select("conv", F.col("place").alias("band"), *(F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"q{i}") for i in (1, 2)))
    out = out.join(above, ["conv", "band"])
    return out.withColumns({f"p{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"q{i}")) for i in (1, 2)}).drop("band", "q1", "q2")


def with_lines(steps: DataFrame, unit: int, height: int) -> DataFrame:
    """steps at depths that unit divides, with line: the names from the root of the band of
    height such depths to the step's own, at most height of them."""
    w = Window.partitionBy("conv", F.expr(f"place div {unit * height}")).orderBy("place")
    return steps.where(F.col("place") % unit == 0).withColumn("line", F.collect_list(F.struct("p1", "p2")).over(w))


NAME, PARENT = ["p1", "p2"], ["q1", "q2"]


def total(rows: DataFrame, sums: list[str]) -> DataFrame:
    """sums by name, each row of rows counted for all names of its line."""
    rows = rows.select(F.explode("line").alias("at"), *sums).select("at.p1", "at.p2", *sums)
    return rows.groupBy(*NAME).agg(*(F.sum(c).alias(c) for c in sums))


def rolled_up(nodes: DataFrame, steps: DataFrame, sums: list[str], most: int, height: int, unit: int = 1) -> DataFrame:
    """(p1, p2, *sums): the sums over the subtree of each of nodes (p1, p2, q1, q2, depth, line, *sums)."""
    inside = total(nodes, sums)
    if most < height:
        return inside
    inside = written(inside, "inside")
    # The roots of bands below the first: their parent is the last node of a line above.
    above = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("line").alias("above"))
    roots = nodes.where((F.col("depth") % height == 0) & (F.col("depth") > 0)).select(*NAME, *PARENT, "depth")
    top = nodes.where("depth = 0").select(*NAME, *PARENT, "depth")
    edges = roots.join(above, PARENT).select(*NAME, F.col("above")[0]["p1"].alias("q1"), F.col("above")[0]["p2"].alias("q2"), "depth")
    lines = with_lines(steps, unit * height, height).groupBy(*NAME).agg(F.first("line").alias("line"))
    small = edges.unionByName(top).withColumn("depth", F.expr(f"depth div {height}"))
    small = written(small.join(inside, NAME).join(lines, NAME), "roots")
    whole = written(rolled_up(small, steps, sums, most // height, height, unit * height), "whole")
    # Roots that share a parent go up together.
    up = roots.select(*NAME, *PARENT).join(whole, NAME).groupBy(*PARENT).agg(*(F.sum(c).alias(c) for c in sums))
    handed = total(up.join(above.withColumnRenamed("above", "line"), PARENT), sums)
    out = inside.unionByName(handed).groupBy(*NAME).agg(*(F.sum(c).alias(c) for c in sums))
    out = written(out, "sums")
    discard(inside, small, whole)
    return out


def listed_hash(rows: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256) of rows (p1, p2, conv): SHA-256 of the numbers conv, ascending, joined by commas.

    Pieces of 2^PIECE_BITS numbers are joined first; a hash is fed piece by piece, so
    that memory does not follow the length of a list."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = rows.groupBy(*NAME, F.shiftright("conv", PIECE_BITS).alias("piece")).agg(ids.alias("ids"))

    def feed(batches):
        name, state = None, None
        for batch in batches:
            done = []
            for p1, p2, ids in zip(*(batch.column(c).to_pylist() for c in (*NAME, "ids"))):
                if (p1, p2) == name:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    done.append((*name, state.hexdigest()))
                name, state = (p1, p2), hashlib.sha256(ids.encode())
            if done:
                yield made(done)
        if state:
            yield made([(*name, state.hexdigest())])

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[*NAME, "ends_sha256"])

    pieces = pieces.repartition(*NAME).sortWithinPartitions(*NAME, "piece")
    return pieces.mapInArrow(feed, "p1 long, p2 long, ends_sha256 string")


def prefix_trie(rows: DataFrame, convs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per distinct sequence of first turns of convs (conv, each once), whose turns
    are rows (conv, place from 1 without gaps, digest, chars).

    conv_id is the smallest conversation that begins so, depth the number of turns,
    parent_conv_id the conv_id of the sequence without the last turn (root: null), n_convs
    how many begin so, n_children the distinct sequences of one turn more, n_leaves those
    in the subtree that nothing goes on from, saved_tokens the sum over the subtree of
    (n_convs - 1) * chars of the last turn, ends_sha256 the hash of the ids of the
    conversations that end there.  The root has depth 0 and no text; every conversation,
    also one without turns, begins with it.  Without conversations there is no node.
    Sequences are equal if their names of 128 bits are."""
    x = lambda salt: F.xxhash64(F.lit(salt), F.col("place"), F.col("digest"))
    steps = rows.select("conv", F.col("place").cast("long").alias("place"), x(1).alias("x1"), x(2).alias("x2"), "chars")
    zero = {c: F.lit(0).cast("long") for c in ("place", "x1", "x2", "chars")}
    steps = written(steps.unionByName(convs.select("conv").withColumns(zero)), "steps")
    most = steps.agg(F.max("place")).first()[0] or 0
    named = running(steps, most, height)
    before = [F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"q{i}") for i in (1, 2)]
    named = written(named.select("conv", "place", "p1", "p2", *before, "chars"), "names")
    discard(steps)
    one = lambda c: F.first(c).alias(c)
    nodes = with_lines(named, 1, height).groupBy(*NAME).agg(
        F.first("place").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv").alias("conv_id"),
        *map(one, [*PARENT, "chars", "line"]),
    )
    nodes = written(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(*PARENT).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children.toDF(*NAME, "n_children"), NAME, "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
            "n_leaves": F.col("n_children").isNull().cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
        }
    )
    nodes = written(nodes, "weighed")
    sums = ["n_leaves", "saved_tokens"]
    sums_of = rolled_up(nodes.select(*NAME, *PARENT, "depth", "line", *sums), named, sums, most, height)
    last = named.groupBy("conv").agg(F.max("place").alias("place"))
    ends = listed_hash(named.join(last, ["conv", "place"]).select(*NAME, "conv"))
    parent = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    # The root's own name is that of its parent too, having no turn.
    parent_id = F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id")
    out = nodes.drop("line", *sums).join(sums_of, NAME).join(parent, PARENT, "left").join(ends, NAME, "left")
    hashed: Column = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    return out.select("conv_id", "depth", parent_id, "n_convs", "n_children", *sums, hashed)


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", height: int = HEIGHT) -> DataFrame:
    """prefix_trie of the conversations in turns, as with_family_heads rebuilds them.

    Rows may repeat and tie (they are turns of their own, ordered by digest), a null
    turn comes first, a null role or text is empty, a row without a conversation is
    left out, an empty table has no node.  Other columns are not read, whatever their
    names."""
    rows, convs = with_family_heads(turn_rows(turns, conv_col, turn_col, role_col, text_col))
    return prefix_trie(rows, convs, height)
