"""Exact duplicates by a tree merge of digest runs, in DataFrame operations only.

Every row is one entry: the digest of its text, its id and a row number.  The
entries lie in numbered runs.  In each round a block of fan_in neighbouring runs is
merged into one (two runs and the binomial exchange with fan_in 2): rows of a
block meet by digest, sorted, and of equal entries the one that stays goes on with
the count of all.  A group that holds a third of the rows is thus cut down in every
run first, and no task sees more than fan_in entries of a digest from the runs of
its block.  Entries count as equal only if SHA-256, byte length and a second hash
agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tonetape.llm.common import clashing, columns, written

KEY = ["digest", "size", "check"]


def entries(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """The columns of a run's entry for each row of docs."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    return [
        docs[id_col].alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.length(text).cast("long").alias("size"),
        F.xxhash64(text).alias("check"),
        F.monotonically_increasing_id().alias("row"),
    ]


def merge_runs(table: DataFrame, keep: str, runs: int, fan_in: int) -> DataFrame:
    """One row per digest that several rows of table have: kept_id, kept_row, group_size."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be 'largest' or 'smallest', not {keep!r}")
    # A null id stays only where there is no other.
    rank = F.struct((F.col("id").isNotNull() if keep == "largest" else F.col("id").isNull()).alias("void"), "id", "row")
    best = F.max if keep == "largest" else F.min
    level = table.select(*KEY, rank.alias("top"), F.lit(1).cast("long").alias("n"), F.pmod(F.xxhash64("row"), F.lit(runs)).alias("run"))
    while True:
        runs = -(-runs // fan_in)
        keys = ["run", *KEY] if runs > 1 else KEY
        level = level.withColumn("run", F.floor(F.col("run") / fan_in)).groupBy(*keys).agg(best("top").alias("top"), F.sum("n").alias("n"))
        if runs == 1:
            break
    groups = level.where("n > 1")
    return groups.select(*KEY, F.col("top.id").alias("kept_id"), F.col("top.row").alias("kept_row"), F.col("n").alias("group_size"))


def decide(table: DataFrame, keep: str, runs: int, fan_in: int) -> DataFrame:
    """The entries of table with keep_id, group_size and kept."""
    # Written first: the sides of the join are then dealt anew, and a hot digest can be split.
    groups = written(merge_runs(table, keep, runs, fan_in), "groups")
    alone = F.col("group_size").isNull()
    return table.join(groups, KEY, "left").select(
        "id",
        "row",
        "digest",
        F.when(alone, F.col("id")).otherwise(F.col("kept_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("kept_row"))).alias("kept"),
    )


def copy_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", runs: int = 64, fan_in: int = 4
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are; null counts as empty.  Of equal texts
    the row with the largest (or smallest) id stays; a null id only if all are null;
    of repeated rows with that id exactly one is kept.  An empty table gives an empty
    one.  Columns other than the id and the text are not read, whatever their names.
    """
    table = written(docs.select(*entries(docs, id_col, text_col)), "entries")
    found = decide(table, keep, runs, fan_in)
    return found.select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", runs: int = 64, fan_in: int = 4
) -> DataFrame:
    """docs, all columns, with the one row of each text that copy_groups keeps.

    A null text is an empty one; empty texts are copies of each other, and a very long
    one is compared whole.  Of rows that repeat with the same id any one stays, they
    being alike in id and text.  A null id is smaller than all others.  An empty table
    gives an empty one.  Columns may have any names."""
    row = clashing(docs, "dedup_row")
    tagged = written(docs.withColumn(row, F.monotonically_increasing_id()), "tagged")
    own = [c.alias("row") if i == 4 else c for i, c in enumerate([*entries(tagged, id_col, text_col)[:4], tagged[row]])]
    gone = decide(written(tagged.select(*own), "entries"), keep, runs, fan_in).where(~F.col("kept"))
    return tagged.join(gone.select(F.col("row").alias(row)), row, "left_anti").transform(lambda df: df.select(*columns(df, docs.columns)))
