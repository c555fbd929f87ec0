"""Reply trees to training conversations, in DataFrame operations only.

Messages point to the message they answer.  Self-joins double the reach of these
pointers round by round, so a thread of n messages takes log2(n) rounds.  They give
each message's root, depth and the sum of scores above it; leaves are ranked by
their path's mean score, and the chosen paths are read off the pointers, from the
longest reach to the shortest.  A path becomes one text with marked turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tonetape.llm.common import discard, written

START, END = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    """text without any "<|", so that no mark can appear in it.  See unescaped."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    """What escaped was given: its own backslashes are double, so a lone one after "<" is a mark."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\^"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\^"), F.lit("\n")))


def key(column: Column) -> Column:
    """A join key that null values share."""
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), column.cast("string")))


def reply_paths(messages: DataFrame, best: int | None) -> DataFrame:
    """(tree_key, leaf, node_key, depth, rank) of the best paths of each tree.

    messages: tree_key, node_key (unique in it), parent_key, score."""
    nodes = messages.select("tree_key", "node_key", "parent_key")
    known = nodes.select("tree_key", F.col("node_key").alias("up"), F.lit(True).alias("there"))
    jump = (
        messages.withColumnRenamed("parent_key", "up")
        .join(known, ["tree_key", "up"], "left")
        .select(
            "tree_key",
            "node_key",
            F.when(F.col("there"), F.col("up")).alias("up"),
            F.lit(1).cast("long").alias("steps"),
            F.coalesce("score", F.lit(0.0)).cast("double").alias("total"),
        )
    )
    columns = ["tree_key", "node_key", "up", "steps", "total"]
    jumps, ended = [written(jump.select(*columns), "jump0")], []
    most = messages.groupBy("tree_key").count().agg(F.max("count")).first()[0] or 0
    while True:
        # Only pointers that have not come to a root go on; those that have are looked up.
        ended.append(jumps[-1].where("up is null"))
        going = jumps[-1].where("up is not null")
        if 1 << (len(jumps) - 1) > most or going.isEmpty():
            break
        known = going
        for part in ended:
            known = known.unionByName(part)
        over = known.select(
            "tree_key", F.col("node_key").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("total").alias("above")
        )
        step = going.join(over, ["tree_key", "up"]).select(
            "tree_key",
            "node_key",
            F.col("next").alias("up"),
            (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("total") + F.col("above")).alias("total"),
        )
        jumps.append(written(step, f"jump{len(jumps)}"))
    rooted = ended[0]
    for part in ended[1:]:
        rooted = rooted.unionByName(part)
    parents = jumps[0].where("up is not null").select("tree_key", F.col("up").alias("node_key")).distinct()
    # What never comes to a root hangs on a circle and is in no path.
    leaves = (
        rooted.join(parents, ["tree_key", "node_key"], "left_anti")
        .select("tree_key", F.col("node_key").alias("leaf"), "steps", (F.col("total") / F.col("steps")).alias("path_score"))
    )
    if best is None:
        leaves = leaves.withColumn("rank", F.lit(None).cast("int"))
    else:
        order = Window.partitionBy("tree_key").orderBy(F.desc("path_score"), "leaf")
        leaves = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    path = leaves.select("tree_key", "leaf", "path_score", "rank", F.col("leaf").alias("node_key"), F.col("steps").alias("depth"))
    for k in reversed(range(len(jumps))):
        up = jumps[k].where("up is not null").select("tree_key", "node_key", "up")
        both = F.array(
            F.struct(F.col("node_key").alias("node"), F.col("depth").alias("at")),
            F.struct(F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("at")),
        )
        path = (
            path.join(up, ["tree_key", "node_key"], "left")
            .select("tree_key", "leaf", "path_score", "rank", F.explode(F.when(F.col("up").isNull(), F.slice(both, 1, 1)).otherwise(both)).alias("p"))
            .select("tree_key", "leaf", "path_score", "rank", F.col("p.node").alias("node_key"), F.col("p.at").alias("depth"))
        )
    out = written(path, "path")
    discard(*jumps)
    return out


def conversations(
    messages: DataFrame,
    tree: str = "tree_id",
    node: str = "message_id",
    parent: str = "parent_id",
    role: str = "role",
    text: str = "text",
    score: str | None = "score",
    best: int | None = 1,
    train_on: str = "assistant",
) -> DataFrame:
    """One row per chosen path: tree, leaf, path_score, rank, n_turns, formatted, loss_runs.

    The paths run from a root (null or unknown parent) to a message nobody answers;
    those with the highest mean score are chosen, best of each tree (None: all,
    unranked), ties to the smallest leaf.  formatted marks each turn with START, role,
    newline, text, END, newline; control strings inside texts and roles are escaped
    and come back with read_back.  loss_runs says of each turn how many characters
    carry no loss (skip), how many then do (take: the text of a train_on turn) and
    how many then do not (rest); together they are as long as formatted.

    Null texts and roles are empty, a null score is 0.  Null trees share one tree and
    null messages one node of it.  Of rows with the same tree and message one stays, the
    smallest.  Messages on a circle of answers, or below one, have no root and are in no
    path.  An empty table gives none.  Other columns are not read, whatever their names.
    """
    content = F.struct(
        F.coalesce(messages[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(messages[text].cast("string"), F.lit("")).alias("text"),
        (messages[score].cast("double") if score else F.lit(None).cast("double")).alias("score"),
        messages[tree].alias("tree"),
        messages[node].alias("node"),
    )
    own = messages.select(
        key(messages[tree]).alias("tree_key"),
        key(messages[node]).alias("node_key"),
        F.when(messages[parent].isNotNull(), key(messages[parent])).alias("parent_key"),
        content.alias("content"),
    )
    own = own.groupBy("tree_key", "node_key").agg(F.min(F.struct("parent_key", "content")).alias("m"))
    own = written(own.select("tree_key", "node_key", "m.parent_key", "m.content.*"), "messages")
    path = reply_paths(own.select("tree_key", "node_key", "parent_key", "score"), best)
    turn = F.struct("depth", "role", "text").alias("turn")
    last = F.max(F.when(F.col("node_key") == F.col("leaf"), F.struct("node"))).getField("node")
    paths = (
        path.join(own, ["tree_key", "node_key"])
        .groupBy("tree_key", "leaf")
        .agg(
            F.first("tree").alias(tree),
            last.alias("leaf_id"),
            F.first("path_score").alias("path_score"),
            F.first("rank").alias("rank"),
            F.sort_array(F.collect_list(turn)).alias("turns"),
        )
    )
    return format_turns(paths, train_on).select(
        tree, F.col("leaf_id").alias("leaf"), "path_score", "rank", F.size("turns").cast("long").alias("n_turns"), "formatted", "loss_runs"
    )


def format_turns(paths: DataFrame, train_on: str) -> DataFrame:
    """paths with formatted and loss_runs, of its turns (role, text) in order."""
    head = lambda t: F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n"))
    line = F.transform("turns", lambda t: F.concat(head(t), escaped(t["text"]), F.lit(END + "\n")))
    trained = lambda t: t["role"] == train_on
    runs = F.transform(
        "turns",
        lambda t: F.struct(
            F.when(trained(t), F.length(head(t))).otherwise(F.length(head(t)) + F.length(escaped(t["text"])) + len(END) + 1).alias("skip"),
            F.when(trained(t), F.length(escaped(t["text"]))).otherwise(0).alias("take"),
            F.when(trained(t), len(END) + 1).otherwise(0).alias("rest"),
        ),
    )
    return paths.withColumns({"formatted": F.array_join(line, ""), "loss_runs": runs})


def read_back(table: DataFrame) -> DataFrame:
    """table with turns (role, text) and loss (of each turn, what lies under the mask), from formatted and loss_runs alone."""
    tail = len(END) + 1
    parts = F.slice(F.split("formatted", START.replace("|", "\\|")), 2, F.size("loss_runs"))
    role = lambda p: F.substring_index(p, "\n", 1)
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescaped_role(role(p)).alias("role"),
            unescaped(p.substr(F.length(role(p)) + 2, F.length(p) - F.length(role(p)) - 1 - tail)).alias("text"),
        ),
    )
    # A part lacks its START, which skip counts.
    loss = F.zip_with(
        parts, "loss_runs", lambda p, r: unescaped(p.substr(r["skip"] - len(START) + 1, r["take"]))
    )
    return table.withColumns({"turns": turns, "loss": loss})
