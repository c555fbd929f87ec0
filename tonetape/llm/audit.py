"""How filters overlap: what each one removes, in every order in which they can be applied.

A row's failures are bits of a mask, and rows are counted by part and mask: at most
2^n cells a part for n filters, however many rows.  A recursive query starts from the
empty prefix of a part, extends each prefix by the filters it does not hold yet, joins
the part's cells and carries the bits applied so far; every level emits what its last
filter does.  An order of filters reads its steps off its prefixes, so 5 filters take
325 steps a part and not 120 times 5.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame, functions as F

from tonetape.llm.common import discard, written

#: Characters between words, as a class of a regular expression.
BLANK = r"\x20\x09-\x0D"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of a text, none null: short, repetitive, shouting, and holding marks."""
    words = F.filter(F.split(text, f"[{BLANK}]+"), lambda w: w != "")
    long = lambda c: c.cast("long")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * long(F.size(F.array_distinct(words))) < 80 * long(F.size(words)),
        "C": 100 * long(capitals) > 10 * long(F.length(text)),
        "D": text.rlike(r"[#$%&*|]"),
    }


def repeats_smaller(rows: DataFrame) -> DataFrame:
    """rows (id, digest, ...) counted as n, with `again`: the digest occurs with a smaller id.

    Digests are aggregated to their smallest id; a row is looked up by digest and id, so
    a digest that a third of all rows share is no hot key of the join."""
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    rows = written(rows, "rows")
    first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"))
    first = first.withColumn("first", F.lit(True))
    out = rows.join(first, ["digest", "id"], "left")
    return out.withColumn("again", F.col("id").isNotNull() & F.col("first").isNull()).drop("first")


def mask_cells(rows: DataFrame, bits: list[Column]) -> DataFrame:
    """One row per part of rows (part, n, good, toxic, ...): its counts by mask, bit i of it being bits[i]."""
    mask = sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0))
    # A condition weighs its row as often as the row occurs.
    weigh = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    cells = rows.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").alias("n"), weigh("good").alias("good"), weigh("toxic").alias("toxic")
    )
    return cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


#: The counts of a step over the cells x of its part: w.applied are the filters before it, f.bit its own.
STEP = {
    "kept": ("x.mask & (w.applied | f.bit) = 0", "x.n"),
    "removed": ("x.mask & w.applied = 0 AND x.mask & f.bit <> 0", "x.n"),
    "redundant": ("x.mask & w.applied <> 0 AND x.mask & f.bit <> 0", "x.n"),
    "unique_fails": ("x.mask = f.bit", "x.n"),
    "good_lost": ("x.mask & w.applied = 0 AND x.mask & f.bit <> 0", "x.good"),
    "toxic_lost": ("x.mask & w.applied = 0 AND x.mask & f.bit <> 0", "x.toxic"),
}


def prefixes(cells: DataFrame, letters: str) -> DataFrame:
    """What the last filter of every prefix of every order does, one row per part and prefix.

    The recursion has a level per filter.  cells must be a written table: every level reads it."""
    pairs = ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(letters))
    counts = ", ".join(
        f"aggregate(c.cells, 0L, (s, x) -> s + CASE WHEN {test} THEN {value} ELSE 0L END) AS {name}"
        for name, (test, value) in STEP.items()
    )
    spark = cells.sparkSession
    query = f"""
        WITH RECURSIVE walk (part, prefix, applied, step, {', '.join(STEP)}) AS (
            SELECT part, '', 0, 0, {', '.join(['0L'] * len(STEP))} FROM {{cells}}
            UNION ALL
            SELECT w.part, concat(w.prefix, f.letter), w.applied | f.bit, w.step + 1, {counts}
            FROM walk w JOIN {{cells}} c ON w.part = c.part
                LATERAL VIEW inline(array({pairs})) f AS letter, bit
            WHERE w.applied & f.bit = 0
        )
        SELECT * FROM walk WHERE step > 0
    """
    # The engine stops a recursion after a million rows, which would cap the parts.
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return written(spark.sql(query, cells=cells), "prefixes")
    finally:
        spark.conf.set(limit, before)


def orders(steps: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of all filters, and step of it, from the rows of its prefixes."""
    n = len(letters)
    whole = steps.where(F.col("step") == n).select("part", F.col("prefix").alias("filter_order"))
    at = whole.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    at = at.withColumn("prefix", F.expr("left(filter_order, step)"))
    # A prefix of k filters begins (n - k)! orders.
    weight = sum((F.when(F.col("step") == k, factorial(n - k)).otherwise(0) for k in range(1, n + 1)), F.lit(0))
    letter = F.expr("right(prefix, 1)").alias("letter")
    share = steps.groupBy("part", letter).agg(F.sum(F.col("removed") * weight).alias("shapley"))
    out = at.join(steps, ["part", "prefix", "step"]).withColumn("letter", F.expr("right(prefix, 1)"))
    return out.join(share, ["part", "letter"]).select("part", "filter_order", "step", *STEP, "shapley")


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """One row per part, order of the filters A to E, and step of the order.

    A to D are text_filters; E: the text is that of a smaller id, wherever that row is
    and whatever becomes of it.  Counts of rows within the part: kept after the step,
    removed by it, redundant (failing its filter, removed before), unique_fails (failing
    its filter only), good_lost and toxic_lost (removed by it with label 1); shapley is
    what its filter removes, summed over all orders.

    A null text is empty, a null part the empty string; an empty text fails A and, after
    its first id, E.  Rows that repeat are counted as often as they occur and do not
    fail E for each other, having one id; a null id fails no E, makes none fail, and has
    no label.  Of labels that repeat the largest counts; a null label is none.  Texts
    are equal if their SHA-256 is.  Parts without rows do not occur, so an empty table
    gives an empty one.  Other columns are not read, whatever their names.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    part = F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part")
    own = docs.select(docs[id_col].alias("id"), part, text.alias("text"))
    tests = text_filters(F.col("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    own = own.select("id", "part", digest, *(c.alias(f"fails_{k}") for k, c in tests.items()))
    rows = repeats_smaller(own)
    known = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].alias("id"))
    known = known.agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    rows = rows.join(known, "id", "left")
    bits = [*(F.col(f"fails_{k}") for k in tests), F.col("again")]
    letters = "".join(tests) + "E"
    cells = written(mask_cells(rows, bits), "cells")
    steps = prefixes(cells, letters)
    discard(cells)
    return orders(steps, letters)
