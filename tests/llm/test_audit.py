"""Filter audit: against a loop over orders and rows, odd rows, many parts."""

from itertools import permutations

import pytest

from tonetape.llm.audit import STEP, filter_audit

LONG = " ".join(f"w{i}" for i in range(120))
ROWS = [
    (1, LONG, "en", 0),
    (2, LONG, "de", 1),
    (2, LONG, "de", 1),
    (3, "short text", "en", 0),
    (4, "SHORT $ a a a a", None, 0),
    (5, None, "", 0),
    (6, "", "en", 0),
    (7, " \n\t ", "en", 0),
    (None, LONG, "en", 0),
    (0, LONG + "!", "fr", 0),
    (9, ("a " * 150_000) + "#", "en", 0),
    (10, "A" * 50 + "é" * 451, "fr", 0),
    (11, "A" * 50 + "😀" * 450, "fr", 0),
    (12, "x y " * 120, "fr", 0),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, None, 1), (3, None, None), (4, 1, 1), (9, 1, 0), (None, 1, 1), (6, 0, 0), (6, 1, 0)]


def masks(rows):
    """Failures of each row by a plain reading of the five conditions."""
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, part, *_ in rows:
        t = t or ""
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in t).split(" ") if w]
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t):
            fails.add("C")
        if set(t) & set("#$%&*|"):
            fails.add("D")
        if i is not None and i > first[t]:
            fails.add("E")
        yield i, part or "", fails


def plain(rows, labels):
    """Every order applied to every row, one after the other."""
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    out = {}
    parts = {}
    for i, part, fails in masks(rows):
        parts.setdefault(part, []).append((i, fails))
    for part, members in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(members)
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                failing = [m for m in members if f in m[1]]
                left = [m for m in left if f not in m[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    len(failing) - len(gone),
                    sum(m[1] == {f} for m in members),
                    sum(m[0] in good for m in gone),
                    sum(m[0] in toxic for m in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def table(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n long")
    # Columns that clash with names inside.
    docs = docs.selectExpr("*", "1 AS mask", "2 AS id", "'x' AS part", "3 AS digest", "4 AS `a.b`")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text")
    return docs, labels


def as_dict(df):
    got = [r.asDict() for r in df.collect()]
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (*STEP, "shapley")] for r in got}
    assert len(out) == len(got)
    return out


def test_equals_plain_loops(spark):
    got = filter_audit(*table(spark, ROWS, LABELS))
    assert got.columns == ["part", "filter_order", "step", *STEP, "shapley"]
    want = plain(ROWS, LABELS)
    assert len(want) == 600 * 4
    assert as_dict(got) == want


def test_row_limit_of_recursions_is_put_back_and_does_not_cap_parts(spark):
    limit = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(limit, "500")
    try:
        rows = [(i, f"text {i}", f"lang{i % 7}", 0) for i in range(70)]
        assert as_dict(filter_audit(*table(spark, rows, []))) == plain(rows, [])
        assert spark.conf.get(limit) == "500"
    finally:
        spark.conf.unset(limit)


@pytest.mark.parametrize("labels", [[], LABELS])
def test_empty(spark, labels):
    assert filter_audit(*table(spark, [], labels)).count() == 0


def test_one_text_on_most_rows(spark):
    rows = [(i, LONG if i % 3 else f"{LONG} {i}", "en", 0) for i in range(3000)]
    assert as_dict(filter_audit(*table(spark, rows, LABELS))) == plain(rows, LABELS)
