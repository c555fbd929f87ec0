"""Exact copies against a dictionary of texts."""

import hashlib
import random
from collections import defaultdict

import pytest

from tonetape.llm.copies import copy_groups, drop_copies


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = max if keep == "largest" else min
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        top = best(ids) if ids else None
        out.append((i, top, len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def cases():
    rng = random.Random(4)
    texts = ["", None, "a", "a ", "A", "é", "é", "x" * 200_000, "x" * 199_999, "hot"]
    rows = [(rng.randrange(500), rng.choice(texts)) for _ in range(300)]
    rows += [(7, "twice"), (7, "twice"), (None, "twice"), (None, "nobody"), (None, "nobody"), (3, "once")]
    return rows + [(1000 + i, "hot") for i in range(200)]


@pytest.mark.parametrize("keep,runs,fan_in", [("largest", 64, 4), ("smallest", 7, 2), ("largest", 1, 2)])
def test_groups(spark, keep, runs, fan_in):
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in cases()], "doc_id long, text string, digest int, row string").repartition(5)
    got = copy_groups(docs, keep=keep, runs=runs, fan_in=fan_in)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    found = got.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == brute(cases(), keep)
    kept = [r.text_sha256 for r in found if r.kept]
    assert len(kept) == len(set(kept)) == len({t or "" for _, t in cases()})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_stage_keeps_one_whole_row_of_each_text(spark):
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(cases())], "doc_id long, text string, dedup_row int").repartition(4)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    rows, all_rows = got.collect(), {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in rows} <= all_rows
    assert sorted(r.text or "" for r in rows) == sorted({t or "" for _, t in cases()})


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert copy_groups(docs).count() == 0 and drop_copies(docs).count() == 0


def test_no_python_in_the_plan(spark):
    plan = copy_groups(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
