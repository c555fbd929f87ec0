"""The similarity join against all pairs of sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tonetape.llm import words as W
from tonetape.llm.components import components
from tonetape.llm.jaccard import drop_near_copies, near_groups


def plain_set(text):
    low = bytes(W.LOWER[np.frombuffer((text or "").encode(), np.uint8)]) if text else b""
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=80):
    """(id, set size, smallest id reached) of each row."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def corpus(seed, count):
    """Texts with chains of near copies at the threshold, a passage in half of them, and copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(count):
        text = [word() for _ in range(rng.randrange(0, 90))]
        if rng.random() < 0.5:
            text.insert(rng.randrange(len(text) + 1), passage)
        texts.append(" ".join(text))
        while rng.random() < 0.6:
            changed = texts[-1].split(" ")
            for _ in range(rng.randrange(0, max(2, len(changed) // 40))):
                changed[rng.randrange(len(changed))] = rng.choice([word(), "X\tY", ""])
            texts.append(" ".join(changed))
    texts += [None, "", " \n ", "One", "one", "two words", "TWO  words\n", "É é", "é É", "a b c d e", "A B C D E", "w " * 5000]
    rows = [(rng.randrange(10_000), t) for t in texts]
    return rows + rows[:3] + [(None, texts[0]), (None, "nobody else says this at all")]


@pytest.mark.parametrize("seed,percent", [(1, 80), (2, 80), (3, 60)])
def test_groups(spark, seed, percent):
    rows = corpus(seed, 45)
    docs = spark.createDataFrame([(i, t, 1, 2, "c") for i, t in rows], "doc_id long, text string, row int, n int, component string")
    got = near_groups(docs.repartition(4), percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, percent)


def test_stage_keeps_one_row_of_each_group(spark):
    rows = corpus(5, 30)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, dedup_row string").repartition(3)
    got = drop_near_copies(docs)
    assert got.columns == docs.columns
    texts = [r.text for r in got.collect()]
    groups = {c if c is not None else ("none", i) for i, (k, n, c) in enumerate(brute(rows)) if n}
    blank = sum(1 for _, t in rows if not plain_set(t))
    assert len([t for t in texts if not plain_set(t)]) == blank
    assert len(texts) == blank + len(groups)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_groups(docs).count() == 0 and drop_near_copies(docs).count() == 0


def test_shingles_in_blocks(monkeypatch):
    texts = [t for _, t in corpus(8, 20)]
    whole = W.shingle_sets(pa.array(texts))
    monkeypatch.setattr(W, "BLOCK", 50)
    assert all((a == b).all() for a, b in zip(whole, W.shingle_sets(pa.array(texts))))
    assert [len(s) for s in whole] == [len(plain_set(t)) for t in texts]


def test_components(spark):
    rng = random.Random(6)
    chain = [(i, i + 1) for i in range(60)]
    hub = [(200, 201 + i) for i in range(80)]
    links = chain + hub + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)] + [(5, 5)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    best = {x: x for l in links for x in l if l[0] != l[1]}
    for _ in range(100):
        for a, b in links:
            best[a] = best[b] = min(best.get(a, a), best.get(b, b))
    assert got == {k: v for k, v in best.items() if k in got}
    assert set(got) == {x for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_copies_send_no_shingles(spark, monkeypatch):
    from tonetape.llm import jaccard

    seen, real = [], jaccard.shared_columns

    def counting(sets, entries):
        seen.append((sets.count(), entries))
        return real(sets, entries)

    monkeypatch.setattr(jaccard, "shared_columns", counting)
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(i, text) for i in range(30)] + [(30, text + " more"), (31, "quite another text of seven words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_groups(docs).collect()}
    assert got == {i: 0 if i < 31 else 31 for i in range(32)}
    # One row of each class, not one of each copy.
    assert seen[0][0] == 3 and seen[0][1] < 60
