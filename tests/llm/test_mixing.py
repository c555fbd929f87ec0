"""Mixing: sizes and targets against a plain computation, taken words against the targets."""

import random
import re
from collections import defaultdict

import pytest

from tonetape.llm.mixing import mix, mixture


def plain_targets(total, weights=(1, 2, 3), cap=3):
    """Words of each source -> target, by sharing the excess out again and again."""
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [s for s in total if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest, open_ = {}, float(sum(total.values())), set(order)
    while open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > cap * total[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = cap * total[s]
            rest -= target[s]
        open_ -= full
    return target


def corpus(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["big"] * 9 + ["a", "Z", "é", "😀", "tiny", None])
        words = min(int(rng.paretovariate(1.1) * 8), 3000)
        rows.append((i, "w\t" * words if rng.random() < 0.97 else rng.choice(["", None, " \n", "é　x"]), source))
    return rows + [(5000, "twice or more", "a")] * 3 + [(None, "no id", "big"), (9999, "", "blank"), (9998, None, "blank")]


@pytest.mark.parametrize("seed", [1, 2])
def test_mixture(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, source string, size int, target double").repartition(5)
    got = mixture(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    of = {i: (size(t), s) for i, t, s in rows}
    total = defaultdict(int)
    for _, t, s in rows:
        total[s] += size(t)
    target = plain_targets(total)
    taken = defaultdict(int)
    for r in got:
        n, s = of[r.doc_id]
        assert (r.size, r.source_size) == (n, total[s])
        assert r.target == pytest.approx(target[s])
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
    for s, want in target.items():
        assert abs(taken[s] - want) <= max(8, 0.01 * want), s
    again = mixture(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_stage_repeats_whole_rows(spark):
    rows = corpus(3, 200)
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, source string, mix_row int")
    out = mix(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
    assert out.count() == sum(r.copies for r in mixture(docs).collect())


def test_one_source_and_none(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (2, "d", "s")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.taken) for r in mixture(docs).collect()) == [(1, 3), (2, 1)]
    assert mixture(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0
    assert [r.taken for r in mixture(spark.createDataFrame([(1, None, None)], docs.schema)).collect()] == [0]
