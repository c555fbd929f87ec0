"""Languages: against a plain naive Bayes, held-out accuracy, labels not looked at, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tonetape.llm import language, words as W
from tonetape.llm.language import BUCKETS, SMOOTH, buckets_for, grams, predict_language

DATA = "/root/testdata/sf0.01"


def plain_grams(text):
    """Grams of a text by a loop over its characters."""
    words = "".join(c.lower()[0] if c.isalpha() else " " for c in text).split()
    for w in words:
        yield from w
        framed = f" {w} "
        yield from (framed[i : i + 2] for i in range(len(framed) - 1))
        yield from (framed[i : i + 3] for i in range(len(framed) - 2))


def bucket(gram, buckets=BUCKETS):
    key = sum(ord(c) << 21 * k for k, c in enumerate(reversed(gram)))
    return int(W.mixed(np.array([key], np.uint64), 16 + len(gram))[0]) >> 64 - (buckets.bit_length() - 1)


TEXTS = ["Été à la plage, 12 fois!", "a", "", None, "...", "ß🙂日本語 Straße", "ab" * 40, " \n x\ty ", "İstanbul ŒUVRE", "A-b-c"]


@pytest.mark.parametrize("piece", [1 << 19, 7, 64])
def test_grams_equal_plain_ones_wherever_pieces_end(monkeypatch, piece):
    monkeypatch.setattr(language, "PIECE", piece)
    got = Counter()
    for doc, found in grams(pa.array(TEXTS), BUCKETS):
        got.update(zip(doc.tolist(), found.tolist()))
    want = Counter((i, bucket(g)) for i, t in enumerate(TEXTS) for g in plain_grams(t or ""))
    assert got == want


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def plain_bayes(rows):
    counts, docs, cache = {}, Counter(), {}
    hashed = lambda t: Counter(cache.setdefault(g, bucket(g)) for g in plain_grams(t or ""))
    for i, text, lang in rows:
        if i is not None and lang is not None and not held(i):
            counts.setdefault(lang, Counter()).update(hashed(text))
            docs[lang] += 1
    total = {k: sum(c.values()) + SMOOTH * BUCKETS for k, c in counts.items()}
    out = []
    for i, text, _ in rows:
        own = hashed(text)
        if not own or not docs:
            out.append((i, "und", 0.0))
            continue
        log = {k: math.log(docs[k] / sum(docs.values())) + sum(n * math.log((counts[k][b] + SMOOTH) / total[k]) for b, n in own.items()) for k in docs}
        best = min(log, key=lambda k: (-log[k], k))
        out.append((i, best, 1 / sum(math.exp(v - log[best]) for v in log.values())))
    return out


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return predict_language(docs.selectExpr("*", "1 AS id", "'x' AS held_out", "2 AS score", "3 AS `a.b`"))


def test_equals_plain_naive_bayes(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").limit(150).collect()]
    rows += [(100_000 + i, t, None) for i, t in enumerate(TEXTS)] + [(None, "le la les", "fr"), (7, "le", "xx"), (200_000, "wort " * 60_000, "de")]
    rows += rows[:5]
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, r.score) for r in run(spark, rows).collect()), key=str)
    want = sorted(((i, held(i), lang, s) for i, lang, s in plain_bayes(rows)), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = predict_language(docs).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "lang_pred", "score"]
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [held(i) for i in got.doc_id]).all()
    both = got[got.held_out].merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (both.lang_pred == both.lang).mean() > 0.99


def test_held_out_languages_are_never_looked_at(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").limit(200).collect()]
    other = [(i, t, "zz" if held(i) else lang) for i, t, lang in rows]
    assert sorted(run(spark, rows).collect()) == sorted(run(spark, other).collect())


def test_nothing_to_learn_from(spark):
    assert run(spark, []).count() == 0
    got = run(spark, [(1, "some text", None), (None, "text", "en"), (2, None, None)]).collect()
    assert sorted((r.lang_pred, r.score) for r in got) == [("und", 0.0)] * 3
    letterless = run(spark, [(1, "123", "en"), (3, "...", "fr"), (4, "word", None)]).collect()
    assert {r.doc_id: r.lang_pred for r in letterless} == {1: "und", 3: "und", 4: "en"}


def test_cells_are_bounded():
    assert buckets_for(1) == buckets_for(64) == BUCKETS
    assert buckets_for(65) == BUCKETS // 2 and buckets_for(4096) == 1024
    with pytest.raises(ValueError):
        buckets_for(4097)
