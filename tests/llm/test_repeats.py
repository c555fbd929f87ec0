"""Removal of repeated strings against a count of every window of the tables."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tonetape.llm.repeats import remove_repeats


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone[-1] = False
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, length, parts=3, **more):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(parts)
    got = {r.doc_id: r for r in remove_repeats(docs, length=length, with_kept=True, **more).collect()}
    for i, (text, want) in enumerate(zip(texts, brute(texts, length))):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, (i, text and text[:80])
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert len(r.spans or []) == 2 * r.n_spans


def passages(seed, count, size=400):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefg hé"))
    word = lambda n: "".join(rng.choice(letters, n))
    shared = [word(n) for n in (150, 199, 200, 201, 260, 700)]
    texts = []
    for _ in range(count):
        text = word(rng.integers(0, size))
        for s in rng.choice(len(shared), rng.integers(0, 3)):
            passage = shared[s]
            if rng.random() < 0.3:  # a change inside, or a cut
                at = rng.integers(0, len(passage))
                passage = passage[:at] + "#" + passage[at + 1 :] if rng.random() < 0.5 else passage[at:]
            text += passage + word(rng.integers(0, size))
        texts.append(text)
    return texts + [texts[3], texts[3], texts[5], texts[5][:-1], None, "", "short", "z" * 700, "ab" * 300, shared[5] * 3, shared[2]]


@pytest.mark.parametrize("length", [128, 200])
def test_passages(spark, length):
    check(spark, passages(length, 60), length)


def test_long_texts_in_pieces(spark):
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("abcdefgh "), 9000))
    texts = [base, "x" * 40 + base[700:8000], base[100:350] + base[5000:5300], "q" * 2500, base[:1224], "lone " + base[8800:]]
    check(spark, texts, 200, piece=700)


def test_ids_that_repeat_or_are_null(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "y" + text), (1, "other")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in remove_repeats(docs).collect())
    assert got == [(0, 301, 300, 1), (1, 5, 0, 0), (1, 300, 300, 1), (1, 300, 300, 1)]
    assert remove_repeats(docs.limit(0)).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(docs).collect()}
    assert got == {i: w for (i, _), w in zip(rows, brute([t for _, t in rows], 200))}
