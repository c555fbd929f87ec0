"""Token counts and packing against the tokenizer library, token by token."""

import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tonetape.llm import bpe
from tonetape.llm.common import watched
from tonetape.llm.packing import Index, pack
from tonetape.llm.tokencount import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "",
    None,
    "Plain words, and 123 numbers! don't we'll I'D",
    "a" * 3000,
    "<|endoftext|>in the<|startoftext|> middle <|endoftext|",
    "ΑΣ ΟΔΥΣΣΕΥΣ İstanbul ſ ẞ Å Å 中文 🙂👍🏽 ٣Ⅷ ½²",
    "\x1c\x1d\x85\xa0　\x00\x07​﻿ x",
    " \n\t ",
    "word " * 9000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(library, monkeypatch):
    rng = np.random.default_rng(5)
    letters = list("aabbAB'stllve012 \n\t\xa0ÉéÀ÷×²¼ßΣςİ中🙂-_!.") + ["<|endoftext|>"]
    texts = TEXTS + ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(3000)]
    for block, chunk, known in ((bpe.BLOCK, bpe.CHUNK, bpe.KNOWN), (40, 50, 100)):
        monkeypatch.setattr(bpe, "BLOCK", block)
        monkeypatch.setattr(bpe, "CHUNK", chunk)
        monkeypatch.setattr(bpe, "KNOWN", known)
        model = bpe.Encoder(PATH)
        flat, n = model.encode(texts)
        want = [ids(library, t) for t in texts]
        assert n.tolist() == [len(w) for w in want]
        assert flat.tolist() == [i for w in want for i in w]
        assert model.counts(texts).tolist() == n.tolist()


def test_words_are_looked_up_once(monkeypatch):
    """Every word of a slice was looked up twice, and its pre-tokens three times: op3 took 408 CPU seconds a GB."""
    looks = []

    class Known(dict):
        def get(self, word, default=None):
            looks.append(word)
            return super().get(word, default)

        def __contains__(self, word):
            looks.append(word)
            return super().__contains__(word)

        def __getitem__(self, word):
            looks.append(word)
            return super().__getitem__(word)

    model = bpe.Encoder(PATH)
    model.known = Known(model.known)
    texts = ["one two, three's one\ntwo", "three four\u4e2d \u4e2d!", ""]
    first = model.encode(texts)
    assert len(looks) == len(set(looks)) > 5
    again = model.encode(texts)
    assert [a.tolist() for a in first] == [a.tolist() for a in again]
    assert len(looks) == 2 * len(set(looks))


def frame(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "x"), (None, "no id", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts(spark, library):
    got = token_counts(frame(spark), PATH).collect()
    assert got[0].__fields__ == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(r.doc_id, r.text) for r in frame(spark).collect()]
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in got] == [
        (i, len((t or "").encode()), len(ids(library, t))) for i, t in want
    ]
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts(frame(spark).limit(0), PATH).count() == 0


def check_packing(pieces, rows, library, window):
    """Every token of every row once, sequences gapless and full or of a power of two."""
    tokens = [(i, np.array([*ids(library, t), 1], "<u4")) for i, t in rows]
    left = defaultdict(list)
    for i, own in tokens:
        left[i].append(own)
    by_id, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_id[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for key, own in left.items():
        assert sum(p.length for p in by_id[key]) == sum(map(len, own))
        for p in by_id[key]:
            assert any(
                p.doc_tokens == len(o) and p.ids_crc32 == zlib.crc32(o[p.start : p.start + p.length].tobytes()) for o in own
            )
        if len(own) == 1:
            at = 0
            for p in sorted(by_id[key], key=lambda p: p.start):
                assert p.start == at and p.length > 0
                at += p.length
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or (at < window and at & (at - 1) == 0)


@pytest.mark.parametrize("window", [2048, 16, 7])
def test_packing(spark, library, window):
    docs = frame(spark).repartition(2)
    pieces = pack(docs, PATH, window=window, with_ids=True).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_packing(pieces, rows, library, window)
    assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in pieces)
    assert pack(docs.limit(0), PATH).count() == 0


def test_packing_of_the_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_packing(pack(docs, PATH).collect(), rows, library, 2048)


def test_remainders_go_to_python_inside_packing(spark):
    """The caller's write sent them 10,000 at a time, up to 80 MB: the pipeline took more than 3,000 MB of an executor."""
    docs = spark.range(0, 300, 1, 2).selectExpr("id AS doc_id", "concat(repeat('one two three ', id % 9), id) AS text")
    with watched() as tables:
        packed = pack(docs, PATH, window=64)
    plan = packed._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "Exchange" not in plan
    # What it was made from is gone, and it can still be read.
    assert [t._llm_path.rpartition("/")[2] for t in tables if t._llm_path] == ["packed"]
    assert packed.select("doc_id").distinct().count() == 300


def test_an_index_is_built_in_little_memory():
    """The pairs of its terms and documents took 80 MB for a million tokens."""
    rng = np.random.default_rng(7)
    docs = [rng.integers(0, 49_000, 1000).astype(np.int32) for _ in range(1000)]
    tracemalloc.start()
    try:
        Index(docs)
        assert tracemalloc.get_traced_memory()[1] < 50_000_000
    finally:
        tracemalloc.stop()


def test_neighbours_share_words():
    from tonetape.llm.packing import Index

    rng = np.random.default_rng(1)
    docs = [rng.integers(1000 * (k % 4), 1000 * (k % 4) + 60, 50) for k in range(40)]
    near = Index(docs).near(0, np.arange(40) != 0)
    assert sorted(near[:9]) == list(range(4, 40, 4))


def single_words(library, n):
    """n words of one token each."""
    vocab = sorted(w.removesuffix("</w>") for w in library.get_vocab() if w.removesuffix("</w>").isalpha())
    words = [w for w in dict.fromkeys(vocab) if w.isascii() and w.islower() and len(w) > 3]
    return [w for w in words[:: max(1, len(words) // (4 * n))] if len(ids(library, f"{w} {w}")) == 2][:n]


def spread(spark, texts, parts):
    """Rows (number, text) in the given order, consecutive ones in one partition."""
    rows = [(i, t) for i, t in texts]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "doc_id long, text string")


def mates(pieces):
    """Ids of each sequence."""
    out = defaultdict(set)
    for p in pieces:
        out[p.sequence_id].add(p.doc_id)
    return out


def test_neighbours_come_from_the_whole_table(spark, library):
    topics, each, words = 30, 8, single_words(library, 240)
    rng = np.random.default_rng(2)
    # One row of every topic in each of 8 partitions; 7 words and the end, so that two fill a window.
    texts = [(k * topics + t, " ".join(rng.choice(words[8 * t : 8 * t + 8], 7))) for k in range(each) for t in range(topics)]
    first = pack(spread(spark, texts, each), PATH, window=16).collect()
    check_packing(first, texts, library, 16)
    own = mates(first).values()
    assert sum(len({i % topics for i in s}) == 1 for s in own) >= 0.9 * len(own)
    # Neither order nor partitions change what meets in a window.
    rng.shuffle(texts)
    again = pack(spread(spark, [(int(i), str(t)) for i, t in texts], 3), PATH, window=16).collect()
    assert sorted(map(sorted, mates(again).values())) == sorted(map(sorted, own))
    # Shards of few rows still hold rows of the same topic.
    for shard_docs in (5, 16):
        small = pack(spread(spark, [(int(i), str(t)) for i, t in texts], 3), PATH, window=16, shard_docs=shard_docs).collect()
        check_packing(small, texts, library, 16)
        own = mates(small).values()
        assert sum(len({i % topics for i in s}) == 1 for s in own) >= 0.6 * len(own)


def test_weights_are_of_the_whole_table():
    from tonetape.llm.packing import Counts, Index

    docs = [np.array(d) for d in ([1, 2, 9], [1, 3, 3], [2, 4, 4], [9, 9, 9])]
    df = np.zeros(10, np.int64)
    df[[1, 2, 3, 4, 9]] = 400, 3, 9, 9, 900
    unused = np.arange(4) != 0
    # 2 is rare among all rows, 1 is not, 9 is in most; in the shard they are alike.
    assert Index(docs, Counts(1000, 3.0, df)).near(0, unused).tolist() == [2, 1, 3]
    assert Index(docs).near(0, unused).tolist() == [1, 2, 3]


def test_long_documents_do_not_shorten_the_index(spark, library):
    topics, words = 20, single_words(library, 160)
    rng = np.random.default_rng(3)
    # 150 whole windows, and 7 words and the end that share a topic with a row 20 places on.
    texts = [(i, " ".join([*rng.choice(words, 16 * 150), *rng.choice(words[8 * (i % topics) : 8 * (i % topics) + 8], 7)])) for i in range(2 * topics)]
    pieces = pack(spread(spark, texts, 1), PATH, window=16).collect()
    check_packing(pieces, texts, library, 16)
    own = [s for s in mates([p for p in pieces if p.length < 16]).values()]
    assert sum(len({i % topics for i in s}) == 1 for s in own) >= 0.9 * len(own)


def test_long_words(library):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), n)) for n in (63, 64, 65, 500, 20_000)]
    words += ["a" * 5001, "ab" * 3000 + "b", "-=" * 400, "é" * 301, "中" * 200, words[3] + "'s", "a" * 64 + " " + "a" * 65]
    model = bpe.Encoder(PATH)
    flat, n = model.encode([*words, " ".join(words)])
    want = [ids(library, w) for w in [*words, " ".join(words)]]
    assert n.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def test_a_word_of_a_megabyte_takes_no_step_per_letter(library, monkeypatch):
    word = "".join(np.random.default_rng(7).choice(list("abcdefghijklmnopqrstuvwxyz"), 1 << 20))
    model = bpe.Encoder(PATH)
    looked_up = []
    rank = model.rank
    monkeypatch.setattr(model, "rank", lambda a, *b: looked_up.append(len(a)) or rank(a, *b))
    assert model.encode([word])[0].tolist() == ids(library, word)
    # Every merge changes two pairs at most, and letters are no more than once merged away.
    assert sum(looked_up) < 4 * len(word)


def test_the_nearest_few_are_the_first_of_all():
    from tonetape.llm.packing import Index

    rng = np.random.default_rng(8)
    index = Index([rng.integers(0, 40, rng.integers(1, 12)) for _ in range(120)])
    unused = rng.random(120) < 0.6
    want = [index.near(seed, unused).tolist() for seed in range(120)]
    assert all(index.near(s, unused, 7).tolist() == want[s][:7] for s in range(120))
    index.drop(unused)
    assert [index.near(seed, unused).tolist() for seed in range(120)] == want


def test_counts_and_topics_of_remainders():
    from tonetape.llm.packing import DEPTH, Counts, holders, paths, topics

    rng = np.random.default_rng(9)
    docs = [rng.integers(0, 90, rng.integers(1, 30)) for _ in range(60)]
    raw = [d.astype("<u4").tobytes() for d in docs]
    df = np.zeros(0, np.int64)
    for part in (raw[:7], raw[7:], []):
        df = holders(part, df)
    assert df.tolist() == [sum(t in d for d in docs) for t in range(len(df))] and max(map(max, docs)) == len(df) - 1
    counts = Counts(60, 9.0, df)
    ranks = counts.ranks(8)
    got = paths(raw, topics(counts, ranks))
    for d, path in zip(docs, got.tolist()):
        own = sorted(int(ranks[t]) for t in set(d.tolist()) if df[t] > 1 and 2 * df[t] < 60)[:DEPTH]
        assert path == own + [-1] * (DEPTH - len(own))
