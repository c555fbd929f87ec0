"""Prefix trie: against a plain one, whatever the height of bands; odd rows; long conversations."""

import hashlib
import random
import zlib

import pytest

from tonetape.llm.trie import conversation_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(turns.get(c - c % 100, [])[:h] + own[h:])
    members, ends = {}, {}
    for c, seq in sorted(rebuilt.items()):
        ends.setdefault(seq, []).append(c)
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, who in members.items():
        gain = (len(who) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += gain
    return sorted(
        (
            who[0],
            len(node),
            members[node[:-1]][0] if node else -1,
            len(who),
            children.get(node, 0),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest(),
        )
        for node, who in members.items()
    )


def run(spark, rows, **how):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    # Columns that clash with names inside.
    turns = turns.selectExpr("*", "1 AS conv", "2 AS place", "3 AS digest", "4 AS p1", "5 AS `a.b`", "6 AS line")
    got = conversation_trie(turns, **how)
    assert got.columns == COLUMNS
    return sorted(tuple(-1 if c == "parent_conv_id" and v is None else v for c, v in zip(COLUMNS, r)) for r in got.collect())


def random_rows(seed, convs, longest):
    draw = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = draw.choice([draw.randrange(0, 12), draw.randrange(100, 130), draw.randrange(500, 520)])
        if any(r[0] == c for r in rows):
            continue
        rows += [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["yes", "no", "", None, "é😀"])) for t in range(draw.randrange(1, longest))]
    return rows


@pytest.mark.parametrize("height", [2, 3, 32])
def test_equals_plain_trie(spark, height):
    rows = random_rows(height, 40, 9)
    rows += [(700 + c, t, "user", "same") for c in range(8) for t in range(21)]
    rows += [(700 + c, 30, "user", "end") for c in range(0, 8, 3)]
    assert run(spark, rows, height=height) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (5, None, "user", "null turn first"),
        (5, 0, None, None),
        (5, 0, None, None),
        (5, 1, "assistant", "x" * 300_000),
        (5, 1, "assistant", "tie"),
        (301, 0, "user", "its family is absent, and it has one turn"),
        (302, 0, "ab", "c"),
        (302, 1, "a", "bc"),
        (300 + 7, 3, "", ""),
    ]
    assert run(spark, rows) == plain(rows)


def test_conversations_without_turns_are_members_of_the_root(spark):
    # One turn, which h of at least 1 takes away, and a family that is not there.
    ids = [c for c in range(401, 460) if zlib.crc32(str(c).encode()) % 6]
    rows = [(c, 0, "user", "gone") for c in ids]
    got = run(spark, rows)
    assert got == plain(rows) and len(got) == 1
    assert got[0][3:6] == (len(ids), 0, 1) and got[0][7] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_long_conversation_and_many_copies(spark):
    rows = [(0, t, "user", f"turn {t % 7}") for t in range(300)]
    rows += [(c, t, "user", f"turn {t % 7}") for c in range(1, 60) for t in range(12)]
    rows += [(100 * c, t, "user", "all alike") for c in range(10, 2500) for t in range(3)]
    assert run(spark, rows, height=4) == plain(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
