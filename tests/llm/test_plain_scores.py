"""The scorers recomputed by plain loops: statistics, features, ridge fit and calibration."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tonetape.llm import quality as Q
from tonetape.llm import toxicity as X
from tonetape.llm.calibration import ORDER, calibrated

SPACES = rb"[^\x20\x09-\x0D]+"
MARKS = set(range(33, 48)) | set(range(58, 65)) | set(range(91, 97)) | set(range(123, 127))
DIGITS, CAPITALS = set(range(48, 58)), set(range(65, 91))
ODD = [
    "", "Some words. More words!", "a|b | c %%% 12", "x x X x y", "\n\n", "é" * 50, "Élan, vital!!! ...",
    "You are an 1d1ot!! you", "A calm sentence about trash cans and you", "STUPID STUPID you", "sooooo calm", "sh!t fool$ fool ÉTÉ a1b",
    "vous êtes un CRÉTIN, toi", "loser far " + "and " * 9 + "you",
]


def texts_of(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").toPandas()
    return ODD + [t for t in docs.text if t is not None]


def plain_statistics(text):
    raw = text.encode()
    words = re.findall(SPACES, raw)
    n, size = len(words), max(len(raw), 1)
    count = Counter(bytes(w).lower() for w in words)
    marks = [sum(c in MARKS for c in w) for w in words]
    share = lambda hits: sum(hits) / max(n, 1)
    of_bytes = lambda wanted: sum(c in wanted for c in raw) / size
    mean = share(map(len, words))
    lines = raw.count(b"\n") + 1
    closing = [w[-1:] in (b".", b"!", b"?") for w in words]
    return [
        math.log1p(n),
        math.log1p(size if n else 0),
        mean,
        math.sqrt(max(share(len(w) ** 2 for w in words) - mean**2, 0)),
        len(count) / max(n, 1),
        sum(c == 1 for c in count.values()) / max(n, 1),
        max(count.values(), default=0) / max(n, 1),
        share(a.lower() == b.lower() for a, b in zip(words, words[1:])),
        share(all(c in MARKS | DIGITS for c in w) for w in words),
        share(m >= 2 for m in marks),
        share(m >= 3 for m in marks),
        share(m > 0 and not c for m, c in zip(marks, closing)),
        share(any(c in DIGITS for c in w) for w in words),
        share(closing),
        share(w[0] in CAPITALS or w[0] == 0xC3 for w in words),
        share(len(w) > 20 for w in words),
        share(len(w) <= 2 for w in words),
        of_bytes(MARKS),
        of_bytes(DIGITS),
        of_bytes(CAPITALS),
        of_bytes(range(128, 256)),
        of_bytes(b"|"),
        of_bytes(b"#$%&*@~^<>{}[]\\_="),
        lines / max(n, 1) if n else 0,
        math.log1p(n / lines),
        of_bytes(range(32)),
    ]


def test_statistics_by_loops(spark):
    texts = texts_of(spark)
    assert np.allclose(Q.statistics(pa.array(texts)), [plain_statistics(t) for t in texts], atol=1e-9)


def isotonic(raw, label):
    """Pooled adjacent violators, linear between the ends of pools."""
    pools = []
    for x in sorted(set(raw)):
        own = [y for r, y in zip(raw, label) if r == x]
        pools.append([x, x, sum(own), len(own)])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, hi, s, n = pools.pop()
            pools[-1] = [pools[-1][0], hi, pools[-1][2] + s, pools[-1][3] + n]
    xs = [x for lo, hi, _, _ in pools for x in (lo, hi)]
    ys = [s / n for _, _, s, n in pools for _ in range(2)]
    return lambda x: float(np.interp(x, xs, ys))


@pytest.mark.parametrize("distinct", [1, 4, 300])
def test_calibration_by_pools(spark, distinct):
    rng = np.random.default_rng(distinct)
    raw = rng.integers(0, distinct, 600) / max(distinct - 1, 1)
    label = (rng.random(600) < 0.2 + 0.6 * raw).astype(int)
    train = spark.createDataFrame(list(zip(raw.tolist(), label.tolist())), "raw double, label int")
    asked = spark.createDataFrame([(i, i / 97) for i in range(98)], "id int, raw double")
    fit = isotonic(raw.tolist(), label.tolist())
    for r in calibrated(asked, train).collect():
        assert r["score"] == pytest.approx((1 - ORDER) * fit(r["raw"]) + ORDER * r["raw"], abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.5)


def test_quality_by_plain_ridge(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["doc_id"]: r["score"] for r in Q.quality(docs, labels).collect()}
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    deal = docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(5)).alias("p"))
    fifth = {r["doc_id"]: r["p"] for r in deal.collect()}
    x = {i: np.array(plain_statistics(t)) for i, t in text.items()}
    fit_on = sorted(i for i in known if i in x and fifth[i] > 0)
    rest = sorted(i for i in known if i in x and fifth[i] == 0)
    mean = np.mean([x[i] for i in fit_on], axis=0)
    sd = np.std([x[i] for i in fit_on], axis=0)
    scale = np.where(sd > 1e-9, sd, 1.0)
    w, b = Q.waves(Q.WAVES, Q.STATISTICS)

    def z(i):
        return [*(math.sqrt(2 / Q.WAVES) * np.cos(np.clip((x[i] - mean) / scale, -8, 8) @ w + b)), 1.0]

    # The ridge penalty as rows of their own: least squares without normal equations.
    n = len(fit_on)
    a = np.vstack([[z(i) for i in fit_on], math.sqrt(Q.RIDGE * n) * np.eye(Q.WAVES + 1)])
    y = np.append([known[i] for i in fit_on], np.zeros(Q.WAVES + 1))
    weight = np.linalg.lstsq(a, y, rcond=None)[0]
    raw = {i: 1 / (1 + math.exp(-4 * (float(np.dot(z(i), weight)) - 0.5))) for i in x}
    fit = isotonic([raw[i] for i in rest], [known[i] for i in rest])
    assert len(got) == len(x)
    for i in x:
        assert got[i] == pytest.approx((1 - ORDER) * fit(raw[i]) + ORDER * raw[i], abs=1e-4)


LEARNT = {"calm": 0.5, "the": 0.25, "le": 1.5, "crétin": 2.0}


def plain_features(text):
    low_text = "".join(c.lower() if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text)
    raw, low = text.encode(), low_text.encode()
    letter = lambda c: 97 <= c <= 122 or c >= 128
    runs = [w.decode() for w in re.findall(rb"[a-z\x80-\xff]+", low)]
    words = re.findall(SPACES, raw)
    n, size = len(runs), max(len(raw), 1)
    insult, you = [w in X.INSULTS for w in runs], [w in X.YOU for w in runs]
    weight = [LEARNT.get(w, 0.0) for w in runs]
    near = lambda hits: sum(
        h and any(you[max(i - X.NEAR, 0) : i + X.NEAR + 1]) for i, h in enumerate(hits)
    )
    read = bytearray(low)
    for i, c in enumerate(low):
        follows = i + 1 < len(low) and (letter(low[i + 1]) or low[i + 1] in DIGITS)
        if chr(c) in X.DISGUISE and (c in DIGITS or follows):
            read[i] = ord(X.DISGUISE[chr(c)])
    hidden = [m for m in re.finditer(rb"[a-z\x80-\xff]+", bytes(read)) if read[m.start() : m.end()] != low[m.start() : m.end()]]
    sign = lambda c: c in MARKS | DIGITS
    lows = re.findall(SPACES, low)
    mixed = [any(map(letter, b)) and any(map(sign, a[1:-1])) for a, b in zip(words, lows)]
    share = lambda k: k / max(n, 1)
    return [
        math.log1p(n),
        share(sum(insult)),
        any(insult),
        share(sum(x > 0 for x in weight)),
        share(sum(weight)),
        max(weight, default=0),
        share(sum(you)),
        share(near(insult)),
        share(near([x > 0 for x in weight])),
        sum(c in CAPITALS for c in raw) / size,
        share(sum(len(w) >= 3 and all(c in CAPITALS for c in w) for w in words)),
        sum(c in MARKS for c in raw) / size,
        raw.count(b"!") / size,
        raw.count(b"?") / size,
        share(sum(m.group().decode(errors="replace") in X.INSULTS for m in hidden)),
        share(sum(mixed)),
        sum(letter(c) and a == b == c for a, b, c in zip(low, low[1:], low[2:])) / size,
        sum(c in DIGITS for c in raw) / size,
    ]


def test_features_by_loops(spark):
    texts = texts_of(spark)
    table = X.hashes(list(LEARNT))
    weight = np.zeros(len(table))
    for word, x in LEARNT.items():
        weight[X.member(X.hashes([word]), table)] = x
    got = X.features(pa.array(texts), table, weight, X.hashes(X.INSULTS), X.hashes(X.YOU))
    for text, row in zip(texts, got):
        assert dict(zip(X.FEATURES, row)) == pytest.approx(dict(zip(X.FEATURES, map(float, plain_features(text)))), abs=1e-9), text
