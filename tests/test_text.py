"""Text expressions against plain Python on hand-made and random texts."""

import random
import re
from bisect import bisect_right
from itertools import accumulate, pairwise

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tonetape.functions import text as tx
from tonetape.operators import sentiment as se
from tonetape.schema import NEGATIVE_WORDS, POSITIVE_WORDS


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"text {kind}").select(expression.alias("x")).first()["x"]


def on_texts(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r["x"] for r in df.select("id", expression.alias("x")).orderBy("id").collect()]


def test_header_date(spark):
    texts = [
        "<SEC-DOCUMENT>1.txt : 20210415\nbody",
        "  <SEC-DOCUMENT>1.txt : 20210415 \t\nbody : 20221111",
        "no date\n : 20210415",
        "x : 2021041\n",
        "x : 20211301",
        "",
    ]
    got = on_texts(spark, texts, tx.header_date("text"))
    assert [tuple(g) if g else None for g in got] == [(2021, 4), (2021, 4), None, None, (2021, 13), None]


def plain_date(text):
    """The rule as a search over candidate (line, pattern) pairs in order of rank."""
    head = [x.strip() for x in text.split("\n")][:30]
    under = [b for a, b in pairwise(head) if re.search("FILING-DATE|ACCEPTANCE-DATETIME", a)]
    compact = [r": (\d{4})(\d\d)\d\d$", r"(\d{4})(\d\d)\d\d"]
    ranked = [re.search(compact[0], x) for x in head] + [re.search(compact[1], x) for x in under]
    slashed = [re.search(r"(\d{1,2})[/-]\d{1,2}[/-](\d{4})", x) for x in head]
    found = [(int(f[1]), int(f[2])) for f in ranked if f] + [(int(f[2]), int(f[1])) for f in slashed if f]
    return found[0] if found else None


def test_filing_date_forms(spark):
    texts = [
        "<FILING-DATE>\n20210415120000",
        "FILING-DATE 20210415",
        "FILING-DATE\nnone\n20210415",
        "ACCEPTANCE-DATETIME\nx\nFILING-DATE\n on 20220203 x",
        "filed 4/15/2021",
        "filed 04-15-2021 or 5/6/2022",
        "a 3/4/2020\nb\n <FILING-DATE>\n20210415",
        "a 3/4/2020\n<FILING-DATE>\n20210415\nhead : 20230101",
        "\n" * 29 + "x : 20230101",
        "\n" * 30 + "x : 20230101",
        "nothing",
        "",
    ]
    got = [tuple(g) if g else None for g in on_texts(spark, texts, tx.filing_date("text"))]
    assert got == [plain_date(t) for t in texts]
    assert got[1] is None and got[0] == (2021, 4) and got[9] is None


def test_filing_date_random(spark):
    rng = random.Random(1)
    bits = ["x : 20210415", "FILING-DATE", "20220715", "1/2/2023", "12-30-2024", "text", "", "ACCEPTANCE-DATETIME 1/5/2020"]
    texts = ["\n".join(rng.choice(bits[1:] if rng.random() < 0.8 else bits) for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    got = [tuple(g) if g else None for g in on_texts(spark, texts, tx.filing_date("text"))]
    assert got == [plain_date(t) for t in texts]


def test_quarter_of(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    assert [r[0] for r in df.select(tx.quarter_of("m")).collect()] == [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3


def test_month_range_drops_impossible_months(spark):
    df = spark.createDataFrame([(2021, 13), (2021, 0), (2021, 1), (2020, 12), (2024, 12), (2025, 1), (None, 1)], "y int, m int")
    got = [r[0] for r in df.select(tx.in_month_range("y", "m", "2021-01-01", "2024-12-31")).collect()]
    assert got == [False, False, True, False, True, False, False]


def test_hits_are_substrings(spark):
    text = "again gain downdown"
    assert one(spark, text, tx.lexicon_hits("text", ["gain"])) == 2
    assert one(spark, text, tx.lexicon_hits("text", ["down"])) == 2
    assert one(spark, "aaaa AAA", tx.lexicon_hits("text", ["aa"])) == 3


def test_hits_random(spark):
    rng = random.Random(2)
    words = [*POSITIVE_WORDS, *NEGATIVE_WORDS, "successuccess", "Ünder", "x", " ", "\n"]
    texts = ["".join(rng.choice([w, w.upper()]) for w in rng.choices(words, k=60)) for _ in range(50)]
    got = on_texts(spark, texts, tx.lexicon_hits("text", POSITIVE_WORDS))
    assert got == [sum(t.lower().count(w) for w in POSITIVE_WORDS) for t in texts]


def test_score_and_category(spark):
    df = spark.createDataFrame([(0, 0), (3, 1), (0, 2)], "p long, n long")
    assert [r[0] for r in df.select(tx.sentiment_score("p", "n")).collect()] == [0.0, 0.5, -1.0]
    df = spark.createDataFrame([(0.1,), (-0.1,), (0.11,), (-0.11,), (0.0,)], "s double")
    got = [r[0] for r in df.select(tx.sentiment_category("s")).collect()]
    assert got == ["neutral", "neutral", "positive", "negative", "neutral"]


def test_paragraphs(spark):
    assert one(spark, "a\n\n\n b\n \nc", tx.paragraphs("text")) == ["a", "b", "c"]
    assert one(spark, " \n\n ", tx.paragraphs("text")) == []


def test_sample_sizes_and_members(spark):
    texts = ["\n\n".join(f"p{i}" for i in range(n)) for n in (1, 5, 10, 29, 30, 100)] + [" \n\n "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["s"] for r in df.select("id", tx.sampled_text("text", "id").alias("s")).collect()}
    for i, t in enumerate(texts[:-1]):
        have, all_ = got[i].split("\n\n"), t.split("\n\n")
        assert len(have) == max(1, int(len(all_) * 0.1))
        assert len(set(have)) == len(have) and set(have) <= set(all_)
    assert got[6] == " \n\n "
    again = {r["id"]: r["s"] for r in df.repartition(5).select("id", tx.sampled_text("text", "id").alias("s")).collect()}
    assert got == again
    other = {r["id"]: r["s"] for r in df.select("id", tx.sampled_text("text", "id", seed=1).alias("s")).collect()}
    assert got != other


def plain_chunks(text, most=1000):
    """Chunk ends looked up in the running cost."""
    words = text.split()
    run = list(accumulate(len(w) // 4 + 1 for w in words))
    out = [""] if run and run[0] > most else []
    at = 0
    while at < len(words):
        before = run[at - 1] if at else 0
        end = max(at + 1, bisect_right(run, before + most))
        out.append(" ".join(words[at:end]))
        at = end
    return out


def test_chunks(spark):
    rng = random.Random(3)
    texts = [" ".join("w" * rng.randrange(1, 30) for _ in range(n)) for n in (0, 1, 10, 400, 3000)]
    texts += ["x" * 5000 + " a b", "a " + "x" * 5000 + " b", " \n a\t b  c\n", "x" * 3999, "x" * 4000]
    got = on_texts(spark, texts, tx.chunk_words("text"))
    assert got == [plain_chunks(t) for t in texts]
    assert got[5][0] == "" and got[0] == []


@pytest.mark.parametrize("most", [1, 3, 10])
def test_chunks_small_limits(spark, most):
    rng = random.Random(most)
    texts = [" ".join("w" * rng.randrange(1, 60) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    assert on_texts(spark, texts, tx.chunk_words("text", most)) == [plain_chunks(t, most) for t in texts]


def test_pieces(spark):
    texts = ["b" * 5000, "word " * 1001, "short text", "é😀" * 300, "  ", ""]
    got = on_texts(spark, texts, tx.pieces("text"))
    windows = lambda c: [c[i : i + 512] for i in range(0, len(c), 512)]
    assert got == [[w for c in plain_chunks(t) for w in windows(c) if w.strip()] for t in texts]
    assert all("".join(g).replace(" ", "") == "".join(t.split()) for g, t in zip(got, texts))


def test_every_word_counts(spark):
    """A word past any prefix changes the score, and sampling is asked for."""
    from tonetape.operators.sentiment import companies_dim, document_sentiment

    calm = "x : 20210415\n" + "plain " * 400
    texts = [calm, calm + "profit", calm + "loss"]
    data = [("AAPL", str(i), "p", t) for i, t in enumerate(texts)]
    filings = spark.createDataFrame(data, "ticker string, filing_id string, path string, text string")
    got = {r.filing_id: r.sentiment_score for r in document_sentiment(filings, companies_dim(spark)).collect()}
    assert got["0"] == 0 and got["1"] > 0 > got["2"]


def test_blank_lines_of_any_space(spark):
    text = "one\n\xa0\x1c\ntwo\n\u3000\nthree\n \t\n\nfour"
    assert on_texts(spark, [text], tx.paragraphs("text")) == [["one", "two", "three", "four"]]


def test_signed_score(spark):
    labels = ["POSITIVE", "positive", "2", "LABEL_2", "NEGATIVE", "negative", "0", "LABEL_0", "LABEL_1", "?"]
    df = spark.createDataFrame([(x, 0.75) for x in labels], "l string, s double")
    got = [tuple(r[0]) for r in df.select(tx.signed_score("l", "s")).collect()]
    assert got == [(0.75, "positive")] * 4 + [(-0.75, "negative")] * 4 + [(0.0, "neutral")] * 2


SCORED = "id int, pos int, label string, score double"


def test_pooling_tie_goes_to_first_seen(spark):
    data = [
        (1, 0, "negative", 0.5), (1, 1, "positive", 0.25),
        (2, 0, "positive", 0.5), (2, 1, "negative", 0.5), (2, 2, "negative", 0.5), (2, 3, "positive", 0.5),
        (3, 0, "neutral", 0.9), (3, 1, "positive", 0.6), (3, 2, "positive", 0.6),
        (4, 0, None, None),
        (5, 0, None, None), (5, 1, "negative", 0.4),
    ]
    df = spark.createDataFrame(data, SCORED)
    got = {r[0]: (round(r[1], 9), r[2]) for r in se.aggregate_pieces(df, ["id"]).collect()}
    assert got == {1: (-0.125, "negative"), 2: (0.0, "positive"), 3: (0.4, "positive"), 4: (0.0, "neutral"), 5: (-0.4, "negative")}


def test_column_pooling_equals_row_pooling(spark):
    rng = random.Random(5)
    data = [(i, p, rng.choice(["positive", "negative", "x"]), rng.random()) for i in range(40) for p in range(rng.randrange(1, 9))]
    df = spark.createDataFrame(data, SCORED)
    by_row = {r[0]: (round(r[1], 9), r[2]) for r in se.aggregate_pieces(df, ["id"]).collect()}
    arrays = df.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "label", "score"))).alias("a"))
    pooled = arrays.select("id", tx.pooled_score(F.transform("a", lambda x: tx.signed_score(x["label"], x["score"]))).alias("p"))
    by_column = {r[0]: (round(r[1], 9), r[2]) for r in pooled.select("id", "p.score", "p.sentiment").collect()}
    assert by_row == by_column
    empty = spark.range(1).select(tx.pooled_score(F.expr("cast(array() as array<struct<score:double,sentiment:string>>)")).alias("p"))
    assert tuple(empty.first()["p"]) == (0.0, "neutral")


def filings(spark, texts):
    return spark.createDataFrame(
        [(t, f"{i:03}", f"{t}/8-K/{i:03}/a.txt", x) for i, (t, x) in enumerate(texts)],
        "ticker string, filing_id string, path string, text string",
    )


def test_keyword_job(spark):
    df = filings(spark, [
        ("AAPL", "<SEC-DOCUMENT>1.txt : 20210415\nRevenue increase and growth, again."),
        ("AAPL", "<SEC-DOCUMENT>1.txt : 20201231\nincrease"),
        ("AAPL", "<SEC-DOCUMENT>1.txt : 20211301\nincrease"),
        ("AAPL", "no date\nincrease"),
        ("MSFT", "<SEC-DOCUMENT>1.txt : 20241201\nloss and decline; profit"),
        ("MSFT", "<SEC-DOCUMENT>1.txt : 20220701\nnothing here"),
        ("ZZZ", "<SEC-DOCUMENT>1.txt : 20220701\nincrease"),
    ])
    out = se.keyword_sentiment(df, se.companies_dim(spark))
    got = rows(out, "filing_id", "company", "year", "quarter", "positive_count", "negative_count", "sentiment")
    assert got == [
        ("000", "Apple Inc.", 2021, 2, 3, 0, "positive"),
        ("004", "Microsoft Corporation", 2024, 4, 1, 2, "negative"),
        ("005", "Microsoft Corporation", 2022, 3, 0, 0, "neutral"),
    ]
    assert [round(r[0], 6) for r in out.orderBy("filing_id").select("sentiment_score").collect()] == [1.0, -0.333333, 0.0]


def model():
    def load():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise ValueError("cannot score")
            return [("LABEL_2", 0.9) if "good" in t else ("LABEL_0", 0.8) for t in texts]

        return predict

    return se.loads_model(load)


def test_model_scorer_batches_and_failures(spark):
    df = spark.createDataFrame([(0, "good"), (1, "bad"), (2, "boom"), (3, None), (4, "good bad")], "id int, piece string").coalesce(1)
    got = rows(se.with_scorer(df, model(), batch=2), "id", "label", "score")
    assert got == [(0, "LABEL_2", 0.9), (1, "LABEL_0", 0.8), (2, None, None), (3, None, None), (4, "LABEL_2", 0.9)]


def test_document_job_with_model(spark):
    head = "x : 20210415\n\n"
    df = filings(spark, [("AAPL", head + "good"), ("AAPL", head + "boom"), ("MSFT", head + "bad " * 3000), ("MSFT", "none")])
    out = se.document_sentiment(df, se.companies_dim(spark), model(), rate=1.0)
    got = [(i, round(s, 6), k) for i, s, k in rows(out, "filing_id", "sentiment_score", "sentiment")]
    assert got == [("000", 0.9, "positive"), ("001", 0.0, "neutral"), ("002", -0.8, "negative")]
    assert rows(out, "filing_id", "year", "quarter")[0] == ("000", 2021, 2)


def test_document_job_column_equals_model(spark):
    rng = random.Random(7)
    words = ["growth", "loss", "plain", "decline", "gain"]
    texts = [("AAPL", "x : 20220101\n\n" + "\n\n".join(" ".join(rng.choices(words, k=rng.randrange(1, 800))) for _ in range(30))) for _ in range(12)]
    df = filings(spark, texts)

    def load():
        up, down = list(POSITIVE_WORDS), list(NEGATIVE_WORDS)

        def predict(pieces):
            out = []
            for t in pieces:
                p, n = (sum(t.lower().count(w) for w in ws) for ws in (up, down))
                s = (p - n) / (p + n) if p + n else 0.0
                out.append(("positive" if s > 0.1 else "negative" if s < -0.1 else "neutral", abs(s)))
            return out

        return predict

    dim = se.companies_dim(spark)
    a = se.document_sentiment(df, dim, rate=0.5)
    b = se.document_sentiment(df, dim, se.loads_model(load), rate=0.5)
    cut = lambda d: [(i, round(s, 9), k) for i, s, k in rows(d, "filing_id", "sentiment_score", "sentiment")]
    assert cut(a) == cut(b)


def test_summaries(spark):
    df = spark.createDataFrame([("A", "positive", 0.5), ("A", "neutral", 0.0), ("B", "positive", 1.0)], "ticker string, sentiment string, sentiment_score double")
    kinds, means, total = se.sentiment_summary(df)
    assert rows(kinds) == [("neutral", 1), ("positive", 2)]
    assert rows(means) == [("A", 0.25), ("B", 1.0)]
    assert total.first()["n"] == 3


def test_texts_are_cut_in_bounded_slices(spark):
    """A batch of any size is turned into strings a slice at a time; missing and long texts included."""
    texts = ["a b", None, "c" * 50, "", "d e f", None] * 30
    found = list(tx.slices_of(pa.array(texts), 40))
    assert [t for s in found for t in s.to_pylist()] == texts
    assert all(len(s) == 1 or sum(len(t or "") for t in s.to_pylist()) <= 40 for s in found)
    assert len(found) > 50 and list(tx.slices_of(pa.array([], pa.string()))) == []
    long = ["w" * 300 + f" {i} " * 200 for i in range(2000)]
    df = spark.createDataFrame(list(enumerate(long)), "i int, t string").coalesce(1)
    got = dict(df.select("i", tx.pieces("t")).collect())
    assert all("".join(got[i]).replace(" ", "") == t.replace(" ", "") for i, t in enumerate(long))
