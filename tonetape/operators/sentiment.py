"""Tone of filings: lexicon job, pluggable scorer job, summaries."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetape.functions.text import (
    BLANK_LINE,
    filing_date,
    header_date,
    in_month_range,
    let,
    lexicon_hits,
    lexicon_label,
    pieces,
    pooled_score,
    quarter_of,
    sampled_text,
    sentiment_category,
    sentiment_score,
    signed_score,
)
from tonetape.operators.lexicon import lexicon_counts
from tonetape.schema import COMPANIES, END_DATE, NEGATIVE_WORDS, POSITIVE_WORDS, START_DATE

#: Words up to which a search per word is quicker than an automaton (measured: 4 words
#: 1.6 s against 2.3, 24 words 5.6 against 2.1, over 10,000 filings).
FEW_WORDS = 8


def companies_dim(spark, pairs=None) -> DataFrame:
    """Ticker -> company from a mapping, the fixed list by default."""
    pairs = COMPANIES if pairs is None else pairs
    return spark.createDataFrame(list(dict(pairs).items()), "ticker string, company string")


def dated_filings(filings: DataFrame, found: Column, start: str, end: str) -> DataFrame:
    """Filings whose month lies in range, with year and quarter.

    The date is bound once for the filter, which the optimizer would otherwise
    copy into every comparison.
    """
    return (
        filings.where(let(found, lambda m: in_month_range(m["year"], m["month"], start, end)))
        .withColumn("_ym", found)
        .withColumn("year", F.col("_ym.year"))
        .withColumn("quarter", quarter_of(F.col("_ym.month")))
        .drop("_ym")
    )


def keyword_sentiment(
    filings: DataFrame,
    companies: DataFrame,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    start: str = START_DATE,
    end: str = END_DATE,
    one_pass: bool | None = None,
) -> DataFrame:
    """Lexicon tone per filing, in one pass over the text and no shuffle of it.

    Company names are joined to the narrow scored rows, never to the texts.
    `one_pass` counts all words by an automaton instead of a search per word; unless
    told, it does for more than FEW_WORDS words.  The counts are the same.
    """
    if one_pass is None:
        one_pass = len(positive) + len(negative) > FEW_WORDS
    if one_pass:
        both = lexicon_counts("text", {"positive": positive, "negative": negative})
        hits = {"_hits": both}
        counts = {f"{n}_count": F.col(f"_hits.{n}") for n in ("positive", "negative")}
    else:
        hits = {}
        counts = {
            "positive_count": lexicon_hits("text", positive),
            "negative_count": lexicon_hits("text", negative),
        }
    score = sentiment_score("positive_count", "negative_count")
    return (
        dated_filings(filings, header_date("text"), start, end)
        .withColumns(hits)
        .withColumns(counts)
        .withColumn("sentiment_score", score)
        .drop("text")
        .join(companies, "ticker")
        .select(
            "ticker",
            "company",
            "year",
            "quarter",
            "sentiment_score",
            "positive_count",
            "negative_count",
            sentiment_category("sentiment_score").alias("sentiment"),
            F.col("path").alias("filing_path"),
            "filing_id",
        )
    )


def score_pieces(
    df: DataFrame, key: Sequence[str], text: str = "text", cut: int = 512
) -> DataFrame:
    """One row per piece a scorer is to see: key, pos, piece."""
    return df.select(*key, F.posexplode(pieces(text, cut)).alias("pos", "piece"))


def with_scorer(df: DataFrame, scorer, piece: str = "piece", batch: int = 16) -> DataFrame:
    """Add `label` and `score` from a scorer, and `failure` from a Python model.

    A scorer is either a Column function (piece -> struct(label, score)), which
    stays in the JVM, or a `load` function for `model_scorer`.
    """
    if _is_column(scorer):
        scored, fields = scorer(F.col(piece)), ("label", "score")
    else:
        scored, fields = model_scorer(scorer, batch)(F.col(piece)), ("label", "score", "failure")
    out = df.withColumn("_s", scored)
    return out.select("*", *[F.col(f"_s.{f}").alias(f) for f in fields]).drop("_s")


def _is_column(scorer) -> bool:
    return not getattr(scorer, "loads_model", False)


def loads_model(load: Callable) -> Callable:
    """Mark a function that loads a model and returns list[str] -> list[(label, score)]."""
    load.loads_model = True
    return load


def model_scorer(load: Callable, batch: int = 16):
    """Column function that scores pieces with a Python model, loaded once per task.

    Pieces go through in Arrow batches and to the model `batch` at a time.  When
    a batch fails, or gives another number of results than it got pieces, its
    pieces are tried one by one.  A missing piece has no label and no score; one
    that fails alone has its error in `failure` besides.  Pooling leaves both out,
    so count the failures before trusting the pooled scores.
    """
    def run(frames):
        import pandas as pd

        model = load()

        def several(part):
            got = [tuple(x) for x in model(part)]
            if len(got) != len(part):
                raise ValueError(f"{len(got)} results for {len(part)} pieces")
            return [(label, score, None) for label, score in got]

        def one(text):
            try:
                return several([text])[0]
            except Exception as e:
                return (None, None, f"{type(e).__name__}: {e}"[:200])

        for texts in frames:
            out = []
            given = texts[texts.notna()]
            for at in range(0, len(given), batch):
                part = given.iloc[at : at + batch].tolist()
                try:
                    out += several(part)
                except Exception:
                    out += [one(t) for t in part]
            frame = pd.DataFrame(out, columns=["label", "score", "failure"], index=given.index)
            yield frame.reindex(texts.index)

    def apply(column):
        from collections.abc import Iterator

        import pandas as pd

        run.__annotations__ = {"frames": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
        return F.pandas_udf(run, "label string, score double, failure string")(column)

    return apply


def aggregate_pieces(scored: DataFrame, key: Sequence[str], pos: str = "pos") -> DataFrame:
    """Per document: mean of the signed piece scores, and the most common class.

    Equal counts go to the class met first; a document without a scored piece is
    (0, neutral).  Both steps combine before they shuffle, and the second sees
    at most one row per class.
    """
    ok = F.col("label").isNotNull()
    signed = scored.withColumn("_v", F.when(ok, signed_score("label", "score")))
    per_class = signed.groupBy(*key, F.col("_v.sentiment").alias("sentiment")).agg(
        F.count("_v").alias("_n"),
        F.sum("_v.score").alias("_sum"),
        F.min(pos).alias("_first"),
    )
    order = F.when(F.col("_n") > 0, F.struct("_n", -F.col("_first")))
    return per_class.groupBy(*key).agg(
        F.coalesce(F.try_divide(F.sum("_sum"), F.sum("_n")), F.lit(0.0)).alias("sentiment_score"),
        F.coalesce(F.max_by("sentiment", order), F.lit("neutral")).alias("sentiment"),
    )


def document_sentiment(
    filings: DataFrame,
    companies: DataFrame,
    scorer=lexicon_label,
    rate: float | None = None,
    seed: int = 42,
    sep: str = BLANK_LINE,
    start: str = START_DATE,
    end: str = END_DATE,
    cut: int = 512,
    batch: int = 4,
    spread: bool = True,
) -> DataFrame:
    """Scorer-based tone per filing: date, cut into pieces, score, pool.

    All of a text is scored; only with `rate` is it a sample of its paragraphs.  A
    Column scorer runs in one pass with no shuffle.  A model scorer gets one row
    per piece; with `spread` these are shared out over the cluster, so that one
    long filing is no long task, which shuffles the text of the pieces.
    """
    kept = ["ticker", "year", "quarter", "filing_path", "filing_id"]
    dated = dated_filings(filings, filing_date("text"), start, end)
    text = F.col("text") if rate is None else sampled_text("text", "filing_id", rate, seed, sep)
    read = dated.withColumnRenamed("path", "filing_path").select(*kept, text.alias("text"))
    if _is_column(scorer):
        def signed(p):
            s = scorer(p)
            return signed_score(s["label"], s["score"])

        pooled = read.withColumn(
            "_p", pooled_score(F.transform(pieces("text", cut), signed))
        ).select(
            *kept,
            F.col("_p.score").alias("sentiment_score"),
            F.col("_p.sentiment").alias("sentiment"),
        )
    else:
        cut_up = read.select(*kept, F.posexplode_outer(pieces("text", cut)).alias("pos", "piece"))
        if spread:
            cut_up = cut_up.repartition("filing_id", "pos")
        pooled = aggregate_pieces(with_scorer(cut_up, scorer, batch=batch), kept)
    return pooled.join(companies, "ticker").select(
        "ticker",
        "company",
        "year",
        "quarter",
        "sentiment_score",
        "sentiment",
        "filing_path",
        "filing_id",
    )


def sentiment_summary(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Count per class, mean score per ticker, total count."""
    return (
        df.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n")),
        df.groupBy("ticker").agg(F.avg("sentiment_score").alias("mean_score")),
        df.agg(F.count(F.lit(1)).alias("n")),
    )
