"""The study's inputs, derived from the given tables."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonetape.operators.models import random_baseline
from tonetape.operators.sentiment import keyword_sentiment
from tonetape.operators.events import build_features

POSITIVE = ("ent", "er")
NEGATIVE = ("ion", "an")
LEXICON = {"positive": POSITIVE, "negative": NEGATIVE}
START, END = "1995-01-01", "2001-12-31"
DATES = {"start": START, "end": END}
MOVES = {"up": 25.0, "down": -25.0}


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file the first time only."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def companies(spark, sf_dir) -> DataFrame:
    """The market segments in name order, numbered from 0."""
    names = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    order = Window.partitionBy().orderBy("c_mktsegment")
    return (
        names.withColumn("idx", F.row_number().over(order) - 1)
        .select(
            F.col("c_mktsegment").alias("ticker"),
            F.initcap("c_mktsegment").alias("company"),
            F.col("idx").cast("long").alias("idx"),
        )
    )


def company_names(spark, sf_dir) -> DataFrame:
    return companies(spark, sf_dir).select("ticker", "company")


def bars(spark, sf_dir) -> DataFrame:
    """Orders as ticks of their customer's segment, rolled up to weekday bars."""
    ticks = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("d"))
        .where(F.weekday("d") < 5)
        .join(
            table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
    )
    return (
        ticks.groupBy(F.col("c_mktsegment").alias("ticker"), "d")
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
        .withColumn("ts", F.col("d").cast("timestamp"))
    )


def _numbered(spark, sf_dir) -> DataFrame:
    """Documents with a ticker and a date; there is one row per segment name to broadcast."""
    first = F.lit("1995-01-01").cast("date")
    segments = companies(spark, sf_dir)
    number = segments.select(F.count(F.lit(1))).scalar()
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "text", (F.col("doc_id") % number).alias("idx"))
        .join(F.broadcast(segments), "idx")
        .withColumn("d", F.date_add(first, (F.col("doc_id") * 37 % 2400).cast("int")))
    )


def filings(spark, sf_dir) -> DataFrame:
    """Documents as filings with a dated first line."""
    head = F.concat(
        F.lit("<SEC-DOCUMENT>"),
        F.col("doc_id"),
        F.lit(".txt : "),
        F.date_format("d", "yyyyMMdd"),
        F.lit("\n"),
    )
    return _numbered(spark, sf_dir).select(
        "ticker",
        F.col("doc_id").alias("filing_id"),
        F.concat(F.col("ticker"), F.lit("/8-K/"), F.col("doc_id")).alias("path"),
        F.concat(head, F.col("text")).alias("text"),
    )


def event_dates(spark, sf_dir) -> DataFrame:
    return (
        _numbered(spark, sf_dir)
        .select("ticker", F.col("d").cast("timestamp").alias("ts"))
        .distinct()
    )


def tone(spark, sf_dir) -> DataFrame:
    return keyword_sentiment(
        filings(spark, sf_dir), company_names(spark, sf_dir), **LEXICON, **DATES
    )


def features(spark, sf_dir) -> DataFrame:
    return build_features(tone(spark, sf_dir), bars(spark, sf_dir), **MOVES)


def preds(spark, sf_dir, seed: int = 42) -> DataFrame:
    """True class quality - toxic, predicted class a hash pick."""
    rows = table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") - F.col("toxic")).alias("true")
    )
    return random_baseline(rows, ["doc_id"], seed)
