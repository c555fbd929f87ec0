"""Row types shared by readers, operators and writers."""

from pyspark.sql import types as T

BARS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("d", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)

EVENT_DATES = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("eps_estimate", T.DoubleType()),
        T.StructField("reported_eps", T.DoubleType()),
        T.StructField("surprise_pct", T.DoubleType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("report_date", T.DateType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("return_1d", T.DoubleType()),
        T.StructField("target", T.IntegerType()),
        T.StructField("pre_return", T.DoubleType()),
        T.StructField("pre_volume_change", T.DoubleType()),
        T.StructField("pre_rsi", T.DoubleType()),
        T.StructField("filing_id", T.StringType()),
    ]
)

# The companies studied.
COMPANIES = {
    "AAPL": "Apple Inc.",
    "MSFT": "Microsoft Corporation",
    "GOOGL": "Alphabet Inc.",
    "AMZN": "Amazon.com Inc.",
    "NVDA": "NVIDIA Corporation",
    "META": "Meta Platforms Inc.",
    "TSLA": "Tesla Inc.",
    "AMD": "Advanced Micro Devices Inc.",
    "INTC": "Intel Corporation",
    "CRM": "Salesforce Inc.",
}

# The tone lexicon.
POSITIVE_WORDS = (
    "increase", "growth", "improved", "higher", "strong", "positive",
    "exceeded", "beat", "record", "success", "profit", "gain",
)
NEGATIVE_WORDS = (
    "decrease", "decline", "fell", "lower", "weak", "negative",
    "missed", "loss", "challenging", "difficult", "down", "reduced",
)

# Study range, class codes and class names.
START_DATE = "2021-01-01"
END_DATE = "2024-12-31"
CLASSES = (-1, 0, 1)
CLASS_NAMES = {-1: "Down", 0: "Stable", 1: "Up"}
