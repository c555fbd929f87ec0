"""Queries of the event study: sources, series, joins, text, tone."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetape.functions import text as tx
from tonetape.functions.labels import label_move
from tonetape.operators import events as ev
from tonetape.operators import sentiment as se
from tonetape.operators import series as ser
from tonetape.operators.asof import asof_forward
from tonetape.operators.lexicon import lexicon_counts, read_lexicons
from tonetape.sources import readers, writers
from tonetape.session import checkpoint_dir
from workload import views as v
from workload.sql import define, sql


def r6(df: DataFrame) -> DataFrame:
    """Doubles to six places, so sums in another order compare equal."""
    return df.withColumns(
        {n: F.round(n, 6) for n, t in df.dtypes if t == "double"}
    )


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place the cluster names."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, needs: tuple = (), oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = sql(needs, oracle)
        return fn

    return register


# ---- flagship -------------------------------------------------------------------


@query(
    "flagship_tone_and_move",
    ("features",),
    """SELECT sentiment, target, count(*)::bigint AS n, round(avg(return_1d), 6) AS mean_return,
    round(avg(sentiment_score), 6) AS mean_score FROM features GROUP BY 1, 2""",
)
def flagship(spark, sf_dir):
    return r6(
        v.features(spark, sf_dir)
        .groupBy("sentiment", "target")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("return_1d").alias("mean_return"),
            F.avg("sentiment_score").alias("mean_score"),
        )
    )


# ---- sources and sinks -----------------------------------------------------------


@query(
    "src3_between_dates",
    (),
    """SELECT o_orderkey, o_totalprice, o_orderdate::date AS d FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""",
)
def _(spark, sf_dir):
    kept = readers.between_dates(v.table(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01", "1996-12-31")
    return kept.select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("d"))


@query("src5_companies_dim", ("companies",), "SELECT ticker, company FROM companies")
def _(spark, sf_dir):
    return v.company_names(spark, sf_dir)


@query(
    "src8_prefer",
    ("tone",),
    "SELECT ticker, filing_id, round(sentiment_score, 6) AS sentiment_score FROM tone",
)
def _(spark, sf_dir):
    tone = v.tone(spark, sf_dir)
    better = tone.where("sentiment_score > 1")
    return r6(readers.prefer(better, tone).select("ticker", "filing_id", "sentiment_score"))


BARS_SQL = "SELECT ticker, d, open, high, low, close, volume FROM bars"


@query(
    "src8_prefer_first",
    ("tone",),
    """SELECT ticker, filing_id, round(sentiment_score, 6) AS sentiment_score FROM tone
    WHERE sentiment_score > 0""",
)
def _(spark, sf_dir):
    tone = v.tone(spark, sf_dir)
    better = tone.where("sentiment_score > 0")
    return r6(readers.prefer(better, tone).select("ticker", "filing_id", "sentiment_score"))


@query("src1_price_files", ("bars",), BARS_SQL)
def _(spark, sf_dir):
    """Bars written as price files and read back."""
    path = fresh(spark, "prices")
    out = v.bars(spark, sf_dir).select(
        F.concat("ticker", F.lit("_prices.csv")).alias("file"),
        F.date_format("d", "yyyy-MM-dd").alias("time"),
        "open", "high", "low", "close", "volume",
    )
    out.write.partitionBy("file").option("header", True).csv(path)
    return readers.read_prices(spark, path).drop("ts")


@query("src2_event_date_files", ("event_dates",), "SELECT ticker, d FROM event_dates")
def _(spark, sf_dir):
    """Event dates written as files and read back."""
    path = fresh(spark, "dates")
    none = F.lit(None).cast("double")
    v.event_dates(spark, sf_dir).select(
        F.concat("ticker", F.lit("_earnings_dates.csv")).alias("file"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        none.alias("eps_estimate"), none.alias("reported_eps"), none.alias("surprise_pct"),
    ).write.partitionBy("file").option("header", True).csv(path)
    return readers.read_event_dates(spark, path).select("ticker", F.col("ts").cast("date").alias("d"))


@query(
    "src4_filing_tree",
    ("filings",),
    "SELECT ticker, filing_id::varchar AS filing_id, text || chr(10) AS text FROM filings",
)
def _(spark, sf_dir):
    """Filings written as a tree of text files and read back; a text file ends its last line."""
    path = fresh(spark, "tree")
    writers.write_filing_tree(v.filings(spark, sf_dir), path)
    return readers.read_filing_tree(spark, path).drop("path")


@query("src4_filing_table", ("filings",), "SELECT ticker, filing_id::varchar AS filing_id, path, text FROM filings")
def _(spark, sf_dir):
    """Filings written as an archive table, some twice, and read back."""
    path = fresh(spark, "archive")
    once = v.filings(spark, sf_dir).withColumn("filing_id", F.col("filing_id").cast("string"))
    again = once.where("ticker < 'C'").withColumn("path", F.concat("path", F.lit("/later")))
    writers.write_table(once.unionByName(again), path)
    return readers.read_filings(spark, path)


FEATURES_SQL = """SELECT ticker, company, year, quarter, report_date,
round(sentiment_score, 6) AS sentiment_score, sentiment, round(return_1d, 6) AS return_1d, target,
round(pre_return, 6) AS pre_return, round(pre_volume_change, 6) AS pre_volume_change,
round(pre_rsi, 6) AS pre_rsi, filing_id::varchar AS filing_id FROM features"""


@query("src6_snk3_feature_table", ("features",), FEATURES_SQL)
def _(spark, sf_dir):
    """Feature rows written as parquet and read back."""
    path = fresh(spark, "features")
    rows = v.features(spark, sf_dir).withColumn("filing_id", F.col("filing_id").cast("string"))
    writers.write_table(rows, path)
    return r6(readers.read_features(spark, path))


INDICATORS_SQL = """SELECT ticker, d, close, volume, round(daily_return, 6) AS daily_return,
round(ma5, 6) AS ma5, round(ma10, 6) AS ma10, round(volume_change, 6) AS volume_change,
round(rsi, 6) AS rsi FROM indicators"""


def _indicators(spark, sf_dir):
    return ser.price_indicators(v.bars(spark, sf_dir).select("ticker", "d", "close", "volume"))


@query("snk1_indicator_table", ("indicators",), INDICATORS_SQL)
def _(spark, sf_dir):
    """Indicators written by ticker and read back."""
    path = fresh(spark, "indicators")
    writers.write_indicators(_indicators(spark, sf_dir), path)
    return r6(spark.read.parquet(path))


TONE_SQL = """SELECT ticker, company, year, quarter, round(sentiment_score, 6) AS sentiment_score,
positive_count, negative_count, sentiment, filing_path, filing_id FROM tone"""


@query("snk2_tone_table", ("tone",), TONE_SQL)
def _(spark, sf_dir):
    """Tone rows written as parquet and read back."""
    path = fresh(spark, "tone")
    writers.write_table(v.tone(spark, sf_dir), path)
    return r6(spark.read.parquet(path))


# ---- series ----------------------------------------------------------------------


@query("ts1_daily_return", ("changes",), "SELECT ticker, d, round(daily_return, 6) AS daily_return FROM changes")
def _(spark, sf_dir):
    return r6(_indicators(spark, sf_dir).select("ticker", "d", "daily_return"))


@query("ts2_volume_change", ("changes",), "SELECT ticker, d, round(volume_change, 6) AS volume_change FROM changes")
def _(spark, sf_dir):
    return r6(_indicators(spark, sf_dir).select("ticker", "d", "volume_change"))


@query("ts3_rolling_mean", ("changes",), "SELECT ticker, d, round(ma5, 6) AS ma5, round(ma10, 6) AS ma10 FROM changes")
def _(spark, sf_dir):
    return r6(_indicators(spark, sf_dir).select("ticker", "d", "ma5", "ma10"))


@query("ts4_diff", ("changes",), "SELECT ticker, d, round(delta, 6) AS delta FROM changes")
def _(spark, sf_dir):
    return r6(ser.gains_and_losses(v.bars(spark, sf_dir)).select("ticker", "d", "delta"))


@query("ts5_gain_loss", ("moves",), "SELECT ticker, d, round(gain, 6) AS gain, round(loss, 6) AS loss FROM moves")
def _(spark, sf_dir):
    return r6(ser.gains_and_losses(v.bars(spark, sf_dir)).select("ticker", "d", "gain", "loss"))


@query("ts6_rsi", ("indicators",), "SELECT ticker, d, round(rsi, 6) AS rsi FROM indicators")
def _(spark, sf_dir):
    return r6(_indicators(spark, sf_dir).select("ticker", "d", "rsi"))


define(
    "starts",
    ("event_dates", "bars"),
    """SELECT DISTINCT e.ticker, b.d FROM event_dates e ASOF JOIN bars b
    ON e.ticker = b.ticker AND e.d <= b.d""",
)
define(
    "flagged",
    ("starts", "bars"),
    """SELECT b.ticker, b.d, max((s.d IS NOT NULL)::int) OVER (PARTITION BY b.ticker ORDER BY b.d
    ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS post_earnings
    FROM bars b LEFT JOIN starts s ON b.ticker = s.ticker AND b.d = s.d""",
)


@query(
    "ts7_price_indicators",
    ("indicators", "flagged"),
    INDICATORS_SQL.replace("FROM indicators", ", post_earnings FROM indicators JOIN flagged USING (ticker, d)"),
)
def _(spark, sf_dir):
    out = ser.price_indicators(v.bars(spark, sf_dir), v.event_dates(spark, sf_dir))
    return r6(out.select("ticker", "d", "close", "volume", *ser.OUTPUTS, "post_earnings"))


@query(
    "ts8_volatility",
    ("changes",),
    """SELECT ticker, d, round(CASE WHEN count(daily_return) OVER w = 20
    THEN stddev_samp(daily_return) OVER w END, 6) AS volatility FROM changes
    WINDOW w AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
)
def _(spark, sf_dir):
    return r6(ser.volatility(v.bars(spark, sf_dir), 20).select("ticker", "d", "volatility"))


# ---- event joins -----------------------------------------------------------------


@query("evt1_flag_after", ("flagged",), "SELECT ticker, d, post_earnings FROM flagged")
def _(spark, sf_dir):
    return ev.flag_after(v.bars(spark, sf_dir), v.event_dates(spark, sf_dir)).select(
        "ticker", "d", "post_earnings"
    )


@query(
    "evt2_quarter_anchor",
    ("dated",),
    "SELECT filing_id, year, quarter, make_date(year, quarter * 3 - 1, 15) AS anchor FROM dated",
)
def _(spark, sf_dir):
    return _tx1(spark, sf_dir).select(
        "filing_id", "year", "quarter", ev.quarter_anchor("year", "quarter").alias("anchor")
    )


define("filing_days", ("numbered",), "SELECT doc_id AS filing_id, ticker, d FROM numbered")

define(
    "tied",
    ("bars",),
    """SELECT ticker, d, close, 'b' AS side FROM bars UNION ALL SELECT ticker, d, close, 'a' FROM bars
    UNION ALL SELECT ticker, d, close + 1, 'a' FROM bars""",
)


@query(
    "evt3_asof_forward_ties",
    ("filing_days", "tied"),
    """SELECT f.filing_id, f.ticker, f.d AS filed, b.d AS bar_date, b.close, b.side FROM filing_days f ASOF JOIN (
    SELECT ticker, d, min({'close': close, 'side': side}).close AS close,
    min({'close': close, 'side': side}).side AS side FROM tied GROUP BY 1, 2) b
    ON f.ticker = b.ticker AND f.d <= b.d""",
)
def _(spark, sf_dir):
    """Bars that tie in ticker and day: one row per filing, the smallest bar."""
    days = v._numbered(spark, sf_dir).select(F.col("doc_id").alias("filing_id"), "ticker", F.col("d").alias("filed"))
    bars = v.bars(spark, sf_dir).select("ticker", F.col("d").alias("bar_date"), "close")
    side = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.lit(x).alias("up")) for s, x in (("b", 0), ("a", 0), ("a", 1))]))
    tied = bars.withColumn("x", side).select("ticker", "bar_date", (F.col("close") + F.col("x.up")).alias("close"), "x.side")
    return asof_forward(days, tied, ["ticker"], "filed", "bar_date").select("filing_id", "ticker", "filed", "bar_date", "close", "side")




@query(
    "evt3_asof_forward",
    ("filing_days", "bars"),
    """SELECT f.filing_id, f.ticker, f.d AS filed, b.d AS bar_date, b.close
    FROM filing_days f ASOF JOIN bars b ON f.ticker = b.ticker AND f.d <= b.d""",
)
def _(spark, sf_dir):
    days = v._numbered(spark, sf_dir).select(
        F.col("doc_id").alias("filing_id"), "ticker", F.col("d").alias("filed")
    )
    bars = v.bars(spark, sf_dir).select("ticker", F.col("d").alias("bar_date"), "close")
    return asof_forward(days, bars, ["ticker"], "filed", "bar_date").select(
        "filing_id", "ticker", "filed", "bar_date", "close"
    )


@query(
    "evt3_asof_forward_tolerance",
    ("filing_days", "bars"),
    """SELECT f.filing_id, f.ticker, f.d AS filed, b.d AS bar_date, b.close
    FROM filing_days f LEFT JOIN (
      SELECT f2.filing_id, b2.d, b2.close FROM filing_days f2 ASOF JOIN bars b2
      ON f2.ticker = b2.ticker AND f2.d <= b2.d WHERE b2.d - f2.d <= 2) b USING (filing_id)""",
)
def _(spark, sf_dir):
    days = v._numbered(spark, sf_dir).select(
        F.col("doc_id").alias("filing_id"), "ticker", F.col("d").alias("filed")
    )
    bars = v.bars(spark, sf_dir).select("ticker", F.col("d").alias("bar_date"), "close")
    return asof_forward(
        days, bars, ["ticker"], "filed", "bar_date", how="left", tolerance=2
    ).select("filing_id", "ticker", "filed", "bar_date", "close")


@query(
    "evt4_post_return",
    ("windows",),
    "SELECT ticker, d, round(return_1d, 6) AS return_1d FROM windows WHERE has_post",
)
def _(spark, sf_dir):
    return r6(ev.post_return(_indicators(spark, sf_dir)).select("ticker", "d", "return_1d"))


@query(
    "evt5_pre_window",
    ("windows",),
    """SELECT ticker, d, round(pre_return, 6) AS pre_return,
    round(pre_volume_change, 6) AS pre_volume_change, round(pre_rsi, 6) AS pre_rsi FROM windows""",
)
def _(spark, sf_dir):
    return r6(
        ev.pre_window(_indicators(spark, sf_dir)).select(
            "ticker", "d", "pre_return", "pre_volume_change", "pre_rsi"
        )
    )


@query(
    "evt6_covered",
    ("tone", "bars"),
    "SELECT filing_id, ticker FROM tone WHERE ticker IN (SELECT ticker FROM bars)",
)
def _(spark, sf_dir):
    return ev.covered(v.tone(spark, sf_dir), v.bars(spark, sf_dir)).select("filing_id", "ticker")


LABEL_SQL = """CASE WHEN daily_return IS NULL THEN NULL WHEN daily_return > 25 THEN 1
WHEN daily_return < -25 THEN -1 ELSE 0 END::int AS target"""


@query("evt7_label_move", ("changes",), f"SELECT ticker, d, {LABEL_SQL} FROM changes")
def _(spark, sf_dir):
    return _indicators(spark, sf_dir).select(
        "ticker", "d", label_move("daily_return", **v.MOVES).alias("target")
    )


@query(
    "evt8_labelled",
    ("changes",),
    f"SELECT * FROM (SELECT ticker, d, {LABEL_SQL} FROM changes) WHERE target IS NOT NULL",
)
def _(spark, sf_dir):
    return ev.labelled(QUERIES["evt7_label_move"](spark, sf_dir))


@query("evt9_build_features", ("features",), FEATURES_SQL.replace("filing_id::varchar AS filing_id", "filing_id"))
def _(spark, sf_dir):
    return r6(v.features(spark, sf_dir))


# ---- text ------------------------------------------------------------------------


def _tx1(spark, sf_dir):
    return se.dated_filings(
        v.filings(spark, sf_dir), tx.header_date("text"), v.START, v.END
    )


@query(
    "txt1_header_date",
    ("filings",),
    "SELECT filing_id, year(d)::int AS year, month(d)::int AS month FROM filings",
)
def _(spark, sf_dir):
    return (
        v.filings(spark, sf_dir)
        .withColumn("ym", tx.header_date("text"))
        .select("filing_id", "ym.year", "ym.month")
    )


MIXED = """CASE filing_id % 4
 WHEN 0 THEN '<SEC-DOCUMENT> : ' || strftime(d, '%Y%m%d')
 WHEN 1 THEN '<FILING-DATE>' || chr(10) || strftime(d, '%Y%m%d') || ' x'
 WHEN 2 THEN 'Filed on ' || month(d) || '/' || day(d) || '/' || year(d)
 ELSE 'FILING-DATE ' || strftime(d, '%Y%m%d') END"""


@query(
    "txt2_filing_date",
    ("filings",),
    f"""SELECT filing_id,
    coalesce(nullif(a[1], '')[1:4], nullif(b[1], '')[1:4], nullif(c[1], '')[7:10])::int AS year,
    coalesce(nullif(a[1], '')[5:6], nullif(b[1], '')[5:6], nullif(c[1], '')[1:2])::int AS month
    FROM (SELECT filing_id,
      list_filter(list_transform(head, lambda x: regexp_extract(x, ': (\\d{{8}})$', 1)), lambda x: x <> '') AS a,
      list_filter(list_transform(range(1, len(head)), lambda i: 
        CASE WHEN contains(head[i], 'FILING-DATE') OR contains(head[i], 'ACCEPTANCE-DATETIME')
        THEN regexp_extract(head[i + 1], '(\\d{{8}})', 1) ELSE '' END), lambda x: x <> '') AS b,
      list_transform(list_filter(list_transform(head, lambda x: 
        regexp_extract(x, '\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{4}}')), lambda x: x <> ''),
        lambda x: strftime(strptime(replace(x, '-', '/'), '%m/%d/%Y'), '%m/%d/%Y')) AS c
      FROM (SELECT filing_id, list_transform(string_split(t, chr(10))[1:30], lambda x: trim(x)) AS head
        FROM (SELECT filing_id, {MIXED} || chr(10) || text[strpos(text, chr(10)) + 1:] AS t FROM filings)))""",
)
def _(spark, sf_dir):
    """Headers of four kinds put before the texts; the last kind has no date of its own."""
    day = F.to_date(F.regexp_extract("text", tx.HEADER_DATE.replace("$", r"\n"), 1), "yyyyMMdd")
    compact = F.date_format(day, "yyyyMMdd")
    kind = F.col("filing_id") % 4
    head = (
        F.when(kind == 0, F.concat(F.lit("<SEC-DOCUMENT> : "), compact))
        .when(kind == 1, F.concat(F.lit("<FILING-DATE>\n"), compact, F.lit(" x")))
        .when(kind == 2, F.concat(F.lit("Filed on "), F.date_format(day, "M/d/yyyy")))
        .otherwise(F.concat(F.lit("FILING-DATE "), compact))
    )
    body = F.expr("substring(text, instr(text, '\n') + 1)")
    mixed = v.filings(spark, sf_dir).select(
        "filing_id", F.concat(head, F.lit("\n"), body).alias("text")
    )
    return mixed.withColumn("ym", tx.filing_date("text")).select(
        "filing_id", "ym.year", "ym.month"
    )


@query(
    "txt3_quarter_of",
    (),
    """SELECT o_orderkey, ((month(o_orderdate) - 1) // 3 + 1)::int AS quarter FROM orders""",
)
def _(spark, sf_dir):
    return v.table(spark, sf_dir, "orders").select(
        "o_orderkey", tx.quarter_of(F.month("o_orderdate")).alias("quarter")
    )


@query(
    "txt4_in_month_range",
    ("filings",),
    """SELECT filing_id FROM filings
    WHERE make_date(year(d), month(d), 1) BETWEEN DATE '1996-02-10' AND DATE '1998-06-30'""",
)
def _(spark, sf_dir):
    return se.dated_filings(
        v.filings(spark, sf_dir), tx.header_date("text"), "1996-02-10", "1998-06-30"
    ).select("filing_id")


@query("txt5_lexicon_hits", ("hits",), "SELECT filing_id, positive_count, negative_count FROM hits")
def _(spark, sf_dir):
    return v.filings(spark, sf_dir).select(
        "filing_id",
        tx.lexicon_hits("text", v.POSITIVE).alias("positive_count"),
        tx.lexicon_hits("text", v.NEGATIVE).alias("negative_count"),
    )


@query(
    "txt5_lexicon_automaton",
    (),
    """WITH words AS (SELECT DISTINCT w FROM (
      SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark)
      WHERE length(w) BETWEEN 2 AND 3)
    SELECT doc_id, coalesce(sum((length(low) - length(replace(low, w, ''))) // 2)
      FILTER (WHERE length(w) = 2), 0)::bigint AS two,
    coalesce(sum((length(low) - length(replace(low, w, ''))) // 3)
      FILTER (WHERE length(w) = 3), 0)::bigint AS three
    FROM (SELECT doc_id, lower(text) AS low FROM documents WHERE text IS NOT NULL) CROSS JOIN words GROUP BY 1""",
)
def _(spark, sf_dir):
    """The two- and three-letter words of the benchmark items, at most 18,252, in one pass."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    listed = v.table(spark, sf_dir, "benchmark").select(words.alias("word"))
    length = F.when(F.length("word") == 2, "two").when(F.length("word") == 3, "three")
    found = read_lexicons(listed.withColumn("lexicon", length).where("lexicon is not null"))
    lexicons = {n: found.get(n, []) for n in ("two", "three")}
    texts = v.table(spark, sf_dir, "documents").where("text is not null")
    return texts.select("doc_id", lexicon_counts("text", lexicons).alias("c")).select("doc_id", "c.*")


@query("txt6_sentiment_score", ("scored",), "SELECT filing_id, round(sentiment_score, 6) AS score FROM scored")
def _(spark, sf_dir):
    hits = QUERIES["txt5_lexicon_hits"](spark, sf_dir)
    return r6(
        hits.select(
            "filing_id", tx.sentiment_score("positive_count", "negative_count").alias("score")
        )
    )


@query("txt7_sentiment_category", ("tone",), "SELECT filing_id, sentiment FROM tone")
def _(spark, sf_dir):
    hits = QUERIES["txt5_lexicon_hits"](spark, sf_dir)
    score = tx.sentiment_score("positive_count", "negative_count")
    return hits.select("filing_id", tx.sentiment_category(score).alias("sentiment"))


@query("txt8_keyword_sentiment", ("tone",), TONE_SQL)
def _(spark, sf_dir):
    return r6(v.tone(spark, sf_dir))


define(
    "paras",
    ("filings",),
    """SELECT filing_id, text, list_filter(list_transform(string_split(text, chr(10)),
    lambda x: trim(x)), lambda x: x <> '') AS ps FROM filings""",
)


@query(
    "txt9_paragraphs",
    ("paras",),
    """SELECT filing_id, (i - 1)::int AS pos, ps[i] AS paragraph
    FROM (SELECT filing_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM paras)""",
)
def _(spark, sf_dir):
    return v.filings(spark, sf_dir).select(
        "filing_id", F.posexplode(tx.paragraphs("text", "\n")).alias("pos", "paragraph")
    )


define(
    "sampled",
    ("paras",),
    """SELECT filing_id, string_agg(p, chr(10) || chr(10) ORDER BY h, i) AS text FROM (
    SELECT filing_id, ps[i + 1] AS p, i, len(ps) AS n, md5('42:' || filing_id || ':' || i) AS h,
    row_number() OVER (PARTITION BY filing_id ORDER BY md5('42:' || filing_id || ':' || i), i) AS rn
    FROM (SELECT filing_id, ps, unnest(range(0, len(ps))) AS i FROM paras))
    WHERE rn <= greatest(1, floor(n * 0.1::double)) GROUP BY filing_id""",
)


@query("txt10_sampled_text", ("sampled",), "SELECT filing_id, text FROM sampled")
def _(spark, sf_dir):
    return v.filings(spark, sf_dir).select(
        "filing_id", tx.sampled_text("text", "filing_id", sep="\n").alias("text")
    )


def pieces_sql(name: str, source: str) -> None:
    """CTEs that pack the words of `source` into chunks and cut the pieces.

    The end of the chunk that starts at a word is the first word whose running
    cost passes the cost before it by more than 1000; chunks follow these links.
    """
    define(
        f"{name}_words",
        (source,),
        f"""SELECT filing_id, i, w, len(w) // 4 + 1 AS cost,
        sum(len(w) // 4 + 1) OVER (PARTITION BY filing_id ORDER BY i)::bigint AS run FROM (
        SELECT filing_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM (
        SELECT filing_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS ws
        FROM {source}))""",
    )
    define(
        f"{name}_links",
        (f"{name}_words",),
        f"""SELECT filing_id, i, first_value(i) OVER (PARTITION BY filing_id ORDER BY run
        RANGE BETWEEN 1001 - cost FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM {name}_words""",
    )
    define(
        f"{name}_starts",
        (f"{name}_links",),
        f"""SELECT filing_id, i, next FROM {name}_links WHERE i = 1 UNION ALL
        SELECT l.filing_id, l.i, l.next FROM {name}_starts s JOIN {name}_links l
        ON s.filing_id = l.filing_id AND s.next = l.i""",
    )
    define(
        f"{name}_chunks",
        (f"{name}_starts", f"{name}_words"),
        f"""SELECT s.filing_id, row_number() OVER (PARTITION BY s.filing_id ORDER BY s.i) - 1 AS pos,
        string_agg(w.w, ' ' ORDER BY w.i) AS chunk, sum(w.cost)::bigint AS cost
        FROM {name}_starts s JOIN {name}_words w ON s.filing_id = w.filing_id AND w.i >= s.i
        AND (s.next IS NULL OR w.i < s.next) GROUP BY s.filing_id, s.i""",
    )
    define(
        f"{name}_pieces",
        (f"{name}_chunks", source),
        f"""SELECT filing_id, (row_number() OVER (PARTITION BY filing_id ORDER BY pos, k) - 1)::int AS pos, piece
        FROM (SELECT filing_id, pos, k, substring(chunk, 512 * k + 1, 512) AS piece
          FROM (SELECT filing_id, pos, chunk, unnest(range(0, (length(chunk) + 511) // 512)) AS k
            FROM {name}_chunks)) WHERE trim(piece) <> ''""",
    )
    define(
        f"{name}_tones",
        (f"{name}_pieces",),
        f"""SELECT filing_id, pos, CASE WHEN s > 0.1::double THEN 'positive'
        WHEN s < -0.1::double THEN 'negative' ELSE 'neutral' END AS label, abs(s) AS score,
        CASE WHEN abs(s) > 0.1::double THEN s ELSE 0 END AS signed FROM (
        SELECT filing_id, pos, coalesce((p - n)::double / nullif(p + n, 0), 0.0) AS s FROM (
        SELECT filing_id, pos,
        (length(low) - length(replace(low, 'ent', ''))) // 3
        + (length(low) - length(replace(low, 'er', ''))) // 2 AS p,
        (length(low) - length(replace(low, 'ion', ''))) // 3
        + (length(low) - length(replace(low, 'an', ''))) // 2 AS n
        FROM (SELECT *, lower(piece) AS low FROM {name}_pieces)))""",
    )
    define(
        f"{name}_pooled",
        (f"{name}_tones", source),
        f"""SELECT f.filing_id, coalesce(m.mean, 0.0) AS sentiment_score,
        coalesce(c.label, 'neutral') AS sentiment FROM {source} f
        LEFT JOIN (SELECT filing_id, avg(signed) AS mean FROM {name}_tones GROUP BY 1) m USING (filing_id)
        LEFT JOIN (SELECT filing_id, label FROM (
          SELECT filing_id, label, row_number() OVER (PARTITION BY filing_id
          ORDER BY count(*) DESC, min(pos)) AS rn FROM {name}_tones GROUP BY 1, 2) WHERE rn = 1) c
        USING (filing_id)""",
    )


pieces_sql("whole", "filings")


def _scorer(piece):
    return tx.lexicon_label(piece, v.POSITIVE, v.NEGATIVE)


def _python_model():
    """The same lexicon as a Python model, loaded per task."""
    up, down = v.POSITIVE, v.NEGATIVE

    def load():
        def predict(texts):
            out = []
            for t in texts:
                low = t.lower()
                p, n = (sum(low.count(w) for w in ws) for ws in (up, down))
                s = (p - n) / (p + n) if p + n else 0.0
                out.append(("positive" if s > 0.1 else "negative" if s < -0.1 else "neutral", abs(s)))
            return out

        return predict

    return se.loads_model(load)


@query(
    "txt11_chunk_words",
    ("whole_chunks",),
    "SELECT filing_id, pos::int AS pos, chunk FROM whole_chunks",
)
def _(spark, sf_dir):
    return v.filings(spark, sf_dir).select(
        "filing_id", F.posexplode(tx.chunk_words("text")).alias("pos", "chunk")
    )


@query("txt12_score_pieces", ("whole_pieces",), "SELECT filing_id, pos, piece FROM whole_pieces")
def _(spark, sf_dir):
    return se.score_pieces(v.filings(spark, sf_dir), ["filing_id"])


@query(
    "txt13_signed_score",
    (),
    """SELECT doc_id, round(CASE WHEN doc_id % 5 IN (0, 1) THEN s WHEN doc_id % 5 IN (2, 3) THEN -s
    ELSE 0 END, 6) AS score, CASE WHEN doc_id % 5 IN (0, 1) THEN 'positive'
    WHEN doc_id % 5 IN (2, 3) THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM (SELECT doc_id, (doc_id % 100)::double / 100 AS s FROM documents)""",
)
def _(spark, sf_dir):
    kinds = F.array(*[F.lit(x) for x in ("LABEL_2", "positive", "LABEL_0", "negative", "LABEL_1")])
    docs = v.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.get(kinds, (F.col("doc_id") % 5).cast("int")).alias("label"),
        ((F.col("doc_id") % 100) / 100).alias("s"),
    )
    out = docs.withColumn("x", tx.signed_score("label", "s"))
    return r6(out.select("doc_id", "x.score", "x.sentiment"))


POOLED_SQL = "SELECT filing_id, round(sentiment_score, 6) AS sentiment_score, sentiment FROM {}_pooled"


@query("txt14_aggregate_pieces", ("whole_pooled",), POOLED_SQL.format("whole"))
def _(spark, sf_dir):
    rows = se.score_pieces(v.filings(spark, sf_dir), ["filing_id"])
    return r6(se.aggregate_pieces(se.with_scorer(rows, _scorer), ["filing_id"]))


@query(
    "txt15_model_scorer",
    ("whole_tones",),
    "SELECT filing_id, pos, label, round(score, 6) AS score FROM whole_tones",
)
def _(spark, sf_dir):
    rows = se.score_pieces(v.filings(spark, sf_dir), ["filing_id"])
    return r6(se.with_scorer(rows, _python_model()).drop("piece", "failure"))


DOC_SQL = """SELECT d.ticker, d.company, d.year, d.quarter,
round(p.sentiment_score, 6) AS sentiment_score, p.sentiment, d.path AS filing_path, filing_id
FROM dated d JOIN {}_pooled p USING (filing_id)"""


def _documents(spark, sf_dir, scorer):
    return se.document_sentiment(
        v.filings(spark, sf_dir), v.company_names(spark, sf_dir), scorer, **v.DATES
    )


@query("txt16_document_sentiment", ("dated", "whole_pooled"), DOC_SQL.format("whole"))
def _(spark, sf_dir):
    return r6(_documents(spark, sf_dir, _scorer))


@query("txt16_document_sentiment_model", ("dated", "whole_pooled"), DOC_SQL.format("whole"))
def _(spark, sf_dir):
    return r6(_documents(spark, sf_dir, _python_model()))


@query("txt17_class_counts", ("tone",), "SELECT sentiment, count(*)::bigint AS n FROM tone GROUP BY 1")
def _(spark, sf_dir):
    return se.sentiment_summary(v.tone(spark, sf_dir))[0]


@query(
    "txt17_ticker_means",
    ("tone",),
    "SELECT ticker, round(avg(sentiment_score), 6) AS mean_score FROM tone GROUP BY 1",
)
def _(spark, sf_dir):
    return r6(se.sentiment_summary(v.tone(spark, sf_dir))[1])


@query("txt17_total", ("tone",), "SELECT count(*)::bigint AS n FROM tone")
def _(spark, sf_dir):
    return se.sentiment_summary(v.tone(spark, sf_dir))[2]
