"""SQL pieces for the checks: each piece is one named CTE over the given tables."""

PIECES = {
    "companies": (
        (),
        """SELECT c_mktsegment AS ticker,
        upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS company, idx
        FROM (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS idx
              FROM (SELECT DISTINCT c_mktsegment FROM customer))""",
    ),
    "bars": (
        (),
        """SELECT c_mktsegment AS ticker, o_orderdate::date AS d,
        arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
        min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
        count(*)::double AS volume
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE isodow(o_orderdate) < 6 GROUP BY 1, 2""",
    ),
    "numbered": (
        ("companies",),
        """SELECT doc_id, text, ticker, company,
        DATE '1995-01-01' + (doc_id * 37 % 2400)::int AS d
        FROM documents JOIN companies ON doc_id % (SELECT count(*) FROM companies) = idx""",
    ),
    "filings": (
        ("numbered",),
        """SELECT ticker, company, doc_id AS filing_id, d,
        '<SEC-DOCUMENT>' || doc_id || '.txt : ' || strftime(d, '%Y%m%d') || chr(10) || text AS text,
        ticker || '/8-K/' || doc_id AS path
        FROM numbered""",
    ),
    "event_dates": (
        ("numbered",),
        "SELECT DISTINCT ticker, d FROM numbered",
    ),
    "changes": (
        ("bars",),
        """SELECT *,
        (close / lag(close) OVER w - 1) * 100 AS daily_return,
        (volume / lag(volume) OVER w - 1) * 100 AS volume_change,
        CASE WHEN count(close) OVER w5 = 5 THEN avg(close) OVER w5 END AS ma5,
        CASE WHEN count(close) OVER w10 = 10 THEN avg(close) OVER w10 END AS ma10,
        close - lag(close) OVER w AS delta
        FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY d),
        w5 AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
        w10 AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    ),
    "moves": (
        ("changes",),
        """SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0 END AS gain,
        CASE WHEN delta < 0 THEN -delta ELSE 0 END AS loss FROM changes""",
    ),
    "means": (
        ("moves",),
        """SELECT *, CASE WHEN count(*) OVER w = 14 THEN avg(gain) OVER w END AS up,
        CASE WHEN count(*) OVER w = 14 THEN avg(loss) OVER w END AS down
        FROM moves WINDOW w AS
        (PARTITION BY ticker ORDER BY d ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
    ),
    "indicators": (
        ("means",),
        """SELECT *, CASE WHEN up = 0 AND down = 0 THEN NULL WHEN down = 0 THEN 100.0
        ELSE 100 - 100 / (1 + up / down) END AS rsi FROM means""",
    ),
    "windows": (
        ("indicators",),
        """SELECT ticker, d, has_post, return_1d, pre_return, pre_volume_change, pre_rsi FROM (
        SELECT *, coalesce(lead(d) OVER w <= d + 5, false) AS has_post,
        CASE WHEN lead(d) OVER w <= d + 5 THEN lead(daily_return) OVER w END AS return_1d,
        avg(daily_return) OVER p AS pre_return, avg(volume_change) OVER p AS pre_volume_change,
        last_value(rsi) OVER p AS pre_rsi
        FROM indicators WINDOW w AS (PARTITION BY ticker ORDER BY d),
        p AS (PARTITION BY ticker ORDER BY d
              RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))""",
    ),
    "dated": (
        ("filings",),
        """SELECT *, year(d)::int AS year, ((month(d) - 1) // 3 + 1)::int AS quarter FROM filings
        WHERE make_date(year(d), month(d), 1) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'""",
    ),
    "hits": (
        ("dated",),
        """SELECT *,
        ((length(low) - length(replace(low, 'ent', ''))) // 3
         + (length(low) - length(replace(low, 'er', ''))) // 2)::bigint AS positive_count,
        ((length(low) - length(replace(low, 'ion', ''))) // 3
         + (length(low) - length(replace(low, 'an', ''))) // 2)::bigint AS negative_count
        FROM (SELECT *, lower(text) AS low FROM dated)""",
    ),
    "scored": (
        ("hits",),
        """SELECT *, coalesce((positive_count - negative_count)::double
        / nullif(positive_count + negative_count, 0), 0.0) AS sentiment_score FROM hits""",
    ),
    "tone": (
        ("scored",),
        """SELECT ticker, company, year, quarter, sentiment_score, positive_count, negative_count,
        CASE WHEN sentiment_score > 0.1::double THEN 'positive'
             WHEN sentiment_score < -0.1::double THEN 'negative' ELSE 'neutral' END AS sentiment,
        path AS filing_path, filing_id FROM scored""",
    ),
    "anchors": (
        ("tone",),
        """SELECT DISTINCT ticker, year, quarter, make_date(year, quarter * 3 - 1, 15) AS anchor
        FROM tone WHERE year BETWEEN 1900 AND 2100 AND quarter BETWEEN 1 AND 4""",
    ),
    "event_days": (
        ("anchors", "bars"),
        """SELECT a.*, b.d AS report_date FROM anchors a ASOF JOIN bars b
        ON a.ticker = b.ticker AND a.anchor <= b.d""",
    ),
    "features": (
        ("event_days", "windows"),
        """SELECT t.ticker, t.company, t.year, t.quarter, e.report_date, t.sentiment_score,
        t.sentiment, w.return_1d,
        (CASE WHEN w.return_1d > 25 THEN 1 WHEN w.return_1d < -25 THEN -1 ELSE 0 END)::int AS target,
        w.pre_return, w.pre_volume_change, w.pre_rsi, t.filing_id
        FROM tone t JOIN event_days e USING (ticker, year, quarter)
        JOIN windows w ON w.ticker = t.ticker AND w.d = e.report_date
        WHERE w.has_post AND w.return_1d IS NOT NULL""",
    ),
    "complete": (
        ("features",),
        """SELECT * FROM features WHERE pre_return IS NOT NULL
        AND pre_volume_change IS NOT NULL AND pre_rsi IS NOT NULL""",
    ),
    "preds": (
        (),
        """SELECT doc_id, quality - toxic AS "true",
        (('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint % 3 - 1)::int AS pred FROM labels""",
    ),
    "preds7": (
        (),
        """SELECT doc_id, quality - toxic AS "true",
        (('0x' || substr(md5('7:' || doc_id), 1, 8))::bigint % 3 - 1)::int AS pred FROM labels""",
    ),
    "stacked": (
        ("preds", "preds7"),
        """SELECT *, 'pick_42' AS model FROM preds UNION ALL
        SELECT *, 'pick_7' AS model FROM preds7""",
    ),
}


def define(name: str, needs: tuple, body: str) -> None:
    PIECES[name] = (needs, body)


def sql(needs: tuple, body: str) -> str:
    """`body` with the CTEs it needs, each after those it is built on."""
    order: list[str] = []

    def visit(name):
        for n in PIECES[name][0]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({PIECES[n][1]})" for n in order)
    return f"WITH RECURSIVE {ctes}\n{body}"
