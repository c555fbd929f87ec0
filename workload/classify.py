"""Queries of the classification side: preparation, models, metrics, reports, checks."""

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonetape.functions.labels import class_name, decode_label, encode_label
from tonetape.operators import checks as ck
from tonetape.operators import evaluate as el
from tonetape.operators import models as m
from tonetape.operators import prep as pp
from tonetape.operators import report as rp
from tonetape.operators.categories import accuracy_cells, category_vectors, confusion_cells
from tonetape.operators.forests import gain_shares, node_table
from tonetape.plans.study import prepare, run_classification
from tonetape.session import materialised, release
from tonetape.sources import readers, writers
from workload import views as v
from workload.sql import define, sql
from workload.study import fresh, r6

QUERIES: dict = {}
ORACLES: dict = {}
KEY = ["filing_id"]


def query(name: str, needs: tuple = (), oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = sql(needs, oracle)
        return fn

    return register


def _complete(spark, sf_dir) -> DataFrame:
    """Complete feature rows, written once: the steps below read them several times."""
    return materialised(pp.complete_rows(v.features(spark, sf_dir)))


# ---- preparation -----------------------------------------------------------------


@query(
    "prp1_complete_rows",
    ("complete",),
    """SELECT filing_id, report_date, target, round(pre_return, 6) AS pre_return,
    round(pre_volume_change, 6) AS pre_volume_change, round(pre_rsi, 6) AS pre_rsi FROM complete""",
)
def _(spark, sf_dir):
    return r6(
        pp.complete_rows(v.features(spark, sf_dir)).select(
            "filing_id", "report_date", "target", "pre_return", "pre_volume_change", "pre_rsi"
        )
    )


@query(
    "prp2_one_hot",
    ("complete",),
    """SELECT filing_id, (sentiment = 'negative')::int::double AS sentiment_negative,
    (sentiment = 'neutral')::int::double AS sentiment_neutral,
    (sentiment = 'positive')::int::double AS sentiment_positive FROM complete""",
)
def _(spark, sf_dir):
    return pp.one_hot(_complete(spark, sf_dir).select("filing_id", "sentiment"), "sentiment")


@query(
    "prp2_category_vectors",
    (),
    """SELECT o_orderkey, number, '(' || n || ',[' || number || '],[1.0])' AS vector FROM (
    SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_custkey) - 1)::bigint AS number,
    (SELECT count(DISTINCT o_custkey) FROM orders) AS n FROM orders)""",
)
def _(spark, sf_dir):
    """Customers of orders as one sparse vector column, a place for each customer."""
    orders = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    vectors = category_vectors(orders, "o_custkey")
    numbers = vectors.numbers.withColumnRenamed("value", "o_custkey")
    return vectors.transform(orders).join(numbers, "o_custkey").select(
        "o_orderkey", "number", F.col("o_custkey_vector").cast("string").alias("vector")
    )


NAMES = [
    "sentiment_score", "pre_return", "pre_volume_change", "pre_rsi",
    "sentiment_score", "sentiment_negative", "sentiment_neutral", "sentiment_positive",
]
define(
    "hot",
    ("complete",),
    """SELECT *, (sentiment = 'negative')::int::double AS sentiment_negative,
    (sentiment = 'neutral')::int::double AS sentiment_neutral,
    (sentiment = 'positive')::int::double AS sentiment_positive FROM complete""",
)


@query(
    "prp3_feature_columns",
    ("hot",),
    "SELECT filing_id, " + ", ".join(f"round({n}, 6) AS f{i}" for i, n in enumerate(NAMES)) + " FROM hot",
)
def _(spark, sf_dir):
    """Feature values by position; the score stands in two places."""
    wide = pp.one_hot(_complete(spark, sf_dir), "sentiment")
    names = pp.feature_columns(wide)
    return r6(wide.select("filing_id", *[F.col(n).alias(f"f{i}") for i, n in enumerate(names)]))


@query(
    "prp4_class_counts",
    ("complete",),
    "SELECT target, count(*)::bigint AS n FROM complete GROUP BY 1",
)
def _(spark, sf_dir):
    return pp.class_counts(pp.complete_rows(v.features(spark, sf_dir)))


@query(
    "prp5_holdout_share",
    ("complete",),
    """SELECT CASE WHEN min(n) < 10 THEN 0.5::double ELSE 0.3::double END AS share
    FROM (SELECT target, count(*) AS n FROM complete GROUP BY 1)""",
)
def _(spark, sf_dir):
    return pp.holdout_share(pp.class_counts(pp.complete_rows(v.features(spark, sf_dir))))


def ranked_sql(source: str, label: str, key: str, seed: int = 42) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY {label}
    ORDER BY md5('{seed}:' || {key}), {key}) AS rk FROM {source}"""


def split_sql(source: str, label: str, key: str, share: str = "0.3::double") -> str:
    """Rows of `source` with `part`; class quotas by largest remainder."""
    return f"""SELECT r.*, CASE WHEN r.rk <= q.quota THEN 'train' ELSE 'test' END AS part
    FROM ({ranked_sql(source, label, key)}) r JOIN (
      SELECT {label}, floor(exact) + (row_number() OVER (
        ORDER BY round(exact - floor(exact), 9) DESC, {label})
        <= train - sum(floor(exact)) OVER ())::int AS quota
      FROM (SELECT {label}, n, train, n * train / total AS exact FROM (
        SELECT {label}, n, sum(n) OVER ()::double AS total,
        sum(n) OVER () - ceil(sum(n) OVER () * {share}) AS train
        FROM (SELECT {label}, count(*) AS n FROM {source} GROUP BY 1)))) q
    ON r.{label} = q.{label}"""


define("split", ("hot",), split_sql("hot", "target", "filing_id"))


@query("prp6_stratified_split", ("split",), "SELECT filing_id, target, part FROM split")
def _(spark, sf_dir):
    rows = _complete(spark, sf_dir).select("filing_id", "target")
    return pp.stratified_split(rows, "target", KEY)


define("keyed", ("complete",), "SELECT DISTINCT target, ticker || ':' || report_date AS day FROM complete")
define("split_days", ("keyed",), split_sql("keyed", "target", "day"))


@query(
    "prp6_grouped_split",
    ("complete", "split_days"),
    """SELECT c.filing_id, c.target, s.part FROM complete c JOIN split_days s
    ON c.target = s.target AND c.ticker || ':' || c.report_date = s.day""",
)
def _(spark, sf_dir):
    """Whole events are drawn, so no event has rows on both sides."""
    rows = _complete(spark, sf_dir).select("filing_id", "target", "ticker", "report_date")
    cut = pp.stratified_split(rows, "target", KEY, group_cols=["ticker", "report_date"])
    return cut.select("filing_id", "target", "part")


def _split(spark, sf_dir):
    wide = pp.one_hot(_complete(spark, sf_dir), "sentiment")
    rows = pp.stratified_split(wide, "target", KEY)
    return rows.where("part = 'train'"), rows.where("part = 'test'")


@query(
    "prp7_standardize",
    ("split",),
    "SELECT filing_id, part, "
    + ", ".join(
        f"round(({n} - (SELECT avg({n}) FROM split WHERE part = 'train')) / "
        f"(SELECT CASE WHEN min({n}) < max({n}) THEN stddev_pop({n}) ELSE 1 END "
        f"FROM split WHERE part = 'train'), 6) AS {n}"
        for n in NAMES[:4]
    )
    + " FROM split",
)
def _(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    train, test, _ = pp.standardize(train, test, NAMES[:4])
    x = vector_to_array("features")
    return r6(
        train.unionByName(test).select(
            "filing_id", "part", *[x[i].alias(n) for i, n in enumerate(NAMES[:4])]
        )
    )


@query(
    "prp8_fold_count",
    ("complete",),
    """SELECT greatest(2, least(5, min(n) // 2))::int AS folds
    FROM (SELECT target, count(*) AS n FROM complete GROUP BY 1)""",
)
def _(spark, sf_dir):
    return pp.fold_count(pp.class_counts(pp.complete_rows(v.features(spark, sf_dir))))


@query(
    "prp9_assign_folds",
    ("complete",),
    f"""SELECT r.filing_id, r.target, ((r.rk - 1 + o.off) % 5)::int AS fold
    FROM ({ranked_sql('complete', 'target', 'filing_id')}) r JOIN (
      SELECT target, sum(n) OVER (ORDER BY target) - n AS off
      FROM (SELECT target, count(*) AS n FROM complete GROUP BY 1)) o USING (target)""",
)
def _(spark, sf_dir):
    rows = _complete(spark, sf_dir).select("filing_id", "target")
    return pp.assign_folds(rows, "target", KEY, 5)


define(
    "event_units",
    ("complete",),
    """SELECT ticker, report_date, arg_min(target, target - 10 * n) AS class, sum(n) AS size
    FROM (SELECT ticker, report_date, target, count(*) AS n FROM complete GROUP BY ALL) GROUP BY 1, 2""",
)


@query(
    "prp9_group_folds",
    ("complete", "event_units"),
    """SELECT filing_id, target, ((CASE WHEN place // 5 % 2 = 0 THEN place % 5 ELSE 4 - place % 5 END + start) % 5)::int AS fold
    FROM complete JOIN (SELECT *, row_number() OVER (PARTITION BY class
      ORDER BY size DESC, md5('42:' || ticker || ':' || report_date), ticker, report_date) - 1 AS place FROM event_units)
      USING (ticker, report_date)
    JOIN (SELECT class, sum(count(*)) OVER (ORDER BY class) - count(*) AS start FROM event_units GROUP BY class)
      USING (class)""",
)
def _(spark, sf_dir):
    """Folds that keep the filings of an event together."""
    rows = _complete(spark, sf_dir).select("filing_id", "target", "ticker", "report_date")
    dealt = pp.assign_folds(rows, "target", KEY, 5, group_cols=["ticker", "report_date"])
    return dealt.select("filing_id", "target", "fold")


@query(
    "prp10_label_codes",
    ("preds",),
    """SELECT doc_id, "true" AS label, ("true" + 1)::double AS code, "true"::int AS back FROM preds""",
)
def _(spark, sf_dir):
    rows = v.preds(spark, sf_dir).withColumn("code", encode_label("true"))
    return rows.select(
        "doc_id", F.col("true").alias("label"), "code", decode_label("code").alias("back")
    )


# ---- metrics ---------------------------------------------------------------------


PICKS = ["pick_42", "pick_7"]


def _stacked(spark, sf_dir):
    return rp.stack_predictions(
        {"pick_42": v.preds(spark, sf_dir), "pick_7": v.preds(spark, sf_dir, 7)}
    )


@query("mdl1_random_baseline", ("preds",), 'SELECT doc_id, "true", pred FROM preds')
def _(spark, sf_dir):
    return v.preds(spark, sf_dir)


@query(
    "evl1_accuracy",
    ("preds",),
    'SELECT round(avg(("true" = pred)::int), 6) AS accuracy FROM preds',
)
def _(spark, sf_dir):
    return r6(el.accuracy(v.preds(spark, sf_dir)))


define(
    "per_class",
    ("preds",),
    """SELECT c, p, r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f, support FROM (
    SELECT c, coalesce(sum(("true" = c AND pred = c)::int) / nullif(sum((pred = c)::int), 0), 0) AS p,
    coalesce(sum(("true" = c AND pred = c)::int) / nullif(sum(("true" = c)::int), 0), 0) AS r,
    sum(("true" = c)::int)::bigint AS support FROM preds,
    (SELECT DISTINCT "true" AS c FROM preds UNION SELECT DISTINCT pred FROM preds) GROUP BY c)""",
)


@query(
    "evl2_classification_report",
    ("per_class",),
    """SELECT c::varchar AS label, round(p, 6) AS precision, round(r, 6) AS recall,
    round(f, 6) AS f1, support FROM per_class
    UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT round(avg(("true" = pred)::int), 6) FROM preds),
    sum(support)::bigint FROM per_class
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
    sum(support)::bigint FROM per_class
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
    round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
    sum(support)::bigint FROM per_class""",
)
def _(spark, sf_dir):
    return r6(el.classification_report(v.preds(spark, sf_dir)))


CONFUSION_SQL = """SELECT 'True_' || n AS label,
(SELECT count(*) FROM preds WHERE "true" = c AND pred = -1)::bigint AS "Pred_Down",
(SELECT count(*) FROM preds WHERE "true" = c AND pred = 0)::bigint AS "Pred_Stable",
(SELECT count(*) FROM preds WHERE "true" = c AND pred = 1)::bigint AS "Pred_Up"
FROM (VALUES (-1, 'Down'), (0, 'Stable'), (1, 'Up')) x(c, n)"""
define("confusion", ("preds",), CONFUSION_SQL)


@query("evl3_confusion_matrix", ("confusion",), "SELECT * FROM confusion")
def _(spark, sf_dir):
    return el.confusion_matrix(v.preds(spark, sf_dir))


define(
    "classes",
    ("preds",),
    """SELECT x, row_number() OVER (ORDER BY x) - 1 AS i
    FROM (SELECT "true" AS x FROM preds UNION SELECT pred FROM preds)""",
)


@query(
    "evl3_confusion_cells",
    ("classes",),
    """SELECT "true", pred, r.i::bigint AS "row", k.i::bigint AS "column", n,
    round(n / sum(n) OVER (PARTITION BY "true"), 6) AS share
    FROM (SELECT "true", pred, count(*)::bigint AS n FROM preds GROUP BY 1, 2)
    JOIN classes r ON "true" = r.x JOIN classes k ON pred = k.x""",
)
def _(spark, sf_dir):
    return r6(confusion_cells(v.preds(spark, sf_dir)))


@query(
    "evl4_predictions",
    ("preds",),
    'SELECT doc_id, "true", pred FROM preds',
)
def _(spark, sf_dir):
    """Predicted codes turned back into classes."""
    coded = v.preds(spark, sf_dir).select(
        "doc_id", F.col("true").alias("target"), encode_label("pred").alias("prediction")
    )
    return el.predictions(coded, ["doc_id"])


COMPARE_SQL = 'SELECT model, round(avg(("true" = pred)::int), 6) AS accuracy FROM stacked GROUP BY 1'


@query("evl8_compare", ("stacked",), COMPARE_SQL)
def _(spark, sf_dir):
    return r6(el.compare(_stacked(spark, sf_dir)))


@query(
    "evl9_best_model",
    ("stacked",),
    f"SELECT * FROM ({COMPARE_SQL}) WHERE accuracy = (SELECT max(accuracy) FROM ({COMPARE_SQL}))",
)
def _(spark, sf_dir):
    return r6(el.best_model(el.compare(_stacked(spark, sf_dir)))).select("model", "accuracy")


# ---- report tables ---------------------------------------------------------------


@query("rpt1_stack_predictions", ("stacked",), 'SELECT doc_id, "true", pred, model FROM stacked')
def _(spark, sf_dir):
    return _stacked(spark, sf_dir)


BY_CLASS_SQL = """SELECT "true",
round(avg(CASE WHEN model = 'pick_42' THEN ("true" = pred)::int END), 6) AS pick_42,
round(avg(CASE WHEN model = 'pick_7' THEN ("true" = pred)::int END), 6) AS pick_7
FROM stacked GROUP BY 1"""


@query("rpt2_accuracy_by_class", ("stacked",), BY_CLASS_SQL)
def _(spark, sf_dir):
    return r6(rp.accuracy_by_class(_stacked(spark, sf_dir), PICKS))


@query(
    "rpt2_accuracy_cells",
    ("stacked",),
    """SELECT "true", model, round(avg(("true" = pred)::int), 6) AS accuracy FROM stacked GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return r6(accuracy_cells(_stacked(spark, sf_dir)))


@query(
    "rpt3_class_name",
    (),
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Down' WHEN doc_id % 4 = 1 THEN 'Stable'
    WHEN doc_id % 4 = 2 THEN 'Up' ELSE '2' END AS name FROM documents""",
)
def _(spark, sf_dir):
    code = (F.col("doc_id") % 4 - 1).cast("int")
    return v.table(spark, sf_dir, "documents").select("doc_id", class_name(code).alias("name"))


@query(
    "rpt4_accuracy_vs_baseline",
    ("stacked",),
    f"""SELECT CASE "true" WHEN -1 THEN 'Down' WHEN 0 THEN 'Stable' ELSE 'Up' END AS class, model,
    round(accuracy, 6) AS accuracy FROM (
    SELECT "true", unnest(['pick_42', 'pick_7', 'Random Baseline (Expected)']) AS model,
    unnest([pick_42, pick_7, 1.0::double / 3]) AS accuracy FROM ({BY_CLASS_SQL}))""",
)
def _(spark, sf_dir):
    return r6(rp.accuracy_vs_baseline(rp.accuracy_by_class(_stacked(spark, sf_dir), PICKS)))


define(
    "quartiles",
    ("tone",),
    """SELECT ticker, quantile_cont(sentiment_score, 0.25) AS q1,
    quantile_cont(sentiment_score, 0.5) AS q2, quantile_cont(sentiment_score, 0.75) AS q3
    FROM tone GROUP BY 1""",
)
define(
    "fenced",
    ("tone", "quartiles"),
    """SELECT *, sentiment_score BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1) AS near
    FROM tone JOIN quartiles USING (ticker)""",
)


@query(
    "rpt5_box_stats",
    ("fenced",),
    """SELECT ticker, round(q1, 6) AS q25, round(q2, 6) AS median, round(q3, 6) AS q75,
    round(least(q1, min(sentiment_score) FILTER (WHERE near)), 6) AS whisker_low,
    round(greatest(q3, max(sentiment_score) FILTER (WHERE near)), 6) AS whisker_high,
    count(*)::bigint AS n, count(*) FILTER (WHERE NOT near)::bigint AS n_outliers
    FROM fenced GROUP BY ticker, q1, q2, q3""",
)
def _(spark, sf_dir):
    return r6(rp.box_stats(v.tone(spark, sf_dir), "ticker", "sentiment_score")[0])


@query(
    "rpt5_box_outliers",
    ("fenced",),
    """SELECT ticker, round(sentiment_score, 6) AS sentiment_score, count(*)::bigint AS n
    FROM fenced WHERE NOT near GROUP BY ticker, sentiment_score""",
)
def _(spark, sf_dir):
    return r6(rp.box_stats(v.tone(spark, sf_dir), "ticker", "sentiment_score")[1])


define(
    "weights",
    ("tone",),
    """SELECT ticker AS feature, target AS class, model, v FROM (
    SELECT ticker, -1 AS target, 'negative' AS model, avg((sentiment = 'negative')::int) AS v FROM tone GROUP BY 1
    UNION ALL SELECT ticker, 0, 'neutral', avg((sentiment = 'neutral')::int) FROM tone GROUP BY 1
    UNION ALL SELECT ticker, 1, 'positive', avg((sentiment = 'positive')::int) FROM tone GROUP BY 1)""",
)


def _weights(spark, sf_dir):
    """Share of each tone class per ticker, shaped like feature weights per class."""
    kinds = list(enumerate(("negative", "neutral", "positive"), start=-1))
    shares = v.tone(spark, sf_dir).groupBy(F.col("ticker").alias("feature")).agg(
        *[F.avg((F.col("sentiment") == k).cast("double")).alias(k) for _, k in kinds]
    )
    one = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(k).alias("model"), F.col(k).alias("v")) for c, k in kinds])
    return shares.select("feature", F.explode(one).alias("x")).select("feature", "x.*")


@query(
    "rpt6_rank_coefficients",
    ("weights",),
    "SELECT class, feature, round(v, 6) AS coefficient FROM weights ORDER BY class, v DESC",
)
def _(spark, sf_dir):
    rows = _weights(spark, sf_dir).select("class", "feature", F.col("v").alias("coefficient"))
    return r6(rp.rank_coefficients(rows))


@query(
    "rpt7_rank_importances",
    ("weights",),
    "SELECT model, feature, round(v, 6) AS importance FROM weights ORDER BY model, v DESC",
)
def _(spark, sf_dir):
    rows = _weights(spark, sf_dir).select("model", "feature", F.col("v").alias("importance"))
    return r6(rp.rank_importances(rows))


@query("rpt8_merge_comparisons", ("stacked",), COMPARE_SQL)
def _(spark, sf_dir):
    each = [el.compare(_stacked(spark, sf_dir).where(F.col("model") == n)) for n in ("pick_42", "pick_7")]
    return r6(rp.merge_comparisons(*each))


@query(
    "rpt9_confusion_long",
    ("confusion",),
    """SELECT 'Pick 42' AS title, label, predicted, n::double AS n FROM confusion
    UNPIVOT (n FOR predicted IN ("Pred_Down", "Pred_Stable", "Pred_Up"))""",
)
def _(spark, sf_dir):
    matrix = el.confusion_matrix(v.preds(spark, sf_dir)).withColumn("model", F.lit("pick_42"))
    return rp.confusion_long(matrix)


# ---- checks ----------------------------------------------------------------------


def _outside(column, low, high):
    return f"sum(CASE WHEN {column} BETWEEN {low} AND {high} THEN 0 ELSE 1 END)"


def checks_sql(rows: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", ({expr})::bigint AS violations, ({expr}) = 0 AS passed FROM {source}"
        for name, expr in rows
    )


@query(
    "chk1_in_range",
    ("features",),
    checks_sql(
        [
            ("sentiment_score within [-1, 1]", _outside("sentiment_score", -1, 1)),
            ("return_1d within [-50, 50]", _outside("return_1d", -50, 50)),
        ],
        "features",
    ),
)
def _(spark, sf_dir):
    rows = v.features(spark, sf_dir)
    return ck.run_checks(
        rows, [ck.in_range(rows, "sentiment_score", -1, 1), ck.in_range(rows, "return_1d", -50, 50)]
    )


@query(
    "chk2_not_empty",
    ("features",),
    checks_sql(
        [("not empty", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END"), ("columns ticker, target", "0 * count(*)")],
        "features",
    ),
)
def _(spark, sf_dir):
    rows = v.features(spark, sf_dir)
    return ck.run_checks(rows, [ck.not_empty(rows), ck.has_columns(rows, ["ticker", "target"])])


@query(
    "chk3_classes_equal",
    ("features",),
    checks_sql(
        [
            (
                "target classes",
                "3 - count(DISTINCT CASE WHEN target IN (-1, 0, 1) THEN target END) "
                "+ sum(CASE WHEN target IN (-1, 0, 1) THEN 0 ELSE 1 END)",
            )
        ],
        "features",
    ),
)
def _(spark, sf_dir):
    rows = v.features(spark, sf_dir)
    return ck.run_checks(rows, [ck.classes_equal(rows, "target", [-1, 0, 1])])


@query(
    "chk4_indicator_columns",
    ("indicators",),
    """SELECT ticker, count(*)::bigint AS n, count(rsi)::bigint AS n_rsi, count(ma5)::bigint AS n_ma5,
    count(daily_return)::bigint AS n_daily_return FROM indicators GROUP BY 1""",
)
def _(spark, sf_dir):
    from workload.study import _indicators

    return ck.group_sizes(_indicators(spark, sf_dir), "ticker", ["rsi", "ma5", "daily_return"])


@query(
    "chk5_at_least",
    ("weights",),
    checks_sql(
        [
            ("v at least 0", "sum(CASE WHEN v >= 0 THEN 0 ELSE 1 END)"),
            ("not empty", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END"),
        ],
        "weights",
    ),
)
def _(spark, sf_dir):
    rows = _weights(spark, sf_dir)
    return ck.run_checks(rows, [ck.at_least(rows, "v", 0), ck.not_empty(rows)])


@query(
    "chk6_square_counts",
    ("confusion",),
    checks_sql(
        [
            ("square", "abs(count(*) - 3)"),
            (
                "no negative cell",
                'sum(CASE WHEN least("Pred_Down", "Pred_Stable", "Pred_Up") >= 0 THEN 0 ELSE 1 END)',
            ),
        ],
        "confusion",
    ),
)
def _(spark, sf_dir):
    matrix = el.confusion_matrix(v.preds(spark, sf_dir))
    return ck.run_checks(matrix, ck.square_counts(matrix))


# ---- fitted models: what SQL can say of them -------------------------------------

SHARE = """(SELECT CASE WHEN min(n) < 10 THEN 0.5::double ELSE 0.3::double END
FROM (SELECT count(*) AS n FROM hot GROUP BY target))"""
define("study_split", ("hot",), split_sql("hot", "target", "filing_id", SHARE))
define("test_rows", ("study_split",), "SELECT filing_id, target FROM study_split WHERE part = 'test'")
define("train_rows", ("study_split",), "SELECT filing_id, target FROM study_split WHERE part = 'train'")
FEATURE_ROWS = "(VALUES " + ", ".join(f"('{n}')" for n in NAMES) + ") x(feature)"
MODELS = ("Logistic Regression", "Random Forest", "AdaBoost", "Boosted Trees", "FFNN")
MODEL_ROWS = "(VALUES " + ", ".join(f"('{n}')" for n in MODELS) + ") x(model)"


def _ready(spark, sf_dir):
    return prepare(v.features(spark, sf_dir))


def _scored(model, ready):
    return el.predictions(model.transform(ready.test), KEY, classes=ready.classes)


def _valid(pred):
    return F.coalesce(pred.isin(-1, 0, 1), F.lit(False)).alias("valid")


def _models(ready) -> dict:
    """All five models at the smallest sizes that are searched over, the logistic one searched."""
    estimators = (
        (m.logistic(ready.train_rows), m.LOGISTIC_GRID),
        (m.random_forest(50, 10), None),
        (m.adaboost(50), None),
        (m.boosted_trees(maxIter=50, maxDepth=3, stepSize=0.1), None),
        (m.network(len(ready.names), len(ready.classes)), None),
    )
    return dict(zip(MODELS, estimators))


@query(
    "mdl2_grid_search",
    ("train_rows",),
    """SELECT (i - 1)::int AS point, round(1 / (c * n * (k - 1) / k), 9) AS penalty, true AS valid
    FROM (VALUES (1, 0.01::double), (2, 0.1::double), (3, 1.0::double), (4, 10.0::double), (5, 100.0::double)) p(i, c),
    (SELECT sum(n)::double AS n, greatest(2, least(5, min(n) // 2))::double AS k
     FROM (SELECT count(*) AS n FROM train_rows GROUP BY target))""",
)
def _(spark, sf_dir):
    """All points of the search for the penalty, with a fold accuracy each."""
    ready = _ready(spark, sf_dir)
    axes = m.logistic_axes(ready.train_rows, ready.folds)
    found = m.grid_search(m.logistic(ready.train_rows), axes, ready.train, "fold", ready.folds)
    penalty = F.regexp_extract("params", "=(.*)$", 1).cast("double")
    return m.search_table(spark, found).select(
        "point", F.round(penalty, 9).alias("penalty"), F.col("accuracy").between(0, 1).alias("valid")
    )


@query(
    "mdl3_evl6_logistic",
    (),
    f"SELECT class, feature, 0.0::double AS gradient FROM (VALUES (-1), (0), (1)) c(class), {FEATURE_ROWS}",
)
def _(spark, sf_dir):
    """The slope of the loss at the fitted coefficients, which is none at its least."""
    ready = _ready(spark, sf_dir)
    fitted = m.logistic(ready.train_rows).fit(ready.train)
    penalty = fitted.getOrDefault(fitted.regParam)
    table = m.coefficients(spark, fitted, ready.names, ready.classes).collect()
    x, p = vector_to_array("features"), vector_to_array("probability")
    size = len(ready.names)
    code = {c: i for i, c in enumerate(ready.classes)}
    slopes = fitted.transform(ready.train).agg(
        *[
            F.avg((p[code[r["class"]]] - (F.col("label") == code[r["class"]]).cast("double")) * x[i % size]).alias(f"g{i}")
            for i, r in enumerate(table)
        ]
    ).first()
    rows = [(r["class"], r["feature"], float(s + penalty * r["coefficient"])) for r, s in zip(table, slopes)]
    out = spark.createDataFrame(rows, "class int, feature string, gradient double")
    return out.withColumn("gradient", F.abs(F.round("gradient", 2)))


@query(
    "mdl4_evl7_random_forest",
    (),
    f"SELECT feature, true AS valid FROM {FEATURE_ROWS} UNION ALL SELECT 'all', true",
)
def _(spark, sf_dir):
    """Importances are shares, and add up to one."""
    ready = _ready(spark, sf_dir)
    shares = m.importances(spark, m.random_forest(50, 10).fit(ready.train), ready.names)
    each = shares.select("feature", F.col("importance").between(0, 1).alias("valid"))
    total = shares.agg((F.round(F.sum("importance"), 6) == 1).alias("valid"))
    return each.unionByName(total.select(F.lit("all").alias("feature"), "valid"))


PREDICTED_SQL = 'SELECT filing_id, target AS "true", true AS valid FROM test_rows'


@query("mdl5_adaboost", ("test_rows",), PREDICTED_SQL)
def _(spark, sf_dir):
    ready = _ready(spark, sf_dir)
    return _scored(m.adaboost(50).fit(ready.train), ready).select(*KEY, "true", _valid(F.col("pred")))


@query("mdl6_boosted_trees", ("test_rows",), PREDICTED_SQL)
def _(spark, sf_dir):
    ready = _ready(spark, sf_dir)
    fitted = m.boosted_trees(maxIter=50, maxDepth=3, stepSize=0.1).fit(ready.train)
    return _scored(fitted, ready).select(*KEY, "true", _valid(F.col("pred")))


@query("mdl7_evl5_network", ("test_rows",), "SELECT filing_id, 1.0::double AS total, true AS valid FROM test_rows")
def _(spark, sf_dir):
    """Probabilities of each test row add up to one."""
    ready = _ready(spark, sf_dir)
    fitted = m.network(len(ready.names), len(ready.classes)).fit(ready.train)
    table = el.probabilities(fitted.transform(ready.test), KEY, ready.classes)
    total = sum((F.col(c) for c in table.columns if c.startswith("Prob_")), F.lit(0.0))
    return table.select(*KEY, F.round(total, 6).alias("total"), _valid(F.col("pred")))


@query("mdl8_training_history", (), "SELECT true AS falls, true AS counted")
def _(spark, sf_dir):
    """The loss never rises from step to step, and steps are numbered from 0."""
    ready = _ready(spark, sf_dir)
    steps = m.training_history(spark, m.network(len(ready.names), len(ready.classes)).fit(ready.train))
    losses = F.transform(F.array_sort(F.collect_list(F.struct("step", "loss"))), lambda s: s["loss"])
    return steps.agg(losses.alias("l"), F.max("step").alias("last"), F.count(F.lit(1)).alias("n")).select(
        F.forall(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.get("l", i) <= F.get("l", i - 1)).alias("falls"),
        (F.col("last") == F.col("n") - 1).alias("counted"),
    )


# ---- fitted models: their own results, which SQL cannot compute ---------------------


@query("mdl2_adaboost_search")
def _(spark, sf_dir):
    """All nine points over rounds and rates, with their accuracy on each fold."""
    ready = _ready(spark, sf_dir)
    found, best, _ = m.search(m.adaboost(), m.ADABOOST_GRID, ready.train, "fold", ready.folds, ready.train_rows)
    return m.point_table(spark, found, best)


@query("mdl2_forest_search")
def _(spark, sf_dir):
    """All 81 points over trees, depth, least rows of a split and of a leaf."""
    ready = _ready(spark, sf_dir)
    found, best, _ = m.search(m.random_forest(), m.FOREST_GRID, ready.train, "fold", ready.folds, ready.train_rows)
    return m.point_table(spark, found, best)


@query("mdl5_stumps")
def _(spark, sf_dir):
    """The stumps of 50 rounds: feature, threshold, classes and weight."""
    ready = _ready(spark, sf_dir)
    rows = m.adaboost(50).fit(ready.train).getStumps()
    at = [(i, ready.names[int(j)] if j >= 0 else None, t, int(a), int(b), w) for i, (j, t, a, b, w) in enumerate(rows)]
    return spark.createDataFrame(at, "round int, feature string, threshold double, at_most int, above int, weight double")


def _boosted(ready):
    return m.boosted_trees(maxIter=50, maxDepth=3, stepSize=0.1).fit(ready.train)


@query("mdl6_softmax_probabilities")
def _(spark, sf_dir):
    """Class probabilities of the three-class booster on the test rows."""
    ready = _ready(spark, sf_dir)
    return el.probabilities(_boosted(ready).transform(ready.test), KEY, ready.classes)


@query("mdl6_loss_falls", (), "SELECT i AS step, true AS falls FROM (SELECT unnest(range(0, 51))::int AS i)")
def _(spark, sf_dir):
    """The booster's loss starts at that of equal chances and falls in every round."""
    ready = _ready(spark, sf_dir)
    steps = m.training_history(spark, _boosted(ready))
    # One row per round.
    before = F.lag("loss").over(Window.partitionBy().orderBy("step"))
    first = F.abs(F.col("loss") - math.log(len(ready.classes))) < 1e-9
    return steps.select("step", F.when(before.isNull(), first).otherwise(F.col("loss") < before).alias("falls"))


@query("mdl7_evl5_network_probabilities")
def _(spark, sf_dir):
    ready = _ready(spark, sf_dir)
    fitted = m.network(len(ready.names), len(ready.classes)).fit(ready.train)
    return el.probabilities(fitted.transform(ready.test), KEY, ready.classes)


@query("mdl8_network_losses")
def _(spark, sf_dir):
    ready = _ready(spark, sf_dir)
    return m.training_history(spark, m.network(len(ready.names), len(ready.classes)).fit(ready.train))


@query("evl6_rpt6_ranked_coefficients")
def _(spark, sf_dir):
    """Coefficients of the fitted logistic model, ranked within a class."""
    ready = _ready(spark, sf_dir)
    table = m.coefficients(spark, m.logistic(ready.train_rows).fit(ready.train), ready.names, ready.classes)
    return rp.rank_coefficients(table)


@query("evl7_gains_by_node", (), f"SELECT feature, true AS same FROM {FEATURE_ROWS}")
def _(spark, sf_dir):
    """Importances of a forest summed from the gains of its nodes are those that it states."""
    ready = _ready(spark, sf_dir)
    model = m.random_forest(50, 10).fit(ready.train)
    nodes = node_table(spark, model)
    summed = materialised(gain_shares(nodes, ready.names))
    release(nodes)
    # Two features of one name: shares are compared by place.
    stated = [(name, float(v)) for name, v in zip(ready.names, model.featureImportances.toArray())]
    stated = spark.createDataFrame(stated, "feature string, stated double").groupBy("feature").agg(F.sum("stated").alias("stated"), F.count(F.lit(1)).alias("n"))
    both = summed.groupBy("feature").agg(F.sum("importance").alias("importance")).join(stated, "feature")
    both = both.select("feature", "n", (F.abs(F.col("importance") - F.col("stated")) < 1e-9).alias("same"))
    return both.select("feature", "same", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("col")


@query("evl7_rpt7_importances")
def _(spark, sf_dir):
    """Importances of the three tree models, ranked within a model."""
    ready = _ready(spark, sf_dir)
    fitted = {"Random Forest": m.random_forest(50, 10), "AdaBoost": m.adaboost(50), "Boosted Trees": m.boosted_trees(maxIter=50, maxDepth=3, stepSize=0.1)}
    out = None
    for name, estimator in fitted.items():
        part = m.importances(spark, estimator.fit(ready.train), ready.names).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rp.rank_importances(out)


@query("evl10_comparison")
def _(spark, sf_dir):
    """Accuracies of the baseline and the five models, the logistic one and AdaBoost searched."""
    ready = _ready(spark, sf_dir)
    models = _models(ready)
    models["AdaBoost"] = (m.adaboost(), m.ADABOOST_GRID)
    return run_classification(ready, models).comparison


@query(
    "evl10_run_classification",
    ("test_rows",),
    f"""SELECT model, NULL::double AS baseline, true AS valid FROM {MODEL_ROWS} UNION ALL
    SELECT 'Random Baseline', round(avg((target =
    (('0x' || substr(md5('42:' || filing_id), 1, 8))::bigint % 3 - 1)::int)::int), 6), true FROM test_rows""",
)
def _(spark, sf_dir):
    """Baseline and all five models on one split, compared."""
    ready = _ready(spark, sf_dir)
    table = run_classification(ready, _models(ready)).comparison
    return table.select(
        "model",
        F.when(F.col("model") == "Random Baseline", F.round("accuracy", 6)).alias("baseline"),
        F.col("accuracy").between(0, 1).alias("valid"),
    )


@query(
    "snk6_chk7_model_round_trip",
    ("test_rows",),
    f"SELECT model, filing_id, true AS same FROM test_rows, {MODEL_ROWS}",
)
def _(spark, sf_dir):
    """Scaler, label map and every model saved, loaded and applied to the unscaled rows."""
    ready = _ready(spark, sf_dir)
    fitted = {name: estimator.fit(ready.train) for name, (estimator, _) in _models(ready).items()}
    path = fresh(spark, "model")
    writers.save_run(spark, fitted, ready.scaler, ready.classes, path)
    loaded, classes = writers.load_run(spark, list(fitted), path)
    out = None
    for name, model in fitted.items():
        again = el.predictions(loaded[name].transform(ready.raw_test), KEY, classes=classes)
        both = _scored(model, ready).join(again.select(*KEY, F.col("pred").alias("again")), KEY)
        part = both.select(F.lit(name).alias("model"), *KEY, F.col("pred").eqNullSafe(F.col("again")).alias("same"))
        out = part if out is None else out.unionByName(part)
    return out


@query("src7_snk4_result_files", ("confusion",), """SELECT 'pick_42' AS model, label, "Pred_Down"::double AS "Pred_Down",
"Pred_Stable"::double AS "Pred_Stable", "Pred_Up"::double AS "Pred_Up" FROM confusion""")
def _(spark, sf_dir):
    """Metric tables written under their model's name and read back by kind."""
    root = fresh(spark, "results")
    writers.write_result(el.confusion_matrix(v.preds(spark, sf_dir)), root, "Pick 42", "confusion")
    return readers.read_results(spark, root, "confusion").drop("path")


@query(
    "src7_missing_class",
    ("preds",),
    """SELECT label, (SELECT count(*) FROM preds WHERE "true" = c AND pred = -1)::double AS "Pred_Down",
    0.0::double AS "Pred_Stable",
    (SELECT count(*) FROM preds WHERE "true" = c AND pred = 1)::double AS "Pred_Up"
    FROM (VALUES (-1, 'True_Down'), (1, 'True_Up')) x(c, label)""",
)
def _(spark, sf_dir):
    """A table of two classes is read back by the names in its header."""
    root = fresh(spark, "results")
    two = v.preds(spark, sf_dir).where((F.col("true") != 0) & (F.col("pred") != 0))
    writers.write_result(el.confusion_matrix(two, [-1, 1]), root, "Two", "confusion")
    return readers.read_results(spark, root, "confusion").drop("path", "model")


@query(
    "snk5_report_file",
    ("per_class",),
    """SELECT c::varchar AS label, round(p, 6) AS precision, round(r, 6) AS recall,
    round(f, 6) AS f1, support FROM per_class""",
)
def _(spark, sf_dir):
    """Per-class rows of the report written as JSON and read back."""
    path = fresh(spark, "report")
    writers.write_report(el.classification_report(v.preds(spark, sf_dir)), path)
    schema = "label string, precision double, recall double, f1 double, support long"
    back = spark.read.schema(schema).json(path)
    return r6(back.where(F.col("label").rlike(r"^-?\d+$")))
