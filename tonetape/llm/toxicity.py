"""Toxicity: boosted trees over dense features of a whole text, calibrated.

The features are densities of two lexicons (a fixed list of insults, and beginnings
of words that the labelled rows show to go with label 1), how near those words stand
to words for "you", and rates of capitals, punctuation and disguised spelling.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from tonetape.llm import words as W
from tonetape.llm.calibration import calibrated, classes, constant, held_out, labelled, part
from tonetape.llm.common import column, frugal, slices, written, written_texts

SLICE = 1 << 20
#: Bounds: labelled rows that are learnt from, and entries of the learnt lexicon.
MOST_ROWS, MOST_TERMS = 24_000, 4_096
#: Bytes of a word's beginning that the learnt lexicon may hold; 0 is the whole word.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Words on either side within which a word for "you" counts as near.
NEAR = 5

# Plain insults, words for "you", and letters that signs stand in for.
INSULTS = """
idiot idiots stupid moron morons loser losers trash scum clown pathetic disgusting worthless
dumb fool fools garbage filth filthy vermin pig pigs jerk imbecile cretin freak ugly hate
shut scumbag dumbass bastard bitch crap shit fuck fucking asshole retard retarded
idiota estúpido estúpida imbécil basura asqueroso payaso perdedor
crétin connard salaud débile ordure minable
dummkopf trottel abschaum versager blödmann ekelhaft wertlos
""".split()
YOU = "you your yours yourself u ur du dich dir dein ihr euch euer tu te toi ton ta vous votre tú ti usted ustedes vosotros".split()
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"}

LETTERS = np.zeros(256, bool)
LETTERS[[*range(97, 123), *range(128, 256)]] = True
PLAIN = np.arange(256, dtype=np.uint8)
for _sign, _letter in DISGUISE.items():
    PLAIN[ord(_sign)] = ord(_letter)
CAPITAL = np.zeros(256, bool)
CAPITAL[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True

FEATURES = (
    "log_words",
    "insults",
    "any_insult",
    "learnt",
    "learnt_weight",
    "learnt_most",
    "you",
    "insult_near_you",
    "learnt_near_you",
    "capitals",
    "all_capitals",
    "punctuation",
    "exclamations",
    "questions",
    "disguised_insults",
    "mixed_words",
    "stretched",
    "digits",
)


def lower(flat: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the accented letters of Latin-1 in UTF-8."""
    out = W.LOWER[flat]
    after = np.append(False, flat[:-1] == 0xC3) & (flat >= 0x80) & (flat <= 0x9E) & (flat != 0x97)
    out[after] += 0x20
    return out


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edge[::2], edge[1::2]


def hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    flat = np.frombuffer(b" ".join(raw), np.uint8)
    end = np.cumsum([len(r) + 1 for r in raw]) - 1
    return np.sort(W.spans_hash(flat, end - [len(r) for r in raw], end))


def member(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of h in the sorted table, -1 where it is not there."""
    at = np.minimum(np.searchsorted(table, h), max(len(table) - 1, 0))
    return np.where(table[at] == h, at, -1) if len(table) else np.full(len(h), -1)


def beginnings(low: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where the letter runs of low begin; their hashes: whole, and those of each beginning that is shorter."""
    start, end = runs(LETTERS[low])
    ends = [np.minimum(start + k, end) for k in BEGINNINGS]
    got = W.spans_hash(low, start, end, *ends)
    whole = got[0]
    # Another salt for a beginning: "trash" the word is not "trash" that begins one.
    return start, [whole, *(np.where(e < end, W.mixed(h, 9), whole) for h, e in zip(got[1:], ends))]


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of each text, and the number of each text's."""
    flat, begin = W.joined(texts)
    start, got = beginnings(lower(flat))
    first = np.searchsorted(start, begin)
    each = [np.unique(np.concatenate([h[a:b] for h in got])) for a, b in zip(first[:-1], first[1:])]
    return np.concatenate(each) if each else np.zeros(0, W.U), np.array([len(x) for x in each], np.int64)


def features(texts: pa.Array, lexicon: np.ndarray, weight: np.ndarray, insults: np.ndarray, you: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; an empty text has zeros."""
    flat, begin = W.joined(texts)
    low = lower(flat)
    start, got = beginnings(low)
    first = np.searchsorted(start, begin)
    n = np.diff(first).astype(float)
    per_word = 1 / np.maximum(n, 1)
    at_words = lambda x: W.per_text(x, first)

    strongest = np.zeros(len(start))
    for h in got:
        at = member(h, lexicon)
        if len(lexicon):
            np.maximum(strongest, np.where(at >= 0, weight[at], 0), out=strongest)
    insult, second = member(got[0], insults) >= 0, member(got[0], you) >= 0
    learnt = strongest > 0

    place = np.flatnonzero(second)
    doc = np.searchsorted(first, np.arange(len(start)), side="right")
    def near(mask):
        at = np.flatnonzero(mask)
        out = np.zeros(len(start), bool)
        if len(place) and len(at):
            right = np.minimum(np.searchsorted(place, at), len(place) - 1)
            for side in (place[right], place[np.maximum(right - 1, 0)]):
                out[at] |= (np.abs(side - at) <= NEAR) & (doc[side] == doc[at])
        return out

    most = np.zeros(len(n))
    has = n > 0
    if has.any():
        most[has] = np.maximum.reduceat(strongest, first[:-1][has])

    # Disguised: what reads as an insult only once signs are letters again.
    word_start, word_end = W.words(flat)
    # A sign at the end of a word is punctuation.
    inside = np.append(LETTERS[low[1:]] | DIGIT[low[1:]], False)[: len(low)]
    read = np.where(DIGIT[low] | inside, PLAIN[low], low)
    hidden_start, hidden_end = runs(LETTERS[read])
    changed = np.append(0, np.cumsum(read != low))
    odd = changed[hidden_end] > changed[hidden_start]
    hidden = member(W.spans_hash(read, hidden_start[odd], hidden_end[odd]), insults) >= 0
    hidden_count = np.diff(np.searchsorted(hidden_start[odd][hidden], begin))
    letters = np.append(0, np.cumsum(LETTERS[low]))
    signs = np.append(0, np.cumsum(DIGIT[flat] | PUNCTUATION[flat]))
    inner = np.maximum(word_end - 1, word_start)
    mixed = (letters[word_end] > letters[word_start]) & (signs[inner] > signs[np.minimum(word_start + 1, inner)])
    capital = np.append(0, np.cumsum(CAPITAL[flat]))
    shouted = (word_end - word_start >= 3) & (capital[word_end] - capital[word_start] == word_end - word_start)
    word_first = np.searchsorted(word_start, begin)
    same = LETTERS[low[2:]] & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) if len(low) > 2 else np.zeros(0, bool)
    stretched = np.append(same, np.zeros(len(low) - len(same), bool))
    size = np.maximum(np.diff(begin) - 1, 1)
    per_byte = lambda x: W.per_text(x, begin) / size
    out = np.column_stack(
        [
            np.log1p(n),
            at_words(insult) * per_word,
            at_words(insult) > 0,
            at_words(learnt) * per_word,
            at_words(strongest) * per_word,
            most,
            at_words(second) * per_word,
            at_words(near(insult)) * per_word,
            at_words(near(learnt)) * per_word,
            per_byte(CAPITAL[flat]),
            W.per_text(shouted, word_first) * per_word,
            per_byte(PUNCTUATION[flat]),
            per_byte(flat == ord("!")),
            per_byte(flat == ord("?")),
            hidden_count * per_word,
            W.per_text(mixed, word_first) * per_word,
            per_byte(stretched),
            per_byte(DIGIT[flat]),
        ]
    )
    return out.astype(np.float64)


def learn_lexicon(train: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms that go with label 1 in train (id, text, label), by log odds of the texts that hold them."""

    def emit(batches):
        for rows in slices(batches, "text", SLICE):
            got, count = terms(rows.column("text"))
            label = np.repeat(rows.column("label").to_numpy(zero_copy_only=False), count)
            yield pa.RecordBatch.from_arrays([pa.array(got.view(np.int64)), pa.array(label, pa.int32())], names=["term", "label"])

    n, ones = classes(train)
    if not 0 < ones < n:
        return np.zeros(0, W.U), np.zeros(0)
    one, zero = F.col("one") + 0.5, F.col("n") - F.col("one") + 0.5
    odds = F.log(one / (ones + 1)) - F.log(zero / (n - ones + 1))
    found = (
        train.select("text", "label")
        .mapInArrow(frugal(emit), "term long, label int")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("one"))
        .where("one >= 3")
        .withColumn("weight", odds - 1.5 * F.sqrt(1 / one + 1 / zero))
        .where(F.col("weight") > math.log(2))
        .orderBy(F.desc("weight"), "term")
        .limit(most)
        .select("term", "weight")
        .toPandas()
    )
    term = found["term"].to_numpy(np.int64).view(W.U)
    order = np.argsort(term)
    return term[order], found["weight"].to_numpy(float)[order]


def scored(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str, folds: int, fold: int, most_rows: int, most_terms: int, carry: list[str]
) -> DataFrame:
    """id, score and predicted of every row of docs, and the columns in carry as c0, c1, ..."""
    carried = [column(docs, c).alias(f"c{i}") for i, c in enumerate(carry)]
    # A text that is carried is read where it is, and not sent a second time.
    held = text_col in carry and isinstance(docs.schema[text_col].dataType, T.StringType)
    read = f"c{carry.index(text_col)}" if held else "text"
    texts = [] if held else [column(docs, text_col).cast("string").alias("text")]
    own = docs.select(column(docs, id_col).alias("id"), *texts, *carried)
    # At most most_rows narrow rows: bounded, so they may be broadcast.
    sample = F.broadcast(labelled(labels, label, folds, fold, most_rows))
    train = own.join(sample, "id").groupBy("id").agg(F.max(F.coalesce(read, F.lit(""))).alias("text"), F.first("label").alias("label"))
    train = written(train.withColumn("part", part(F.col("id"), 4)), "train")
    n, ones = classes(train)
    if min(ones, n - ones) < 10:
        return constant(own.drop("text"), ones / n if n else 0.0)
    lexicon, weight = learn_lexicon(train.where("part = 0"), most_terms)
    insults, you = hashes(INSULTS), hashes(YOU)

    def measured(df: DataFrame, read: str = "text") -> DataFrame:
        """df with features of the column read; text is left out."""

        def measure(batches):
            for rows in slices(batches, read, SLICE):
                x = features(rows.column(read), lexicon, weight, insults, you)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in others), flat], names=[*others, "x"])

        others = [c for c in df.columns if c != "text"]
        return df.mapInArrow(frugal(measure), T.StructType([*(df.schema[c] for c in others), T.StructField("x", T.ArrayType(T.DoubleType()))]))

    vector = lambda df: df.withColumn("features", array_to_vector("x"))
    fit = vector(written(measured(train.where("part > 0")), "features"))
    trees_on, calibrate_on = fit.where("part < 3"), fit.where("part = 3")
    if any(min(b, a - b) < 1 for a, b in map(classes, (trees_on, calibrate_on))):
        return constant(own.drop("text"), ones / n)
    trees = GBTClassifier(labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3, seed=7, minInstancesPerNode=5).fit(trees_on)
    raw = lambda df: trees.transform(df).withColumn("raw", vector_to_array("probability")[1])
    return calibrated(raw(vector(measured(own, read))), raw(calibrate_on))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    folds: int = 5,
    fold: int = 0,
    most_rows: int = MOST_ROWS,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """One row per row of docs: id, held_out, score (0 to 1), predicted (score >= 0.5).

    labels (doc_id, label) are learnt from only where crc32 of the id modulo folds is
    not fold, from most_rows rows at most (those with the smallest hashes).  Three parts
    of them fit the lexicon, the trees, and the calibration.  Scores come from the text
    alone, all of it.

    A null or empty text is scored like any other, by features that are 0.  A null id
    has no label and is not held out.  Rows that repeat are scored alike; of labels that
    repeat the largest counts.  Without labels of both kinds every score is their share
    of ones (0 without any).  An empty table gives an empty one.  Other columns are not
    read, whatever their names.
    """
    out = scored(docs, labels, id_col, text_col, label, folds, fold, most_rows, most_terms, [])
    return out.select(F.col("id").alias(id_col), held_out(F.col("id"), folds, fold).alias("held_out"), "score", "predicted")


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    folds: int = 5,
    fold: int = 0,
    most_rows: int = MOST_ROWS,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """The rows of docs, all columns, that toxicity does not predict to be toxic.  They are not shuffled.

    Null and empty texts, null ids, repeated rows and missing labels are as in toxicity;
    rows that repeat stay or go together.  An empty table gives an empty one.  Columns
    may have any names."""
    out = scored(docs, labels, id_col, text_col, label, folds, fold, most_rows, most_terms, docs.columns)
    # Written here, whole rows go to Python and back TEXTS at a time, however the session has it.
    kept = written_texts(out.where("predicted = 0").select(*(f"c{i}" for i in range(len(docs.columns)))), "civil")
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
