"""Language: multinomial naive Bayes over hashed character n-grams.

Grams are one to three characters of a word in lower case, its edges marked; whatever
is no letter is an edge.  Every task sums the grams of its rows by language and bucket,
the sums of a block of buckets meet in one task, and the matrix of log probabilities,
bounded in cells, goes to all tasks.  A text is scored from its distinct buckets and
their counts, in pieces of bounded size however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tonetape.llm import words as W
from tonetape.llm.calibration import held_out
from tonetape.llm.common import slices

SLICE = 2 << 20
#: Bytes of text looked at in one step, which bounds the memory of a very long one.
PIECE = 1 << 19
#: Buckets of the hash, and a bound on languages times buckets: more than 64 languages share fewer.
BUCKETS, MOST_CELLS, LEAST_BUCKETS = 1 << 16, 1 << 22, 1 << 10
#: Buckets whose sums travel together, and the pseudo-count of each bucket.
BLOCK, SMOOTH = 1 << 10, 0.5
GRAMS = 3
UNKNOWN = "und"
EDGE = 32


@lru_cache(maxsize=1)
def characters() -> np.ndarray:
    """The lower case of every letter, and EDGE for every other code point."""
    points = map(chr, range(0x110000))
    return np.fromiter((ord(c.lower()[0]) if c.isalpha() else EDGE for c in points), np.uint32, 0x110000)


def code_points(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points whose UTF-8 begins at the places in flat (padded by three bytes)."""
    b0 = flat[at].astype(np.uint32)
    b1, b2, b3 = ((flat[at + k] & 0x3F).astype(np.uint32) for k in (1, 2, 3))
    two, three = (b0 & 0x1F) << 6 | b1, (b0 & 0x0F) << 12 | b1 << 6 | b2
    four = np.minimum((b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3, 0x10FFFF)
    return np.where(b0 < 0x80, b0, np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four)))


def grams(texts: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts (as places) and buckets of all grams of texts, piece by piece, in order of the texts."""
    flat, begin = W.joined(texts)
    if not len(flat):
        return
    shift, table = W.U(64 - (buckets.bit_length() - 1)), characters()
    # The characters before the piece that its first grams reach back to.
    tail, tail_doc = np.full(GRAMS - 1, EDGE, np.uint32), np.full(GRAMS - 1, -1)
    for low in range(0, len(flat), PIECE):
        piece = flat[low : low + PIECE + 3]
        piece = np.append(piece, np.zeros(PIECE + 3 - len(piece), np.uint8)) if len(piece) < PIECE + 3 else piece
        at = np.flatnonzero((piece[: min(PIECE, len(flat) - low)] & 0xC0) != 0x80)
        code = table[code_points(piece, at)]
        # Edges in a row count as one; the first of them belongs to the text that it ends.
        stay = (code != EDGE) | (np.append(tail[-1], code[:-1]) != EDGE) if len(code) else np.zeros(0, bool)
        code = np.append(tail, code[stay])
        doc = np.append(tail_doc, np.searchsorted(begin, at[stay] + low, side="right") - 1)
        letter, wide = code != EDGE, code.astype(W.U)
        found, owner = [], []
        for n in range(1, GRAMS + 1):
            last = np.arange(GRAMS - 1, len(code))
            # An edge may begin or end a gram of several characters, not stand inside.
            ok = letter[last] if n == 1 else letter[last - 1] if n == 3 else letter[last] | letter[last - 1]
            last = last[ok]
            key = wide[last]
            for k in range(1, n):
                key = key | wide[last - k] << W.U(21 * k)
            found.append((W.mixed(key, 16 + n) >> shift).astype(np.int64))
            owner.append(doc[last])
        tail, tail_doc = code[len(code) - GRAMS + 1 :], doc[len(doc) - GRAMS + 1 :]
        yield np.concatenate(owner), np.concatenate(found)


def sparse(texts: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, columns and values of the matrix of texts by buckets, in pieces that add up to it."""
    for doc, bucket in grams(texts, buckets):
        if len(doc):
            cell, count = np.unique(doc * buckets + bucket, return_counts=True)
            yield cell // buckets, cell % buckets, count


def likelihoods(texts: pa.Array, log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each text in each language (log_p: buckets by languages), and its number of grams."""
    out, size = np.zeros((len(texts), log_p.shape[1])), np.zeros(len(texts))
    step = max(1, MOST_CELLS // (4 * max(log_p.shape[1], 1)))
    for whole in sparse(texts, len(log_p)):
        for low in range(0, len(whole[0]), step):
            row, column, count = (x[low : low + step] for x in whole)
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            out[row[first]] += np.add.reduceat(log_p[column] * count[:, None], first)
            size[row[first]] += np.add.reduceat(count, first)
    return out, size


def buckets_for(languages: int) -> int:
    """The buckets that languages can have within MOST_CELLS, a power of two."""
    buckets = BUCKETS
    while buckets * languages > MOST_CELLS:
        buckets //= 2
    if buckets < LEAST_BUCKETS:
        raise ValueError(f"{languages} languages are more than the {MOST_CELLS // LEAST_BUCKETS} that a matrix of {MOST_CELLS} cells serves")
    return buckets


def count_grams(train: DataFrame, languages: list[str], buckets: int) -> np.ndarray:
    """Grams by language and bucket over all rows of train (text, lang)."""
    place = {name: i for i, name in enumerate(languages)}
    block = min(BLOCK, buckets)

    def batch(rows: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        keys = np.array(list(rows), np.int32).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(list(rows.values()), pa.list_(pa.int64()))], names=["lang", "block", "n"])

    def partial(batches):
        sums = np.zeros((len(languages), buckets), np.int64)
        for rows in slices(batches, "text", SLICE):
            own = np.array([place[x] for x in rows.column("lang").to_pylist()])
            for row, column, count in sparse(rows.column("text"), buckets):
                sums += np.bincount(own[row] * buckets + column, count, sums.size).astype(np.int64).reshape(sums.shape)
        cut = sums.reshape(len(languages), -1, block)
        yield batch({(i, j): cut[i, j] for i, j in zip(*np.nonzero(cut.any(2)))})

    def total(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for rows in batches:
            for i, j, n in zip(rows.column("lang").to_pylist(), rows.column("block").to_pylist(), rows.column("n")):
                n = n.values.to_numpy()
                sums[i, j] = sums[i, j] + n if (i, j) in sums else n
        yield batch(sums)

    schema = "lang int, block int, n array<bigint>"
    got = train.select("lang", "text").mapInArrow(partial, schema).repartition("lang", "block").mapInArrow(total, schema)
    out = np.zeros((len(languages), buckets // block, block))
    for i, j, n in got.toLocalIterator():
        out[i, j] = n
    return out.reshape(len(languages), buckets)


def predict_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    fold: int = 2,
) -> DataFrame:
    """One row per row of docs: id, held_out, lang_pred, score (its posterior, 0 to 1).

    Learnt from the texts and languages of all rows whose id and language are not null
    and where crc32 of the id modulo folds is not fold; ids and languages are no inputs
    of a prediction.  The chance of a language before its text is seen is its share of
    the rows learnt from; ties go to the name that sorts first.

    A null text, and one without a letter, is `und` with score 0, and so is every text
    where nothing can be learnt.  A null id is not held out and not learnt from.  Rows
    that repeat are learnt from as often as they occur and predicted alike.  Whole texts
    are read, of any length.  An empty table gives an empty one.  Other columns are not
    read, whatever their names.  More than 4,096 languages are an error.
    """
    own = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    own = own.withColumn("held_out", held_out(F.col("id"), folds, fold))
    train = own.where("id IS NOT NULL AND lang IS NOT NULL AND NOT held_out")
    shares = train.groupBy("lang").count().orderBy("lang").limit(MOST_CELLS // LEAST_BUCKETS + 1).collect()
    languages = [r["lang"] for r in shares]
    buckets = buckets_for(max(len(languages), 1))
    counts = count_grams(train, languages, buckets) if languages else np.zeros((0, buckets))
    counts += SMOOTH
    rows = np.array([r["count"] for r in shares], float)
    # At most MOST_CELLS numbers, however many rows.
    model = own.sparkSession.sparkContext.broadcast(np.ascontiguousarray(np.log(counts / counts.sum(1, keepdims=True)).T))
    prior = np.log(rows / rows.sum()) if languages else rows

    def predict(batches):
        for batch in slices(batches, "text", SLICE):
            n = batch.num_rows
            if languages:
                log, size = likelihoods(batch.column("text"), model.value)
                log += prior
                best = log.argmax(1)
                score = 1 / np.exp(log - log[np.arange(n), best][:, None]).sum(1)
                known = size > 0
            else:
                best, score, known = np.zeros(n, int), np.zeros(n), np.zeros(n, bool)
            names = [languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            arrays = [batch.column("id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "held_out", "lang_pred", "score"])

    kind = own.schema["id"].dataType.simpleString()
    out = own.select("id", "held_out", "text").mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
