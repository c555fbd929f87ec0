"""Removal of long strings that occur more than once, by winnowing and fingerprints.

This stands in for bucket-pointer refinement in rounds: nothing is sorted on bucket
identifiers, and no pointer reads one found for another.

The suffixes are sampled: of every window of LENGTH bytes, the q-gram with the smallest
hash is the window's pointer, so that equal windows have equal pointers at the same
offset.  Pointers are dealt into buckets by their q-gram, and a bucket with one pointer
is done: none of its windows can occur again.  The others are told apart.

1. By context: the run of windows that share a pointer, from the first's first byte to
   the last's last.  Pointers with equal contexts are equal in all their windows, and
   however many there are, one stands for them from here on.
2. By window: where a bucket holds several contexts, each window is named by mixing the
   hashes of its four parts of 50 bytes.  Windows with equal names are equal.

Names are hashes rather than ranks, so that no order over all is needed.  Strings count
as equal if two names, of 96 bits together, agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tonetape.llm import words as W
from tonetape.llm.common import discard, slices, written
from tonetape.llm.shared import blocks_for, packed, packed_schema, shared_entries

#: Bytes of the q-gram that makes a pointer's bucket, of the first names, and of a piece of text.
GRAM, STEP, PIECE = 64, 50, 1 << 20
#: Bytes up to which a table of documents' runs or spans is broadcast; beyond, the same join is shuffled.
BROADCAST_BYTES = 64 << 20
ANCHORS = {"bucket": "long", "context": "long", "k1": "long", "k2": "long", "lo": "int", "hi": "int"}
WINDOWS = {"name": "long", "check": "int", "context": "long", "at": "int"}


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text as bytes, k1, k2); the keys tell rows apart that differ in id or text."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    own = docs.select(docs[id_col].alias("id"), text.alias("text"))
    return own.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(17), "id", "text")})


def parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more for the end)."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(texts: pa.Array, length: int, extra: int, piece: int):
    """(bytes, where texts begin in them, number of the first text, first window and end of the windows of the piece).

    A long text comes in pieces that overlap by extra bytes; the others together."""
    flat, begin = parts(texts)
    if len(flat) <= 2 * piece:
        yield flat, begin, 0, 0, len(flat)
        return
    for k in range(len(begin) - 1):
        for s in range(0, max(1, begin[k + 1] - begin[k] - length + 1), piece):
            own = flat[begin[k] + s : min(begin[k + 1], begin[k] + s + piece + extra)]
            yield own, np.array([0, len(own)]), k, s, s + piece


_draw = np.random.default_rng(20240301)
#: The numbers of the bytes and the base of two hashes that have nothing in common.
TABLES = [(W.LETTER, W.BASE), (_draw.integers(1, 1 << 63, 256, dtype=W.U) * W.U(2) + W.U(1), int(_draw.integers(1 << 61, 1 << 62)) * 2 + 1)]


class Spans:
    """Hashes of any spans of data, by the first or second table."""

    def __init__(self, data: np.ndarray, table: int = 0):
        letter, base = TABLES[table]
        self.up, self.down = W.powers(1 << max(20, len(data).bit_length()), base)
        self.sums = np.zeros(len(data) + 1, W.U)
        np.cumsum(letter[data] * self.up[: len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return W.mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(W.U) * W.U(W.STEP), salt)


def pointers(data: np.ndarray, begin: np.ndarray, length: int):
    """Runs of windows with one pointer: (text, first window, last window, bucket, context)."""
    none = (np.zeros(0, np.int64),) * 5
    if len(data) < length:
        return none
    spans, width = Spans(data), length - GRAM + 1
    place = np.arange(len(data) - GRAM + 1)
    gram = spans.hash(place, place + GRAM, 6)
    # The smallest hash, the leftmost of equal ones: the place fills the lowest bits.
    key = (W.mixed(gram, 7) >> W.U(24) << W.U(24)) | place.astype(W.U)
    blocks = np.full(-(-len(key) // width) * width, ~W.U(0))
    blocks[: len(key)] = key
    blocks = blocks.reshape(-1, width)
    after = np.minimum.accumulate(blocks, axis=1).ravel()
    before = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(before[: len(data) - length + 1], after[width - 1 : len(data) - GRAM + 1])
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))[: len(least)]
    window = np.flatnonzero(np.arange(len(least)) + length <= begin[text + 1])
    if not len(window):
        return none
    pointer = (least[window] & W.U((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, (np.diff(pointer) != 0) | (np.diff(window) != 1)))
    last = np.append(first[1:], len(window)) - 1
    lo, hi, at = window[first], window[last], pointer[first]
    context = W.mixed(spans.hash(lo, hi + length, 8) + (at - lo).astype(W.U), 8)
    text = text[lo]
    return text, lo - begin[text], hi - begin[text], gram[at].view(np.int64), context.view(np.int64)


def names(data: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    """Two names of each of the windows at these places, by names of ever longer strings at later offsets."""
    both = []
    for table in (0, 1):
        spans = Spans(data, table)
        # The last of the first strings may overlap the one before it.
        of = [spans.hash(at + to, at + to + STEP, 9) for to in (min(k, length - STEP) for k in range(0, length, STEP))]
        while len(of) > 1:
            rest = of[len(of) - len(of) % 2 :]
            of = [W.mixed(a * W.U(W.STEP) + b, 10) for a, b in zip(of[::2], of[1::2])] + [W.mixed(x, 11) for x in rest]
        both.append(of[0].view(np.int64))
        # The sums of one table at a time.
        del spans, of
    return both


def repeated(docs: DataFrame, length: int, piece: int) -> DataFrame:
    """(k1, k2, spans) of the rows of docs (id, text, k1, k2) that have repeated windows; spans of bytes, sorted, apart."""
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = blocks_for(2 * size // (length - GRAM + 2))

    def point(batches):
        for part in slices(batches, "text", piece):
            k1, k2 = part.column("k1").to_numpy(), part.column("k2").to_numpy()
            for data, begin, first, shift, _ in pieces(part.column("text"), length, length - 1, piece):
                text, lo, hi, bucket, context = pointers(data, begin, length)
                if len(text):
                    row = text + first
                    places = {"lo": (lo + shift).astype(np.int32), "hi": (hi + shift).astype(np.int32)}
                    yield packed({"bucket": bucket, "context": context, "k1": k1[row], "k2": k2[row], **places}, blocks)

    found = docs.select("k1", "k2", "text").mapInArrow(point, packed_schema(ANCHORS))
    found = written(shared_entries(found, ANCHORS, blocks), "pointers")
    places = [F.first(c).alias(c) for c in ("k1", "k2", "lo", "hi")]
    contexts = written(found.groupBy("bucket", "context").agg(F.count(F.lit(1)).alias("n"), *places), "contexts")
    # Contexts that come once beside others in their bucket may share some windows with these.
    open_ = contexts.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("fewest")).where("k > 1 and fewest = 1")
    compared = contexts.join(open_.select("bucket"), "bucket")
    runs = compared.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("lo", "hi", "context")).alias("runs"), F.sum(F.col("hi") - F.col("lo") + 1).alias("windows")
    )
    runs = written(runs, "runs")
    n_windows, bytes_ = runs.agg(F.sum("windows"), F.sum(F.size("runs") * 32 + 64)).first()
    window_blocks = blocks_for(n_windows or 0)

    def name(batches):
        for part in slices(batches, "text", piece):
            lists = part.column("runs")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            lo, hi, context = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi", "context"))
            for data, begin, first, shift, stop in pieces(part.column("text"), length, 2 * length, piece):
                text = owner - first
                mine = np.flatnonzero((text >= 0) & (text < len(begin) - 1) & (lo >= shift) & (lo < stop))
                if not len(mine):
                    continue
                count = hi[mine] - lo[mine] + 1
                stops = np.cumsum(count)
                at = np.arange(stops[-1]) - np.repeat(stops - count, count)
                start = np.repeat(begin[text[mine]] + lo[mine] - shift, count) + at
                name, check = names(data, start, length)
                yield packed({"name": name, "check": check.astype(np.int32), "context": np.repeat(context[mine], count), "at": at.astype(np.int32)}, window_blocks)

    # A row that is there twice names its windows twice.  Its contexts come more than once
    # then, and are repeated as a whole in any case.
    wanted = F.broadcast(runs) if (bytes_ or 0) <= BROADCAST_BYTES else runs
    texts = docs.select("k1", "k2", "text").join(wanted.select("k1", "k2", "runs"), ["k1", "k2"])
    windows = shared_entries(texts.select("text", "runs").mapInArrow(name, packed_schema(WINDOWS)), WINDOWS, window_blocks, keys=2)
    # At most length - GRAM + 1 windows belong to a context.
    some = written(windows.groupBy("context").agg(F.collect_set("at").alias("at")), "windows")
    many = contexts.where("n > 1").select("bucket", "context")
    whole = found.join(many, ["bucket", "context"]).select("k1", "k2", "lo", (F.col("hi") + length).alias("end"))
    once = contexts.where("n = 1").join(some, "context").withColumn("at", F.explode("at")).select("k1", "k2", (F.col("lo") + F.col("at")).alias("lo"))
    spans = whole.unionByName(once.withColumn("end", F.col("lo") + length)).distinct()

    def merge(batches):
        """Spans of a text come together and sorted."""
        key, held = None, []
        for batch in batches:
            out = []
            for k1, k2, lo, end in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "lo", "end"))):
                if (k1, k2) != key:
                    if key:
                        out.append((*key, held))
                    key, held = (k1, k2), []
                if held and lo <= held[-1][1]:
                    held[-1][1] = max(held[-1][1], end)
                else:
                    held.append([lo, end])
            yield rows(out)
        yield rows([(*key, held)] if key else [])

    def rows(out):
        lists = pa.array([[x for span in held for x in span] for _, _, held in out], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)] + [lists], names=["k1", "k2", "spans"])

    together = spans.select("k1", "k2", "lo", "end").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "lo")
    out = written(together.mapInArrow(merge, "k1 long, k2 long, spans array<int>"), "spans")
    discard(found, contexts, runs, some)
    return out


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, with_kept: bool = False, piece: int = PIECE
) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, spans, if asked for).

    A byte of a text (in UTF-8) is removed if a string of length bytes that covers it
    also starts anywhere else in docs, in the same text too; overlapping ones count,
    and all are judged on docs as given.  spans holds first and end of each removed
    run, kept the remaining bytes.

    A null text is empty; texts shorter than length keep everything; repeated rows and
    copies of length bytes or more lose everything; a null id is an id like any other.
    An empty table gives an empty one.  Columns other than the id and the text are not
    read, whatever their names.  piece bounds the bytes that a task works on at a time.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    own = keyed(docs, id_col, text_col)
    spans = repeated(own, length, piece)
    bytes_ = spans.agg(F.sum(F.size("spans") * 4 + 64)).first()[0] or 0
    spans = F.broadcast(spans) if bytes_ <= BROADCAST_BYTES else spans
    both = own.join(spans, ["k1", "k2"], "left").select("id", "text", "spans")
    fields = [T.StructField("id", both.schema["id"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]
    if with_kept:
        fields += [T.StructField("kept", T.BinaryType()), T.StructField("spans", T.ArrayType(T.IntegerType()))]
    schema = T.StructType(fields)

    def cut(batches):
        for part in slices(batches, "text", 4 * PIECE):
            columns = [[] for _ in range(5)]
            for text, span in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                edges = [0, *(span or []), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                for c, v in zip(columns, (len(text), len(text) - len(kept), len(span or []) // 2, hashlib.sha256(kept).hexdigest(), kept)):
                    c.append(v)
            arrays = [part.column("id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
            if with_kept:
                arrays += [pa.array(columns[4], pa.binary()), part.column("spans")]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return both.mapInArrow(cut, schema).withColumnRenamed("id", id_col)
