"""Packing of documents into token windows with lexical neighbours.

1. Whole windows of a long document stand alone.  What is left of each document, its
   remainder, is written with its tokens.
2. Documents, mean length and the documents of every term are counted over all
   remainders; the terms are those of the tokenizer, so that the counts are small.
3. A remainder goes to the shard of its topic: its rarest shared term of those that
   about fill a shard, or else the most frequent one below.  Terms of few remainders
   share a shard; a term of more than a shard holds has several, and then the next
   terms decide, and last the id.  So the shards depend on the table and not on its
   files, their order or splits.  A seed meets the remainders of its own shard.
4. A shard is a BM25 index with the weights of the whole table.  A seed opens a window,
   the index returns the unused remainders closest to it, and these fill the window in
   that order; the one that overflows is cut and its rest is the next seed.  The last
   window of a shard goes on in the next one of its run; the end of a run is short, and
   is cut at powers of two.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tonetape.llm import words as W
from tonetape.llm.bpe import encoder
from tonetape.llm.common import TEXTS, batches_of, discard, frugal, slices, written_texts

SLICE = 1 << 20
#: Bounds of a shard of the index: remainders and their tokens.
SHARD_DOCS, SHARD_TOKENS = 4096, 1 << 21
#: Shards that one window after the other goes through.
RUN = 4
#: Shared terms that decide on a remainder's shard, one after the other.
DEPTH = 4
MARKS = [f"mark{k}" for k in range(DEPTH + 1)]
#: Neighbours that the index returns at a time, and the share of unused remainders at which it is made smaller.
FETCH, SHRINK = 32, 0.8
#: Sequences from here on are of remainders, those below of whole windows.
REMAINDERS = 1 << 62
# BM25's usual saturation and length parameters.
K1, B = 1.2, 0.75


class Counts(NamedTuple):
    """Of all remainders: how many, their mean length, and how many have each term."""

    docs: int
    mean: float
    df: np.ndarray

    def ranks(self, shard_docs: int) -> np.ndarray:
        """The place of each term as a topic: the rarest that half a shard has, up to the most frequent, then those below, down to the rarest."""
        few = 2 * self.df < shard_docs
        out = np.empty(len(self.df), np.int64)
        out[np.lexsort((np.arange(len(self.df)), np.where(few, -self.df, self.df), few))] = np.arange(len(self.df))
        return out


def tokens_of(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of remainders one after the other, and the number of each."""
    return np.frombuffer(b"".join(raw), "<u4").astype(np.int64), np.array([len(r) // 4 for r in raw], np.int64)


def holders(raw: list[bytes], df: np.ndarray) -> np.ndarray:
    """df, longer if need be, with one more for each term of each remainder."""
    for own in raw:
        terms = np.frombuffer(own, "<u4").astype(np.int64)
        most = int(terms.max(initial=-1))
        if most >= len(df):
            df = np.append(df, np.zeros(most + 1 - len(df), np.int64))
        # A term that comes twice in terms is read and written once more, not added twice.
        df[terms] += 1
    return df


def topics(counts: Counts, ranks: np.ndarray) -> np.ndarray:
    """The rank of each term that others share and that weighs something; beyond all ranks for the rest."""
    return np.where((counts.df > 1) & (2 * counts.df < counts.docs), ranks, len(ranks))


def paths(raw: list[bytes], topic: np.ndarray) -> np.ndarray:
    """The ranks of each remainder's DEPTH first topics; -1 after the last."""
    flat, length = tokens_of(raw)
    rank, starts = topic[flat], np.cumsum(length) - length
    out = np.full((len(raw), DEPTH), -1, np.int64)
    for k in range(DEPTH):
        least = np.minimum.reduceat(rank, starts)
        out[:, k] = np.where(least < len(topic), least, -1)
        rank[rank == np.repeat(least, length)] = len(topic)
    return out


def marks(path: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, ... DEPTH terms of paths."""
    out = np.zeros((len(path), DEPTH + 1), W.U)
    for k in range(DEPTH):
        out[:, k + 1] = W.mixed(out[:, k] ^ W.mixed(path[:, k].view(W.U), 7), 8)
    return out.view(np.int64)


class Shards:
    """Which shard a remainder belongs to.

    firsts: (rank, documents, tokens) of first terms of no more than a shard holds.
    large: (k, mark, mark before, documents, tokens) of first k terms of more than that."""

    def __init__(self, firsts: list[tuple], large: list[tuple], terms: int, shard_docs: int):
        self.first = np.zeros(terms + 1, np.int64)
        shard, held = 0, np.zeros(2, np.int64)
        bound = np.array([shard_docs, SHARD_TOKENS])
        for rank, *size in sorted(firsts):
            if held.any() and (held + size > bound).any():
                shard, held = shard + 1, held * 0
            self.first[rank + 1] = shard
            held = held + size
        shard += 1
        # What longer paths of many documents take has shards of its own.
        left = {(k, mark): np.array(size) for k, mark, _, *size in large}
        for k, _, before, *size in large:
            if k > 1:
                left[k - 1, before] = left[k - 1, before] - size
        self.large: list[dict[int, tuple[int, int]]] = [{} for _ in range(DEPTH + 1)]
        for (k, mark), size in sorted(left.items()):
            parts = max(1, int(np.max(-(-size // bound))))
            self.large[k][mark] = shard, parts
            shard += parts

    def of(self, path: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The shards of remainders by their paths; own decides last."""
        mark = marks(path)
        out = self.first[path[:, 0] + 1]
        for k in range(1, DEPTH + 1):
            if self.large[k]:
                keys = np.array(sorted(self.large[k]), np.int64)
                base, parts = np.array([self.large[k][m] for m in keys.tolist()], np.int64).T
                at = np.minimum(np.searchsorted(keys, mark[:, k]), len(keys) - 1)
                salt = W.mixed((mark[:, k + 1] if k < DEPTH else own).view(W.U), 9)
                out = np.where(keys[at] == mark[:, k], base[at] + (salt % parts[at].view(W.U)).view(np.int64), out)
        return out


class Index:
    """BM25 over the token ids of a shard, weighted by counts over the table it is a part
    of (itself, if none are given).  Terms in more than half of that weigh nothing."""

    def __init__(self, docs: list[np.ndarray], counts: Counts | None = None):
        n = len(docs)
        length = np.fromiter(map(len, docs), np.int64, n)
        # Pairs of a term and a document, sorted in place: of all that a task holds, this takes the most memory.
        pair = np.concatenate(docs, dtype=np.int64)
        pair *= n
        pair += np.repeat(np.arange(n), length)
        pair.sort()
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
        count = np.diff(np.append(starts, len(pair))).astype(np.int32)
        pair = pair[starts]
        del starts
        term = (pair // n).astype(np.int32)
        pair -= term * np.int64(n)
        doc = pair
        new = np.append(True, term[1:] != term[:-1])
        number = np.cumsum(new, dtype=np.int32) - 1
        df = np.bincount(number)
        total, mean, among = counts.docs if counts else n, counts.mean if counts else length.mean(), counts.df[term[new]] if counts else df
        del pair, term, new
        idf = np.log(np.maximum((total - among + 0.5) / (among + 0.5), 1))
        norm = K1 * (1 - B + B * length / max(mean, 1))
        keep = (idf[number] > 0) & (df[number] > 1)
        number, doc, count = number[keep], doc[keep], count[keep]
        self.n, self.size, self.number, self.doc = n, len(df), number, doc
        self.weight = idf[number]
        self.weight *= count
        self.weight *= K1 + 1
        below = norm[doc]
        below += count
        self.weight /= below
        del below, count, keep
        self.first = self.firsts()
        # Numbers of 16 bits are sorted by digits.
        order = np.argsort(doc.astype(np.uint16) if n <= 1 << 16 else doc, kind="stable")
        self.terms = number[order]
        self.owned = np.append(0, np.cumsum(np.bincount(doc, minlength=n)))

    def firsts(self) -> np.ndarray:
        return np.searchsorted(self.number, np.arange(self.size + 1, dtype=np.int32))

    def drop(self, unused: np.ndarray) -> None:
        """Postings of used documents leave the index; their own terms stay, for seeds."""
        keep = unused[self.doc]
        self.number, self.doc, self.weight = self.number[keep], self.doc[keep], self.weight[keep]
        self.first = self.firsts()

    def near(self, seed: int, unused: np.ndarray, most: int | None = None) -> np.ndarray:
        """Unused documents, the highest score first, ties in order of arrival; no more than most, if given."""
        terms = self.terms[self.owned[seed] : self.owned[seed + 1]]
        found = [slice(a, b) for a, b in zip(self.first[terms].tolist(), self.first[terms + 1].tolist()) if a < b]
        score = np.zeros(self.n)
        if found:
            score = np.bincount(np.concatenate([self.doc[s] for s in found]), np.concatenate([self.weight[s] for s in found]), self.n)
        rest = np.flatnonzero(unused)
        score = -score[rest]
        if most is not None and most < len(rest):
            # All that tie with the last one are sorted too, so that arrival decides among them.
            among = np.flatnonzero(score <= np.partition(score, most - 1)[most - 1])
            return rest[among[np.argsort(score[among], kind="stable")[:most]]]
        return rest[np.argsort(score, kind="stable")]


class Packer:
    """The windows of one run; pieces are (row, start, end, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence, self.used = window, first_sequence, 0
        self.open: list[tuple[int, int, int]] = []  # pieces of the window that is being filled
        self.out: list[tuple[int, int, int, int, int]] = []

    def place(self, row: int, start: int, end: int) -> int:
        """Puts what fits of row's tokens from start on into the window; where the rest begins."""
        stop = min(end, start + self.window - self.used)
        self.open.append((row, start, stop))
        self.used += stop - start
        if self.used == self.window:
            self.close([self.window])
        return stop

    def close(self, sizes: list[int]) -> None:
        """Writes the open pieces as sequences of these sizes, which add up to what is used."""
        at = 0
        for row, start, end in self.open:
            while start < end:
                stop = min(end, start + sizes[0] - at)
                self.out.append((row, start, stop, self.sequence, at))
                at += stop - start
                start = stop
                if at == sizes[0]:
                    sizes, at, self.sequence = sizes[1:], 0, self.sequence + 1
        self.open, self.used = [], 0

    def shard(self, rows: list[int], docs: list[np.ndarray], counts: Counts) -> None:
        index = Index(docs, counts)
        unused = np.ones(len(rows), bool)
        left = held = len(rows)  # unused ones, now and when the index was last made smaller
        seed = None
        while left:
            if seed is None:
                seed = int(np.argmax(unused))
                unused[seed], left = False, left - 1
                at = self.place(rows[seed], 0, len(docs[seed]))
                if at < len(docs[seed]):
                    self.place(rows[seed], at, len(docs[seed]))
            if left < SHRINK * held:
                index.drop(unused)
                held = left
            cut = None
            while left and self.used and cut is None:
                for near in index.near(seed, unused, FETCH).tolist():
                    unused[near], left = False, left - 1
                    at = self.place(rows[near], 0, len(docs[near]))
                    if at < len(docs[near]):
                        self.place(rows[near], at, len(docs[near]))
                        cut = near
                    if cut is not None or not self.used:
                        break
            seed = cut

    def end(self) -> None:
        """The last window of the run: sequences at the powers of two that make up its size."""
        self.close([1 << b for b in range(self.used.bit_length(), -1, -1) if self.used >> b & 1])


def cut(kept: DataFrame, tokenizer: str, window: int, end_id: int, with_ids: bool) -> DataFrame:
    """A row for each whole window of kept (id, text), with its sequence, and one for each remainder, with none.

    tokens holds those of remainders, and of windows if with_ids says so."""
    fields = [T.StructField("id", kept.schema["id"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id")]
    schema = T.StructType([*fields, T.StructField("tokens", T.BinaryType())])

    def run(batches):
        model = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 33
        for part in slices(batches, "text", SLICE):
            flat, n = model.encode(part.column("text").to_pylist())
            rows, pieces = [], []
            for row, (stop, size) in enumerate(zip(np.cumsum(n), n)):
                own = np.append(flat[stop - size : stop], end_id).astype("<u4").tobytes()
                total = len(own) // 4
                for at in range(0, total, window):
                    raw, whole = own[4 * at : 4 * (at + window)], at + window <= total
                    rows.append(row)
                    pieces.append((at, len(raw) // 4, zlib.crc32(raw), total, sequence if whole else None, raw if with_ids or not whole else None))
                    sequence += whole
            made = [pa.array(c, pa.binary() if k == 5 else pa.int64()) for k, c in enumerate(zip(*pieces))]
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(rows)), *made], names=schema.names)

    return written_texts(kept.mapInArrow(frugal(run, encoder), schema), "cut")


def counted(rest: DataFrame) -> Counts:
    """Counts over all remainders; one row for each term comes to the driver."""

    def run(batches):
        docs = tokens = 0
        df = np.zeros(0, np.int64)
        for part in batches:
            raw = part.column("tokens").to_pylist()
            docs, tokens = docs + len(raw), tokens + sum(map(len, raw)) // 4
            df = holders(raw, df)
        term = np.flatnonzero(df)
        columns = np.append(term, -1), np.append(df[term], docs), np.append(term * 0, tokens)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "docs", "tokens"])

    found = rest.select("tokens").mapInArrow(frugal(run, encoder), "term long, docs long, tokens long")
    with batches_of(rest.sparkSession, TEXTS):
        found = {r.term: r for r in found.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).collect()}
    total = found.pop(-1, None)
    df = np.zeros(max(found, default=-1) + 1, np.int64)
    df[list(found)] = [r.docs for r in found.values()]
    return Counts(total.docs if total else 0, total.tokens / max(total.docs, 1) if total else 0.0, df)


def sharded(rest: DataFrame, topic: np.ndarray, shard_docs: int) -> Shards:
    """Shards by the sizes of paths; of those, first terms and paths of more than a shard come to the driver."""

    def run(batches):
        for part in slices(batches, "tokens", SLICE):
            raw = part.column("tokens").to_pylist()
            if raw:
                path = paths(raw, topic)
                columns = path[:, 0], *marks(path).T, np.array([len(r) // 4 for r in raw])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["rank", *MARKS, "tokens"])

    size = [F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens")]
    again = [F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")]
    found = rest.select("tokens").mapInArrow(frugal(run, encoder), ", ".join(f"{c} long" for c in ("rank", *MARKS, "tokens")))
    found = written_texts(found.groupBy("rank", *MARKS).agg(*size), "paths")
    fits = (F.col("docs") <= shard_docs) & (F.col("tokens") <= SHARD_TOKENS)
    firsts = found.groupBy("rank").agg(*again).where(fits).collect()
    steps = [F.struct(F.lit(k).alias("k"), F.col(MARKS[k]).alias("mark"), F.col(MARKS[k - 1]).alias("before")) for k in range(1, DEPTH + 1)]
    large = found.select(F.explode(F.array(*steps)).alias("step"), "docs", "tokens").groupBy("step.k", "step.mark", "step.before").agg(*again).where(~fits).collect()
    discard(found)
    return Shards([tuple(r) for r in firsts], [tuple(r) for r in large], len(topic), shard_docs)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    shard_docs: int = SHARD_DOCS,
    keep_tokenizer: bool = True,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ids, the piece's token ids, if asked for).

    A document's tokens are those of its whole text and end_id.  The tokens of a row
    are cut into pieces, each token in exactly one; a sequence holds the pieces with
    its sequence_id, gapless from offset 0.  Every sequence has window tokens, but the
    last ones of a run of shards, whose sizes are powers of two.  The text is not
    shuffled, the tokens of remainders are, once; a task holds one shard, so that memory
    does not depend on the table.  Which remainders meet in a window depends on the rows
    and not on their order.

    A null or empty text is the single token end_id; repeated rows are packed one by
    one, each with its own pieces; an empty table gives no pieces.  Columns other than
    the id and the text are not read, whatever their names.

    With keep_tokenizer a worker keeps the tokenizer and the words it knows for the next
    call; without, windows are filled in the memory that they took.
    """
    stays = [encoder] if keep_tokenizer else []
    kept = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    pieces = cut(kept, tokenizer, window, end_id, with_ids)
    rest = pieces.where(F.col("sequence_id").isNull()).drop("sequence_id")
    counts = counted(rest)
    topic = topics(counts, counts.ranks(shard_docs))
    shards = sharded(rest, topic, shard_docs)
    fields = ["start", "length", "ids_crc32", "doc_tokens"]

    def route(batches):
        for part in slices(batches, "tokens", SLICE):
            raw = part.column("tokens").to_pylist()
            if raw:
                path = paths(raw, topic)
                shard = shards.of(path, part.column("own").to_numpy())
                made = [pa.array(shard // RUN), pa.array(shard), pa.array(list(path), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "run", "shard", "path"])

    own = rest.withColumn("own", F.xxhash64("id"))
    schema = T.StructType([*own.schema.fields, T.StructField("run", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("path", T.ArrayType(T.LongType()))])
    routed = own.mapInArrow(frugal(route, *stays), schema).repartition("run").sortWithinPartitions("run", "shard", "path", "ids_crc32", "doc_tokens", "id")

    out = T.StructType([*pieces.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("tokens", T.BinaryType())])

    def fill(batches):
        ids: dict[int, object] = {}
        tokens: dict[int, np.ndarray] = {}
        whole: dict[int, tuple[int, int]] = {}  # where the remainder begins, and the document's tokens
        packer = at = kind = None
        waiting: list[int] = []
        held = row = 0

        def flush(ends: bool):
            nonlocal waiting, held
            if waiting:
                packer.shard(waiting, [tokens[r] for r in waiting], counts)
            waiting, held = [], 0
            if ends:
                packer.end()
            made, packer.out = packer.out, []
            raw = [tokens[r][a:b].astype("<u4").tobytes() for r, a, b, _, _ in made]
            columns = [
                [whole[r][0] + a for r, a, _, _, _ in made],
                [b - a for _, a, b, _, _ in made],
                list(map(zlib.crc32, raw)),
                [whole[r][1] for r, _, _, _, _ in made],
                [s for _, _, _, s, _ in made],
                [o for _, _, _, _, o in made],
            ]
            arrays = [pa.array([ids[r] for r, _, _, _, _ in made], kind), *(pa.array(c, pa.int64()) for c in columns)]
            arrays.append(pa.array(raw if with_ids else [None] * len(raw), pa.binary()))
            still = {r for r, _, _ in packer.open}
            for r in [r for r in tokens if r not in still]:
                del tokens[r], ids[r], whole[r]
            return pa.RecordBatch.from_arrays(arrays, names=out.names)

        for part in batches:
            kind = part.column("id").type
            for run, shard, key, start, size, raw in zip(*(part.column(c).to_pylist() for c in ("run", "shard", "id", "start", "doc_tokens", "tokens"))):
                if at != (run, shard) or len(waiting) >= shard_docs or held >= SHARD_TOKENS:
                    if packer:
                        yield flush(at[0] != run)
                    if not packer or at[0] != run:
                        packer = Packer(window, REMAINDERS + (run << 33))
                    at = run, shard
                tokens[row], ids[row], whole[row] = np.frombuffer(raw, "<u4").astype(np.int32), key, (start, size)
                waiting.append(row)
                held += len(tokens[row])
                row += 1
        if packer:
            yield flush(True)

    packed = routed.mapInArrow(frugal(fill, *stays), out)
    windows = pieces.where(F.col("sequence_id").isNotNull()).select("id", *fields, "sequence_id", F.lit(0).cast("long").alias("offset"), "tokens")
    # A remainder takes up to 8 KB: written here, they go to Python TEXTS at a time, however the session has it.
    both = written_texts(windows.unionByName(packed), "packed")
    discard(pieces)
    if not with_ids:
        return both.drop("tokens").withColumnRenamed("id", id_col)

    def listed(batches):
        for part in batches:
            own = pa.array([np.frombuffer(t, "<u4").astype(np.int32) for t in part.column("tokens").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], own], names=[*part.schema.names[:-1], "ids"])

    listing = T.StructType([*out.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return both.mapInArrow(listed, listing).withColumnRenamed("id", id_col)
