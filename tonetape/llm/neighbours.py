"""Nearest neighbours by inner product: a block matrix join of int8 tiles.

Queries and candidates are dealt into row blocks, and every block of queries meets
every block of candidates.  In a tile the vectors are rounded to int8; the product of
the rounded vectors and the sizes of the rounding errors bound each inner product from
both sides.  A pair whose upper bound lies below the k-th largest lower bound of its
query cannot be among the k nearest; the others are computed in double precision on
the original vectors.  The lists of the tiles are merged by heaps, a bounded number of
lists at a time.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tonetape.llm.common import discard, written

#: Rows of a block of queries and of candidates; queries multiplied at a time.
QUERY_BLOCK, CANDIDATE_BLOCK, STRIP = 4096, 8192, 256
#: Lists that meet in one merge.
FAN_IN = 64
#: Components multiplied at a time: sums of int8 products below 2**24 are exact in float32.
EXACT = 1024


def rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32, for the product), scales, norms of the rounded vectors and of the errors."""
    scale = np.abs(vectors).max(axis=1) / 127
    whole = np.rint(vectors / scale[:, None])
    near = whole * scale[:, None]
    return whole.astype(np.float32), scale, np.linalg.norm(near, axis=1), np.linalg.norm(vectors - near, axis=1)


def tile(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int):
    """(query row, candidate row, inner product) of the k nearest candidates of each query in the tile."""
    q8, q_scale, q_norm, q_error = rounded(q)
    c8, c_scale, c_norm, c_error = rounded(c)
    c_columns = np.ascontiguousarray(c.T)
    rows, columns, scores = [], [], []
    for a in range(0, len(q), STRIP):
        b = min(a + STRIP, len(q))
        product = np.zeros((b - a, len(c)))
        for d in range(0, q.shape[1], EXACT):
            product += q8[a:b, d : d + EXACT] @ c8[:, d : d + EXACT].T
        product *= q_scale[a:b, None] * c_scale[None, :]
        error = q_norm[a:b, None] * c_error[None, :] + q_error[a:b, None] * (c_norm + c_error)[None, :]
        # What double precision itself may be off by.
        error += 1e-12 * (q_norm + q_error)[a:b, None] * (c_norm + c_error)[None, :]
        own = q_id[a:b, None] == c_id[None, :]
        low = np.where(own, -np.inf, product - error)
        bar = np.partition(low, -k, axis=1)[:, -k] if len(c) > k else np.full(b - a, -np.inf)
        r, col = np.nonzero((product + error >= bar[:, None]) & ~own)
        exact = np.zeros(len(r))
        q_columns = np.ascontiguousarray(q[a:b].T)
        for d in range(q.shape[1]):  # one component after another, so that the sum does not depend on the tile
            exact += q_columns[d][r] * c_columns[d][col]
        order = np.lexsort((c_id[col], -exact, r))
        r, col, exact = r[order], col[order], exact[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = place < k
        rows.append(r[keep] + a)
        columns.append(col[keep])
        scores.append(exact[keep])
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(scores)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def clean(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col("v")
    own = table.select(table[id_col].cast("long").alias("id"), table[vec_col].cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return own.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def dealt(rows: DataFrame, blocks: Column, others: Column, block: str, other: str) -> DataFrame:
    """rows in blocks, once for each block of the other side."""
    mine = F.pmod(F.xxhash64("row"), blocks).alias(block)
    return rows.select("dim", "id", "v", mine, F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias(other))


def merged(lists: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """The k first entries (score down, vec_id up) of each key, from sorted or unsorted entries."""

    def run(batches):
        current, heap = None, []

        def flush():
            order = sorted(heap, reverse=True)
            columns = [*([x] * len(order) for x in current), [-i for _, i in order], [s for s, _ in order], range(1, len(order) + 1)]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.float64() if n == "score" else pa.int64()) for x, n in zip(columns, names)], names=names)

        for batch in batches:
            held = [batch.column(c).to_pylist() for c in [*keys, "vec_id", "score"]]
            for *key, vec_id, score in zip(*held):
                if key != current:
                    if heap:
                        yield flush()
                    current, heap = key, []
                entry = (score, -vec_id)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        if heap:
            yield flush()

    names = [*keys, "vec_id", "score", "rank"]
    kind = ", ".join(f"{n} {'double' if n == 'score' else 'long'}" for n in names)
    together = lists.select(*keys, "vec_id", "score").repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(run, kind)


def nearest(
    table: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for the rows of table where is_query holds of the
    id, the k rows of the largest inner product among all others, ties to the smaller id.

    The result is exact.  Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows without an id; vectors of different lengths do
    not meet.  Rows with the query's own id are the query and not its neighbours; under
    an id that repeats the smallest vector is the query, and every other query's
    candidates are all rows, repeated ones each for itself.  With fewer than k
    candidates all are returned; an empty table gives none.  Other columns are not
    read, whatever their names.
    """
    rows = clean(table, id_col, vec_col).select("id", "v", F.size("v").cast("long").alias("dim"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = rows.where(is_query).groupBy("dim", "id").agg(F.min("v").alias("v")).withColumn("row", F.col("id"))
    queries = written(queries, "queries")
    n_queries = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / query_block).alias("query_blocks"))
    counts = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / candidate_block).alias("blocks")).join(n_queries, "dim")
    counts = written(counts, "counts")  # a row for each length of vectors
    most = counts.agg(F.max("blocks")).first()[0] or 0
    q = dealt(queries.join(counts, "dim"), F.col("query_blocks"), F.col("blocks"), "i", "j")
    c = dealt(rows.join(counts, "dim"), F.col("blocks"), F.col("query_blocks"), "j", "i")

    def product(key, left, right):
        if not left.num_rows or not right.num_rows:
            return names.empty_table()
        (q_id, qv), (c_id, cv) = ((t.column("id").to_numpy(), matrix(t.column("v"))) for t in (left, right))
        r, column, score = tile(q_id, qv, c_id, cv, k)
        return pa.table([q_id[r], np.full(len(r), key[2].as_py()), c_id[column], score], schema=names)

    names = pa.schema([(n, pa.int64()) for n in ("query_id", "part", "vec_id")] + [("score", pa.float64())])
    tiles = q.groupBy("dim", "i", "j").cogroup(c.groupBy("dim", "i", "j"))
    lists = tiles.applyInArrow(product, "query_id long, part long, vec_id long, score double")
    while most > FAN_IN:
        most = -(-most // FAN_IN)
        lists = merged(lists.withColumn("part", F.floor(F.col("part") / FAN_IN)), k, ["query_id", "part"])
    out = merged(lists, k, ["query_id"])
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
