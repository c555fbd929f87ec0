"""What the operators of this package share: written tables and bounded batches of texts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where that is unset, as in tests, a folder of this machine stands in."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _own.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tonetape-llm-")
        _own[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


#: Texts that go to a Python worker at once: a batch is held there whole, and built in the executor's memory beside its heap.
TEXTS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Meanwhile, Python workers get so many rows at once, or as many as the session says if those are fewer."""
    before = spark.conf.get(_BATCH)
    # 0 and less stand for no bound.
    if not 0 < int(before) <= rows:
        spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def written_texts(df: DataFrame, name: str) -> DataFrame:
    """written, for a df that sends texts to Python: TEXTS at a time."""
    with batches_of(df.sparkSession, TEXTS):
        return written(df, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again.

    It cuts the lineage: a lost executor costs tasks, not the steps before."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._llm_path = path
    for tables in _watchers:
        tables.append(out)
    return out


_watchers: list[list[DataFrame]] = []


@contextmanager
def watched() -> Iterator[list[DataFrame]]:
    """A list of the tables that are written meanwhile, to be discarded when their readers are done."""
    tables: list[DataFrame] = []
    _watchers.append(tables)
    try:
        yield tables
    finally:
        _watchers.remove(tables)


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_llm_path", None)
        if path:
            jvm = table.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path).getParent()
            at.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
            table._llm_path = None


def column(df: DataFrame, name: str) -> Column:
    """The column of df with that very name, whatever marks it holds."""
    return df["`" + name.replace("`", "``") + "`"]


def columns(df: DataFrame, names: list[str]) -> list[Column]:
    return [column(df, c) for c in names]


def clashing(df: DataFrame, *names: str) -> str:
    """A column name that starts like the first of names and that df does not hold."""
    name, taken = names[0], {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_caches: list = []


def kept_by_worker(function):
    """function, cached by lru_cache, whose results stay in a worker from task to task; see frugal."""
    _caches.append(function)
    return function


def give_back(*kept) -> None:
    """Drops the caches of this worker but those in kept, and returns to the system what its allocators hold unused."""
    for cache in _caches:
        if cache not in kept:
            cache.cache_clear()
    pa.default_memory_pool().release_unused()
    # Only glibc has it.
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *kept) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, which begins without what tasks of other operators left in its worker, but the caches in kept, and leaves no unused memory.

    Workers are used again by the tasks of later stages, and stay while none runs."""

    def tidy(batches):
        give_back(*kept)
        try:
            yield from run(batches)
        finally:
            give_back(*kept)

    return tidy


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches in slices that hold about most_bytes of column, one row at least."""
    for batch in batches:
        col = batch.column(column)
        if not batch.num_rows:
            continue
        ends = pc.cumulative_sum(pc.cast(pc.fill_null(pc.binary_length(col), 0), pa.int64()))
        ends = ends.to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(base + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()
