"""Writers: indicators, sentiment, features, metric tables, reports, models."""

import re
from collections.abc import Sequence

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _write(df: DataFrame, path: str, fmt: str, partition: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_indicators(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Laid out by ticker, so a read of one ticker skips the others.

    Rows are gathered by ticker and year first: a folder gets one file per year,
    not one per task, and a large ticker still has many writers.
    """
    spread = df.withColumn("_year", F.year("d")).repartition("ticker", "_year").drop("_year")
    _write(spread, path, fmt, "ticker")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    _write(df, path, fmt)


def result_name(name: str) -> str:
    """Display name to file name: lower case, underscores for spaces."""
    return name.lower().replace(" ", "_")


def write_result(df: DataFrame, root: str, model: str, kind: str, fmt: str = "csv") -> str:
    """One folder per model and kind of metric table; gives back its path."""
    path = f"{root}/{result_name(model)}_{kind}.{fmt}"
    _write(df, path, fmt)
    return path


def write_report(df: DataFrame, path: str) -> None:
    _write(df, path, "json")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def save_run(spark, models: dict, scaler: PipelineModel, classes: Sequence[int], root: str) -> None:
    """Every model behind its scaler as one pipeline, and the label map, class to code."""
    for name, model in models.items():
        save_model(PipelineModel([*scaler.stages, model]), f"{root}/{result_name(name)}")
    pairs = [(int(c), i) for i, c in enumerate(sorted(classes))]
    _write(spark.createDataFrame(pairs, "class int, code int"), f"{root}/label_map", "json")


def load_run(spark, names: Sequence[str], root: str) -> tuple[dict, list[int]]:
    """The pipelines of `save_run`, for rows that are not scaled yet, and the classes in code order."""
    models = {name: PipelineModel.load(f"{root}/{result_name(name)}") for name in names}
    pairs = spark.read.schema("class int, code int").json(f"{root}/label_map").collect()
    return models, [c for c, _ in sorted(pairs, key=lambda p: p[1])]


#: Characters that Spark escapes in the names of partition folders.
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def _folder(name: str, value) -> str:
    """A partition folder as Spark names it."""
    if value is None or value == "":
        value = "__HIVE_DEFAULT_PARTITION__"
    return f"{name}=" + _ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", str(value))


def write_filing_tree(filings: DataFrame, root: str, form: str = "8-K") -> int:
    """Filings (ticker, filing_id, text) as a tree of text files, one per filing; their number.

    The files that `write.partitionBy("ticker", "form", "filing_id").text` leaves: a
    file ends its last line, filings of one name in one task share a file.  Tasks put
    each file where it belongs: the usual writer makes a file for a rename, and the
    driver renames all of them one after the other.  A folder takes one new name at a
    time, so each task goes through the tickers in an order of its own."""
    name = "filing_id"

    def put(batches):
        files, at = FileSystem.from_uri(root)
        part = f"part-{TaskContext.get().partitionId():05d}.txt"
        key, held, n = None, [], 0
        made = set()

        def close():
            above = "/".join([at, _folder("ticker", key[0]), _folder("form", form)])
            if above not in made:
                files.create_dir(above)
                made.add(above)
            folder = f"{above}/{_folder(name, key[1])}"
            files.create_dir(folder, recursive=False)
            with files.open_output_stream(f"{folder}/{part}") as out:
                out.write(b"".join(held))

        for batch in batches:
            few = (batch.slice(i, 200) for i in range(0, batch.num_rows, 200))
            for ticker, filing, text in (row for b in few for row in zip(*(c.to_pylist() for c in b.columns))):
                if (ticker, filing) != key:
                    if held:
                        close()
                        n += 1
                    key, held = (ticker, filing), []
                held.append((text or "").encode() + b"\n")
        if held:
            close()
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    turn = F.xxhash64("ticker", F.spark_partition_id())
    rows = filings.select(turn.alias("turn"), "ticker", name, "text").sortWithinPartitions("turn", "ticker", name)
    return rows.drop("turn").mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
