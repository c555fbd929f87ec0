"""Readers: prices, event dates, filings, features, result files."""

import os
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonetape.schema import FEATURES
from tonetape.session import materialised, release

_PATH = "path"
#: Tasks per core that list the folders of a tree, and the bytes that opening a file of it counts for.
LISTING_TASKS, OPEN_COST = 4, 1 << 19
#: Folders that a task lists and files that it reads, about; rows and bytes of a batch that it gives back.
FOLDERS, FILES, ROWS, BYTES = 10_000, 4_000, 10_000, 1 << 22


def number(c) -> Column:
    """Text to double; what is not a number, or NaN, is missing."""
    v = F.expr(f"try_cast(`{c}` as double)")
    return F.when(~F.isnan(v), v)


def instant(c: str) -> Column:
    """Text to timestamp, with or without a zone offset; unreadable is missing."""
    return F.expr(f"try_cast(`{c}` as timestamp)")


def _csv(spark, pattern: str, schema) -> DataFrame:
    """CSV files (or folders of them) by column position, with their path; none is no rows."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    try:
        return reader.csv(pattern).withColumn(_PATH, F.col("_metadata.file_path"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        return spark.createDataFrame([], T.StructType(fields.fields).add(_PATH, "string"))


def _texts(names) -> T.StructType:
    """All columns as text: files of one layout need no inference."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _ticker(suffix: str) -> Column:
    """`<ticker><suffix>.csv`, a file or a folder of part files."""
    return F.regexp_extract(F.col(_PATH), rf"([^/=]+){suffix}\.csv(/[^/]*)?$", 1)


def read_prices(spark: SparkSession, path: str, zone: str = "America/New_York") -> DataFrame:
    """`<ticker>_prices.csv` files as bars; `d` is the trading day in the exchange zone.

    The first column is the time, then Open, High, Low, Close, Volume; further
    columns are ignored.  A ticker without a file has no rows.
    """
    names = ["time", "open", "high", "low", "close", "volume"]
    raw = _csv(spark, f"{path}/*_prices.csv", _texts(names))
    # with an offset the text is an instant; bare text already is exchange time
    has_zone = F.col("time").rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    at = instant("time")
    in_zone = F.convert_timezone(F.current_timezone(), F.lit(zone), at.cast("timestamp_ntz"))
    return raw.select(
        _ticker("_prices").alias("ticker"),
        at.alias("ts"),
        F.when(has_zone, in_zone.cast("date"))
        .otherwise(F.expr("try_cast(substring(time, 1, 10) AS date)"))
        .alias("d"),
        *[number(c).alias(c) for c in names[1:]],
    ).where(F.col("ts").isNotNull() & F.col("d").isNotNull())


def read_event_dates(spark: SparkSession, path: str) -> DataFrame:
    """`<ticker>_earnings_dates.csv` files; the first column is the time of the event."""
    names = ["time", "date", "eps_estimate", "reported_eps", "surprise_pct"]
    raw = _csv(spark, f"{path}/*_earnings_dates.csv", _texts(names))
    return raw.select(
        _ticker("_earnings_dates").alias("ticker"),
        instant("time").alias("ts"),
        *[number(c).alias(c) for c in names[2:]],
    ).where(F.col("ts").isNotNull())


def between_dates(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows with start <= column <= end; a plain filter, so it reaches the scan."""
    kind = df.schema[column].dataType
    return df.where(F.col(column).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def _clean_text(text: Column) -> Column:
    # Most texts have none, and a plain search is much faster.
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def read_filings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Filings from an archive table of (ticker, filing_id, path, text), the way for large archives.

    Of rows with one ticker and filing the least path is taken, by an anti join with
    the rows passed over; adaptive execution broadcasts those while they are few.
    Line ends become newlines.
    """
    rows = spark.read.schema("ticker string, filing_id string, path string, text string").format(fmt).load(path)
    return _least_paths(rows.withColumn("text", _clean_text(F.col("text"))))


def _least_paths(rows: DataFrame) -> DataFrame:
    """Of rows (ticker, filing_id, path, text) with one ticker and filing those of the least path."""
    folder = ["ticker", "filing_id"]
    many = rows.groupBy(*folder).agg(F.min("path").alias("first"), F.max("path").alias("last")).where("first < last")
    passed = rows.select(*folder, "path").join(many, folder).where("path > first").select(*folder, "path")
    return rows.join(passed, [*folder, "path"], "left_anti").select(*folder, "path", "text")


@contextmanager
def _small_files(spark: SparkSession):
    """Listings and scans that run meanwhile take many folders or files to a task.

    A folder of a tree holds one file or two and a file a few KB; by Spark's defaults a
    listing has up to 10,000 tasks for each folder of folders, a scan one for 32 files."""
    parallel, cost = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"
    before = {name: spark.conf.get(name) for name in (parallel, cost)}
    spark.conf.set(parallel, str(min(int(before[parallel]), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    spark.conf.set(cost, str(OPEN_COST))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _shown(name: str) -> bool:
    """Whether Spark's own listings show a name: none that begins with "_" or ".", but name=value and metadata files."""
    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
    return not hidden or name.startswith(("_metadata", "_common_metadata"))


def _inside(files: FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """(name, whether it is a folder) of the folders and text files that are not empty in a folder."""
    if isinstance(files, LocalFileSystem):
        # One after the other: a folder may hold millions.
        with os.scandir(folder) as found:
            for e in found:
                if _shown(e.name):
                    if e.is_dir():
                        yield e.name, True
                    elif e.name.endswith(".txt") and e.is_file() and e.stat().st_size:
                        yield e.name, False
        return
    for i in files.get_file_info(FileSelector(folder)):
        if _shown(i.base_name):
            if i.type == FileType.Directory:
                yield i.base_name, True
            elif i.type == FileType.File and i.base_name.endswith(".txt") and i.size:
                yield i.base_name, False


def _roots(spark: SparkSession, root: str) -> tuple[list[str], str, str] | None:
    """The folders that root names, as Spark writes them, a URI of one for Arrow, and what comes
    before Arrow's own paths in them; None if there is none or Arrow does not know their store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = list(store.globStatus(store.makeQualified(at)) or [])
    if not found or not all(s.isDirectory() for s in found):
        return None
    paths, uri = [s.getPath().toString() for s in found], found[0].getPath().toUri().toString()
    try:
        files, own = FileSystem.from_uri(uri)
        if files.get_file_info(own).type != FileType.Directory or not paths[0].endswith(own):
            return None
    except (pa.ArrowException, OSError):
        return None
    return paths, uri, paths[0].removesuffix(own)


def _listed(spark: SparkSession, paths: list[str], uri: str, before: str) -> list[DataFrame]:
    """(path, folder) of all folders and text files under paths, a written table for each level of folders.

    Folders are listed by tasks, and no list of them or of files goes to the driver."""

    def look(batches):
        files, _ = FileSystem.from_uri(uri)
        found, folders = [], []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for name, folder in _inside(files, path.removeprefix(before)):
                    found.append(f"{path}/{name}")
                    folders.append(folder)
                    if len(found) == ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(folders, pa.bool_())], names=["path", "folder"])
                        found, folders = [], []
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(folders, pa.bool_())], names=["path", "folder"])

    level, n, out = spark.createDataFrame([(p,) for p in paths], "path string"), len(paths), []
    while n:
        tasks = max(n // FOLDERS, min(n, spark.sparkContext.defaultParallelism))
        out.append(materialised(level.repartition(tasks).mapInArrow(look, "path string, folder boolean")))
        level = out[-1].where("folder").select("path")
        n = level.count()
    return out


def _contents(files: DataFrame, uri: str, before: str) -> DataFrame:
    """files (with path) and the bytes of each as content, read by the tasks that hold their rows."""

    def read(batches):
        store, _ = FileSystem.from_uri(uri)
        for batch in batches:
            held, size, low = [], 0, 0
            for i, path in enumerate(batch.column("path").to_pylist(), 1):
                with store.open_input_stream(path.removeprefix(before), compression=None) as f:
                    held.append(f.read())
                size += len(held[-1])
                if size >= BYTES or i == batch.num_rows:
                    some = batch.slice(low, i - low)
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(held, pa.binary())], names=[*some.schema.names, "content"])
                    held, size, low = [], 0, i

    return files.mapInArrow(read, T.StructType([*files.schema.fields, T.StructField("content", T.BinaryType())]))


def read_filing_tree(spark: SparkSession, root: str) -> DataFrame:
    """One text per filing folder `<root>/<ticker>/8-K/<filing_id>/*.txt`.

    The files are read once, into a table like that of `read_filings` in the shared folder.
    Of several files the least path is taken, settled on path names alone.  Bytes that
    are not UTF-8 are dropped and line ends become newlines.  Tasks list the folders and
    read the files; a store that Arrow does not know is listed by Spark's driver.
    """
    # plain folders, or the name=value folders of a partitioned write
    parts = r"^(?:[^/]*=)?([^/=]+)/(?:[^/=]+=)?8-K/(?:[^/=]+=)?([^/=]+)/[^/]+\.txt$"
    last = F.substring_index("path", "/", -4)
    names = {"ticker": F.regexp_extract(last, parts, 1), "filing_id": F.regexp_extract(last, parts, 2)}
    raw = F.col("content").cast("string")
    decoded = F.when(F.is_valid_utf8(raw), raw).otherwise(
        F.replace(F.make_valid_utf8(raw), F.lit("\ufffd"), F.lit(""))
    )
    columns = ["ticker", "filing_id", "path", _clean_text(decoded).alias("text")]
    found = _roots(spark, root)
    if found is None:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
        with _small_files(spark):
            files = reader.load(root).withColumns(names).where(F.col("ticker") != "")
            return _least_paths(materialised(files.select(*columns)))
    paths, uri, before = found
    levels = _listed(spark, paths, uri, before)
    files = levels[0].where("NOT folder")
    for level in levels[1:]:
        files = files.unionByName(level.where("NOT folder"))
    # One shuffle of path names, by which files are dealt to the tasks that read them.
    tasks = max(files.count() // FILES, spark.sparkContext.defaultParallelism)
    filings = files.withColumns(names).where(F.col("ticker") != "").repartition(tasks, "ticker", "filing_id")
    least = filings.groupBy("ticker", "filing_id").agg(F.min("path").alias("path"))
    out = materialised(_contents(least, uri, before).select(*columns))
    release(*levels)
    return out


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(FEATURES)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)


# Result kinds, their file pattern and the suffix cut from the name.
RESULT_KINDS = {
    "confusion": ("*_confusion.csv", "_confusion"),
    "predictions": ("*_predictions.csv", "_predictions"),
    "probabilities": ("*_probabilities.csv", "_probabilities"),
    "feature_importance": ("*_feature_importance.csv", "_feature"),
    "coefficients": ("logistic_regression_coefficients_*.csv", ""),
    "comparison": ("model_comparison.csv", ""),
    "network_confusion": ("neural_networks/*_confusion.csv", "_confusion"),
    "network_predictions": ("neural_networks/*_predictions.csv", "_predictions"),
    "network_probabilities": ("neural_networks/*_probabilities.csv", "_probabilities"),
    "network_comparison": ("neural_networks/model_comparison.csv", ""),
}
_RESULT_ROWS = {
    "predictions": "row {key}, true int, pred int",
    "feature_importance": "feature string, importance double",
    "coefficients": "feature string, coefficient double",
    "comparison": "model string, accuracy double",
}
# Class columns that a file may lack, when a class did not occur.
_BY_NAME = {
    "confusion": ("label string", ("Pred_Down", "Pred_Stable", "Pred_Up")),
    "probabilities": ("row {key}", ("Prob_Down", "Prob_Stable", "Prob_Up")),
}


def _named(spark, pattern: str, first: str, columns) -> DataFrame:
    """CSV files whose columns are found by the names in each file's own header.

    Without such a column its cells are 0.  A file is one row until it is taken
    apart, as metric tables are small and files of one kind differ in layout."""
    name, kind = first.split()
    empty = ", ".join([first, *(f"{c} double" for c in columns), f"{_PATH} string"])
    try:
        files = spark.read.text(pattern, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], empty)
    cells = lambda line: F.transform(F.split(line, ","), lambda x: F.btrim(x, F.lit('" ')))
    lines = F.filter(F.split("value", "\r?\n"), lambda x: x != "")
    rows = files.select(F.col("_metadata.file_path").alias(_PATH), lines.alias("lines")).select(
        _PATH,
        cells(F.get("lines", F.lit(0))).alias("head"),
        F.explode(F.slice("lines", F.lit(2), F.size("lines"))).alias("line"),
    )
    cell = lambda c: F.get(cells(F.col("line")), F.array_position("head", c).cast("int") - 1)
    there = lambda c: F.array_contains("head", c)
    return rows.select(
        F.get(cells(F.col("line")), F.lit(0)).cast(kind).alias(name),
        *[F.when(there(c), cell(c).cast("double")).otherwise(0.0).alias(c) for c in columns],
        _PATH,
    )


def read_results(spark: SparkSession, root: str, kind: str, key: str = "long") -> DataFrame:
    """Result files of one kind in one table, named by file; `path` keeps like names apart.

    `key` is the type of the row key of predictions and probabilities.  Class columns
    are read by name, and a class without a column has 0."""
    pattern, cut = RESULT_KINDS[kind]
    kind = kind.removeprefix("network_")
    if kind in _BY_NAME:
        first, columns = _BY_NAME[kind]
        files = _named(spark, f"{root}/{pattern}", first.format(key=key), columns)
    else:
        files = _csv(spark, f"{root}/{pattern}", _RESULT_ROWS[kind].format(key=key))
    base = F.regexp_extract(_PATH, r"([^/]+)\.csv(/[^/]*)?$", 1)
    if kind == "comparison":
        return files
    if kind == "coefficients":
        return files.withColumn("class", F.element_at(F.split(base, "_"), -1))
    name = F.substring_index(base, cut, 1)
    if kind == "feature_importance":
        name = (
            F.when(base.contains("random_forest"), "Random Forest")
            .when(base.contains("xgboost"), "XGBoost")
            .otherwise(name)
        )
    return files.withColumn("model", name)


def prefer(primary: DataFrame | None, fallback: DataFrame) -> DataFrame:
    """The first table if it exists and has a row, else the second; settled when the result runs."""
    if primary is None:
        return fallback
    found = primary.limit(1).select(F.count(F.lit(1))).scalar()
    return primary.unionByName(fallback.where(found == 0))
