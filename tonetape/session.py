"""Session set-up and the shared folder for cut lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", name: str = "tonetape") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # call-site tracking costs a round trip per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only where none is set."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tonetape-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def materialised(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and go on from the written table.

    For tables several later jobs read: the work before it runs once, a lost
    executor costs a re-read and no re-run, and later jobs read only the columns
    they use and know the table's size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of `materialised` tables that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_written_at", None)
        if path is not None:
            spark = table.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            table._written_at = None
