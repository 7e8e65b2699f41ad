"""Spark session, staging folder and the size checks used before a broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Largest side (in rows) that may be broadcast or held as literals.
BROADCAST_ROWS = 100_000


def get_session(cpus: int | str = "*", app: str = "riskloom") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Wide tables generate many large classes: keep them, and skip the stack
        # capture that makes every Column call cost milliseconds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they run; once per application."""
    context, name = spark.sparkContext, "riskloom.zip"
    if name in context._python_includes:
        return
    home = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="riskloom-ship-"), name)
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(home.rglob("*.py")):
            packed.write(file, file.relative_to(home.parent))
    context.addPyFile(archive)


def staging_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: `spark.checkpoint.dir` of the session.

    Only a local session without the setting gets a temporary folder of its own;
    on a cluster a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    folder = tempfile.mkdtemp(prefix="riskloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, tag: str = "stage") -> str:
    """Write `df` as Parquet in the staging folder; the path."""
    path = f"{staging_dir(df.sparkSession).rstrip('/')}/riskloom/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write `df` once and read it back.

    Cuts the lineage, survives lost executors, and lets every later pass read only
    the columns it needs.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stage(df, tag))


def discard(staged: DataFrame) -> None:
    """Delete a table that `materialize` wrote, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        discard_path(staged.sparkSession, folder)


def discard_path(spark: SparkSession, folder: str) -> None:
    """Delete a folder that `stage` wrote; other folders are left alone."""
    if "/riskloom/" in folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sibling_session(spark: SparkSession) -> SparkSession:
    """A second session of the same application, with the same settings."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key) and other.conf.get(key, None) != value:
            other.conf.set(key, value)
    return other


def bounded_rows(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> list[Row] | None:
    """The rows of `df` if there are at most `max_rows`, else None."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def broadcastable(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it is proven small, else unchanged.

    The unchanged side takes part in an ordinary shuffle join, where adaptive
    execution splits skewed partitions.
    """
    rows = bounded_rows(df, max_rows)
    if rows is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
