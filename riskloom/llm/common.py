"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import ship_package

# Rows that an operator turns into one Arrow batch of its own; bounds a worker's memory.
BATCH_ROWS = 512
# Rows that the JVM and a worker exchange at a time in the registered queries and the pipeline.
ARROW_ROWS = 1024


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`; freed memory goes back at the end."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    release()


def release() -> None:
    """Give freed memory back to the system: Python workers live on beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Rows of long texts go to the workers a thousand at a time instead of ten thousand."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def field(df: DataFrame, column: str, name: str | None = None) -> T.StructField:
    """The schema field of a column, for the output schema of an Arrow function."""
    return T.StructField(name or column, df.schema[column].dataType, True)


def doc_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text only, a null text as the empty one; other columns cannot clash."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias(text_col))


def text_key(text_col: str) -> tuple:
    """Two 64-bit hashes that stand for a whole text."""
    return F.xxhash64(F.col(text_col)).alias("h1"), F.xxhash64(F.lit(1), F.col(text_col)).alias("h2")


def finite_vector(column: str):
    """True for a vector without null or non-finite components; null and empty vectors give false."""
    bad = F.exists(
        column,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return F.coalesce((F.size(column) > 0) & ~bad, F.lit(False))
