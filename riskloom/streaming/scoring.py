"""Scoring of arriving loans as a stateless stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.plans.bundle import Bundle, score_batch


def loan_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """New Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).parquet(path)


def score_stream(
    stream: DataFrame,
    bundle: Bundle,
    out: str,
    checkpoint: str,
    keep: Sequence[str] = ("id",),
    available_now: bool = True,
) -> StreamingQuery:
    """Score every arriving row by the batch rules and append it to `out`.

    Each row stands alone, so there is no state to grow; the checkpoint and the file
    sink's log make every row appear once after a restart.
    """
    writer = (
        score_batch(stream, bundle, keep)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
