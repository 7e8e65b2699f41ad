"""Sinks: one distributed write per table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write CSV (with header) or Parquet by the path's ending, replacing the old table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path.rstrip("/").endswith(".csv"):
        writer.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    else:
        writer.parquet(path)
