"""Sources: loan tables, landed indicator observations, column subsets."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import col, strip
from riskloom.schemas import LANDING_SCHEMA, present

log = logging.getLogger(__name__)

OBSERVATIONS_SCHEMA = T.StructType(
    [
        T.StructField(
            "observations",
            T.ArrayType(
                T.StructType(
                    [T.StructField("date", T.StringType()), T.StructField("value", T.StringType())]
                )
            ),
        )
    ]
)
INDICATOR_KEY_SCHEMA = "Year int, Month int"


def _missing_path(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV (with header) or Parquet table; a missing path raises FileNotFoundError.

    CSV columns are read as text unless a schema is given, so that no pass over
    the data is spent on guessing types.
    """
    try:
        if path.rstrip("/").endswith(".csv"):
            reader = spark.read.option("header", True)
            if schema is not None:
                names = reader.csv(path).columns
                fields = {f.name: f for f in schema.fields}
                schema = T.StructType(
                    [fields.get(c, T.StructField(c, T.StringType())) for c in names]
                )
                reader = reader.schema(schema)
            return reader.csv(path)
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if _missing_path(error):
            raise FileNotFoundError(path) from error
        raise


def read_loans(spark: SparkSession, path: str, schema: T.StructType = LANDING_SCHEMA) -> DataFrame:
    """The loan table for collection: an empty table when the file is missing.

    The schema is for CSV; a Parquet table has its own columns and types.
    """
    try:
        return read_table(spark, path, schema if path.rstrip("/").endswith(".csv") else None)
    except FileNotFoundError:
        log.error("loan table not found: %s", path)
        return spark.createDataFrame([], T.StructType([]))


def project_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order; none leaves an empty table."""
    have = present(df, wanted)
    absent = [c for c in wanted if c not in have]
    if absent:
        log.warning("missing columns: %s", absent)
    if not have:
        return df.sparkSession.createDataFrame([], T.StructType([]))
    return df.select(*[col(c) for c in have])


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the listed columns that the table has; the scan reads no others."""
    df = read_table(spark, path)
    return df.select(*[col(c) for c in df.columns if c in set(columns)])


def observations_by_month(
    landed: DataFrame, column_name: str | None = None, series_id: str | None = None
) -> DataFrame:
    """(`Year`, `Month`, value) from rows with an `observations` array; dates may be null."""
    name = column_name or series_id
    if name is None:
        raise ValueError("column_name or series_id is needed")
    if "observations" not in landed.columns:
        return landed.sparkSession.createDataFrame([], f"{INDICATOR_KEY_SCHEMA}, `{name}` string")
    item = landed.select(F.explode("observations").alias("o"))
    date = F.try_to_timestamp("o.date", F.lit("yyyy-MM-dd"))
    return item.where(date.isNotNull()).select(
        F.year(date).alias("Year"), F.month(date).alias("Month"), F.col("o.value").alias(name)
    )


def read_observations(
    spark: SparkSession, path: str, column_name: str | None = None, series_id: str | None = None
) -> DataFrame:
    """Monthly observations from a landed JSON document of a series."""
    landed = spark.read.schema(OBSERVATIONS_SCHEMA).json(path, multiLine=True)
    return observations_by_month(landed, column_name, series_id)


def date_extent(df: DataFrame, column: str = "issue_d") -> DataFrame:
    """One row: first and last date."""
    return df.agg(F.min(col(column)).alias("first_date"), F.max(col(column)).alias("last_date"))


def limit_to_extent(series: DataFrame, extent: DataFrame) -> DataFrame:
    """Months of a (`Year`, `Month`, …) series from the first to the last date, inclusive."""
    month = F.make_date(F.col("Year"), F.col("Month"), F.lit(1))
    edge = {
        c: F.to_date(extent.select(F.date_trunc("month", c)).scalar())
        for c in ("first_date", "last_date")
    }
    return series.where(month.between(edge["first_date"], edge["last_date"]))


def read_indicator_set(
    spark: SparkSession, paths: Mapping[str, str], loans: DataFrame, date: str = "issue_d"
) -> list[DataFrame]:
    """{column name: landed path} to series limited to the loans' date range."""
    extent = date_extent(loans, date)
    return [limit_to_extent(read_observations(spark, p, n), extent) for n, p in paths.items()]


def indicator_value(c: str):
    """A landed value as a number; a lone `.` stands for a missing observation."""
    return strip(col(c)).try_cast("double")


def typed_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return reduce(lambda d, c: d.withColumn(c, indicator_value(c)), present(df, columns), df)
