"""Table and column profiles: nulls, duplicates, categories, types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.exprs import col, long_values, null_cells, per_column, row_digest, strip

TYPE_MISMATCH_SHARE = 0.8


def missing_fraction(df: DataFrame) -> DataFrame:
    """Columns with nulls: their share and a severity at 20 % and 50 %."""
    shares = per_column(df, df.columns, {"missing": lambda c: F.avg(c.isNull().cast("int"))})
    severity = (
        F.when(F.col("missing") > 0.5, "high").when(F.col("missing") > 0.2, "medium").otherwise("low")
    )
    return shares.where(F.col("missing") > 0).withColumn("severity", severity)


def total_nulls(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum(null_cells(df.columns)), F.lit(0)).alias("total_nulls"))


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with `n`; nulls equal each other."""
    return (
        df.groupBy(*[col(c) for c in df.columns])
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Surplus copies, and all members of groups of equal rows.

    Rows are counted by a 128-bit digest of all their values, so that digests are
    exchanged instead of whole rows. Equal means what grouping by all columns means.
    """
    counted = df.groupBy(*row_digest(df.columns)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counted.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
    )


def sample_duplicates(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The first `k` keys among the duplicated rows."""
    return duplicate_groups(df).select(col(key)).orderBy(col(key)).limit(k)


def profile_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: distinct values, spelling inconsistencies, cardinality flag.

    One pass counts (column, value); nulls and the text `nan` are left out. A column
    without values counts as all unique.
    """
    names = list(columns or S.text_columns(df))
    per_value = _category_counts(df, names)
    folded = F.lower(strip(F.col("value")))
    per_spelling = per_value.groupBy("column", folded.alias("folded")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("spellings")
    )
    found = per_spelling.groupBy("column").agg(
        F.sum("spellings").alias("unique_count"),
        F.count(F.lit(1)).alias("normalised_unique"),
        F.sum("n").alias("rows"),
    )
    every = df.sparkSession.createDataFrame([(c,) for c in names], "column string")
    # One row per column of the table on either side.
    full = every.join(F.broadcast(found), "column", "left").na.fill(0)
    u, rows = F.col("unique_count"), F.col("rows")
    flag = (
        F.when(u == rows, "all_unique")
        .when(u == 1, "constant")
        .when(u > 0.5 * rows, "high_cardinality")
    )
    return full.select(
        "column",
        u,
        (F.col("normalised_unique") < u).alias("inconsistent"),
        flag.alias("cardinality_flag"),
    )


def _category_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    cells = long_values(df, list(names), as_type="string")
    usable = F.col("value").isNotNull() & (F.lower("value") != "nan")
    return cells.where(usable).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """The `k` most frequent values per text column; each task forwards `k` per column."""
    per_value = _category_counts(df, columns or S.text_columns(df))
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value")))
    return per_value.withColumn("place", place).where(F.col("place") <= k)


def suspected_type_mismatch(
    df: DataFrame, columns: Sequence[str] | None = None, share: float = TYPE_MISMATCH_SHARE
) -> DataFrame:
    """Text columns whose present values are numbers for more than `share`."""
    names = list(columns or S.text_columns(df))
    found = per_column(
        df,
        names,
        {
            "numeric": lambda c: F.count(strip(c).try_cast("double")),
            "filled": F.count,
        },
    )
    part = F.col("numeric") / F.greatest(F.col("filled"), F.lit(1))
    return found.select("column", part.alias("numeric_share")).where(F.col("numeric_share") > share)


def profile_table(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric and text columns, nulls and surplus rows, in one row."""
    basics = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(null_cells(df.columns)), F.lit(0)).alias("total_nulls"),
    )
    surplus = duplicate_rows(df).select("surplus_rows").scalar()
    return basics.select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(len(S.numeric_columns(df))).alias("n_numeric"),
        F.lit(len(S.text_columns(df))).alias("n_text"),
        "total_nulls",
        surplus.alias("surplus_rows"),
    )


def column_types(df: DataFrame) -> DataFrame:
    """Per column: its type, nulls and present values."""
    found = per_column(df, df.columns, {"n_nulls": lambda c: F.count_if(c.isNull()), "n_values": F.count})
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return found.select("column", types[F.col("column")].alias("dtype"), "n_nulls", "n_values")
