"""Declarative data-quality rules, all checked in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.exprs import col, long_values
from riskloom.operators import correlation, distribution, profiling
from riskloom.operators.cleaning import iqr_bounds

ZSCORE_LIMIT = 3


@dataclass(frozen=True)
class Expectation:
    """A row rule: `violated` is true for an unexpected value, null counts as fine."""

    kind: str
    column: str
    violated: Column


def outside(c: Column, lo: float | None, hi: float | None) -> Column:
    bad = F.lit(False)
    if lo is not None:
        bad |= c < lo
    if hi is not None:
        bad |= c > hi
    return bad


def non_negative(df: DataFrame, columns: Sequence[str] | None = None) -> list[Expectation]:
    names = S.numeric_columns(df) if columns is None else S.present(df, columns)
    return [Expectation("non_negative", c, outside(col(c), 0, None)) for c in names]


def rate_range(
    df: DataFrame, columns: Sequence[str] = S.PERCENT_RANGE_COLUMNS
) -> list[Expectation]:
    return [
        Expectation("rate_range", c, outside(col(c).cast("double"), 0, 100))
        for c in S.present(df, columns)
    ]


def iqr_range(df: DataFrame, columns: Sequence[str] | None = None) -> list[Expectation]:
    """Numeric columns inside 1.5 IQR of their exact quartiles."""
    names = S.numeric_columns(df) if columns is None else S.present(df, columns)
    bounds = iqr_bounds(df, names) if names else {}
    return [
        Expectation("iqr_range", c, outside(col(c).cast("double"), lower, upper))
        for c, (_, _, lower, upper) in bounds.items()
    ]


def zscore_range(df: DataFrame, columns: Sequence[str] | None = None) -> list[Expectation]:
    """Numeric columns within three standard deviations; constants have no score."""
    names = S.numeric_columns(df) if columns is None else S.present(df, columns)
    if not names:
        return []
    shape = df.agg(
        *[
            F.struct(F.avg(col(c)).alias("m"), F.stddev_pop(col(c)).alias("s")).alias(f"z{i}")
            for i, c in enumerate(names)
        ]
    ).first()
    return [
        Expectation(
            "zscore_range",
            f"{c}_zscore",
            F.abs((col(c) - F.lit(shape[f"z{i}"]["m"])) / F.lit(shape[f"z{i}"]["s"])) > ZSCORE_LIMIT,
        )
        for i, c in enumerate(names)
        if shape[f"z{i}"]["s"]
    ]


def not_null(df: DataFrame, columns: Sequence[str] = S.REQUIRED_COLUMNS) -> list[Expectation]:
    return [Expectation("not_null", c, col(c).isNull()) for c in S.present(df, columns)]


def not_blank(df: DataFrame, columns: Sequence[str] | None = None) -> list[Expectation]:
    names = S.text_columns(df) if columns is None else S.present(df, columns)
    return [Expectation("not_blank", c, col(c).rlike(r"(?U)^\s*$")) for c in names]


def check(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Unexpected values per rule, from one aggregate over the whole rule list."""
    wide = df.agg(*[F.count_if(e.violated).alias(f"e{i}") for i, e in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(e.kind).alias("expectation"),
            F.lit(e.column).alias("column"),
            F.col(f"e{i}").alias("unexpected_count"),
        )
        for i, e in enumerate(rules)
    ]
    return with_status(wide.select(F.inline(F.array(*rows))))


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn(
        "status", F.when(F.col("unexpected_count") == 0, "PASS").otherwise("FAIL")
    )


def unique(df: DataFrame, column: str = "id") -> DataFrame:
    """Unexpected are all members of groups that share a key; nulls are ignored."""
    groups = (
        df.where(col(column).isNotNull())
        .groupBy(col(column).alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_status(
        groups.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected_count"))
        .select(F.lit("unique").alias("expectation"), F.lit(column).alias("column"), "unexpected_count")
    )


def unexpected_samples(df: DataFrame, rules: Sequence[Expectation], k: int = 3) -> DataFrame:
    """The `k` smallest unexpected values per rule; each task forwards `k` per rule."""
    cells = [
        F.when(
            e.violated,
            F.struct(
                F.lit(e.kind).alias("expectation"),
                F.lit(e.column).alias("column"),
                col(e.column.removesuffix("_zscore")).cast("string").alias("value"),
            ),
        )
        for e in rules
    ]
    rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.*")
    place = F.row_number().over(Window.partitionBy("expectation", "column").orderBy("value"))
    return rows.withColumn("place", place).where(F.col("place") <= k)


def build_suite(df: DataFrame, key: str = "id") -> list[Expectation]:
    """All row rules that apply to the table's columns."""
    return [
        *non_negative(df),
        *rate_range(df),
        *iqr_range(df),
        *zscore_range(df),
        *not_null(df),
        *not_blank(df),
    ]


def run_suite(df: DataFrame, key: str = "id") -> DataFrame:
    """Result table of the whole suite, the key's uniqueness included if it is there."""
    results = check(df, build_suite(df))
    return results.unionByName(unique(df, key)) if key in df.columns else results


def overall(results: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAIL")
    return results.agg(F.count(F.lit(1)).alias("rules"), failed.alias("failed")).withColumn(
        "result", F.when(F.col("failed") == 0, "PASSED").otherwise("FAILED")
    )


def statistical_report(df: DataFrame) -> DataFrame:
    """Profile, duplicates, categories, distributions and relationships as long rows."""
    def rows(part: DataFrame, section: str, name: Column, values: Sequence[str]) -> DataFrame:
        cells = long_values(part.withColumn("_name", name), values, keep=["_name"], as_type="string")
        return cells.select(
            F.lit(section).alias("section"), F.col("_name").alias("name"),
            F.col("column").alias("metric"), "value",
        )

    profile = profiling.profile_table(df)
    duplicates = profiling.duplicate_rows(df)
    categories = profiling.profile_categorical(df)
    shapes = distribution.moments(df)
    high = correlation.high_correlation_pairs(df)
    pair = F.concat_ws(" & ", "column_a", "column_b")
    parts = [
        rows(profile, "Profile", F.lit("table"), profile.columns),
        rows(duplicates, "Duplicates", F.lit("table"), duplicates.columns),
        rows(categories, "Categorical", F.col("column"),
             ["unique_count", "inconsistent", "cardinality_flag"]),
        rows(shapes, "Distribution", F.col("column"), ["skewness", "kurtosis"]),
        rows(high, "Relationships", pair, ["correlation"]),
        rows(correlation.multicollinearity_risk(high), "Relationships", F.lit("table"), ["risk"]),
    ]
    return reduce(DataFrame.unionByName, parts)
