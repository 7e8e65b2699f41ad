"""Grouped reports: default rates, counts, trends and business statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.exprs import col, long_values, per_column, ratio
from riskloom.operators.encoding import year_month

TARGET = "target_default"


def default_rate_by(
    df: DataFrame, key: str, target: str = TARGET, count_keys: bool = False
) -> DataFrame:
    """Per key: mean of the target and how many targets (or keys) were counted."""
    t = col(target)
    counted = col(key) if count_keys else t
    return (
        df.where(col(key).isNotNull())
        .groupBy(col(key).alias(key))
        .agg(F.avg(t).alias("default_rate"), F.count(counted).alias("n"))
    )


def default_by_category(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    target: str = TARGET,
    top: int = 8,
) -> DataFrame:
    """Per text column, the rate and count of its most frequent values.

    A null takes part in the ranking as the text `nan` and is then left out. All
    columns are counted in one pass; only (column, value) totals are ranked.
    """
    names = columns or [c for c in S.text_columns(df) if c not in S.CATEGORY_SKIP_COLUMNS]
    cells = long_values(df, names, keep=[target])
    present = F.col("value").isNotNull()
    totals = cells.groupBy("column", F.coalesce("value", F.lit("nan")).alias("value")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(present).alias("filled"),
        F.count(F.when(present, col(target))).alias("n"),
        F.avg(F.when(present, col(target))).alias("default_rate"),
    )
    place = F.row_number().over(
        Window.partitionBy("column").orderBy(F.desc("rows"), F.asc("value"))
    )
    return (
        totals.withColumn("place", place)
        .where((F.col("place") <= top) & (F.col("filled") > 0))
        .select("column", "value", "default_rate", "n")
    )


def monthly_trend(
    df: DataFrame, date: str = "issue_d", amount: str = "loan_amnt", target: str = TARGET
) -> DataFrame:
    """Per month: loans, default rate and mean amount."""
    return (
        year_month(df, date)
        .groupBy("ym")
        .agg(
            F.count(col(amount)).alias("n_loans"),
            F.avg(col(target)).alias("default_rate"),
            F.avg(col(amount)).alias("avg_loan"),
        )
    )


def value_counts(df: DataFrame, column: str, n: int | None = None, with_nulls: bool = False):
    """Counts in descending order, ties by value; all of them or the first `n`."""
    rows = df if with_nulls else df.where(col(column).isNotNull())
    counts = rows.groupBy(col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.asc("value"))
    return ordered.limit(n) if n else ordered


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first `k` rows; each task keeps `k`, and `order` must end in a unique key."""
    return df.orderBy(*order).limit(k)


def target_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Class counts, imbalance ratio and the accuracy of always saying 0."""
    counts = df.agg(
        F.count_if(col(target) == 1).alias("n_default"),
        F.count_if(col(target) == 0).alias("n_non_default"),
    )
    n1, n0 = F.col("n_default"), F.col("n_non_default")
    imbalance = F.when(n1 > 0, F.round(ratio(n0, n1), 2)).otherwise(F.lit(float("inf")))
    return counts.select(
        n1,
        n0,
        imbalance.alias("imbalance_ratio"),
        F.round(ratio(n0, n0 + n1), 4).alias("majority_baseline_acc"),
    )


def business_statistics(df: DataFrame, label: str = "loan_status") -> DataFrame:
    """Mean profit of good loans, mean loss of bad ones, mean loan amount."""
    def mean_of(column: str, value: int) -> Column:
        return F.avg(F.when(col(label) == value, col(column)))

    return df.agg(
        (mean_of("total_pymnt", 0) - mean_of("loan_amnt", 0)).alias("avg_loan_profit"),
        (mean_of("loan_amnt", 1) - mean_of("total_pymnt", 1)).alias("avg_loan_loss"),
        F.avg(col("loan_amnt")).alias("avg_loan_amount"),
    )


def extreme_groups(stats: DataFrame, key: str, rate: str = "default_rate") -> DataFrame:
    """Groups with the lowest and the highest rate, the first key on ties."""
    low = F.min(F.struct(col(rate).alias("rate"), col(key).alias("key")))
    high = F.min(F.struct((-col(rate)).alias("minus"), col(key).alias("key")))
    picked = stats.where(col(rate).isNotNull()).agg(low.alias("low"), high.alias("high"))
    return picked.select(
        F.col("low.key").alias("best"),
        F.col("low.rate").alias("best_rate"),
        F.col("high.key").alias("worst"),
        (-F.col("high.minus")).alias("worst_rate"),
    )


def class_mean_difference(
    df: DataFrame, columns: Sequence[str] = S.CLASS_COMPARE_COLUMNS, target: str = TARGET
) -> DataFrame:
    """Per column: mean of each class and the difference, default minus the rest."""
    def mean_of(value: int):
        return lambda c: F.avg(F.when(col(target) == value, c))

    means = per_column(
        df, S.present(df, columns), {"mean_non_default": mean_of(0), "mean_default": mean_of(1)}
    )
    return means.withColumn("difference", F.col("mean_default") - F.col("mean_non_default"))


def class_weight_ratio(df: DataFrame, label: str) -> DataFrame:
    """Weight of the positive class and the grid around it used for tuning."""
    weight = F.count_if(col(label) == 0) / (F.count_if(col(label) == 1) + F.lit(1e-6))
    return df.agg(weight.alias("ratio")).select(
        "ratio", (F.col("ratio") * 0.5).alias("half"), (F.col("ratio") * 1.5).alias("one_and_half")
    )
