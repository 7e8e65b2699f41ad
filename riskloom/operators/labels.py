"""The two label definitions: one for modelling, one for analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.exprs import col, strip


def filter_loan_status(df: DataFrame, column: str = "loan_status") -> DataFrame:
    """Drop unresolved loans; 0 for a good outcome, 1 for all else, null included."""
    status = col(column)
    resolved = ~F.coalesce(status, F.lit("")).isin(S.UNRESOLVED_STATUSES)
    good = F.coalesce(status.isin(S.GOOD_STATUSES), F.lit(False))
    return df.where(resolved).withColumn(column, F.when(good, 0).otherwise(1))


def default_label(status: Column) -> Column:
    s = F.lower(strip(status))
    return F.when(s.isin(S.DEFAULT_STATUSES), 1).when(s.isin(S.NON_DEFAULT_STATUSES), 0)


def build_target(
    df: DataFrame, column: str = "loan_status", target: str = "target_default"
) -> DataFrame:
    """Drop current loans; 1 default, 0 repaid, null where the outcome is unknown."""
    if column not in df.columns:
        return df
    current = F.coalesce(F.lower(strip(col(column))) == "current", F.lit(False))
    return df.where(~current).withColumn(target, default_label(col(column)))


def known_target(df: DataFrame, target: str = "target_default") -> DataFrame:
    """The dashboard's rows: only loans with a known outcome."""
    return df.where(col(target).isNotNull())
