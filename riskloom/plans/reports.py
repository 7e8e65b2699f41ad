"""The exploration of a cleaned loan table: every report by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from riskloom import schemas as S
from riskloom.operators import correlation, distribution, encoding, grouping, labels, profiling
from riskloom.plans.modelling import feature_importance

Report = Callable[[], DataFrame]

# Where the reports look for a credit score and for a date.
FICO_CHOICES = ["fico_range_high", "fico_range_low", "fico"]
DATE_CHOICES = ["issue_d", "earliest_cr_line"]
RATE_KEYS = ["home_ownership", "verification_status", "term"]


def explore(df: DataFrame) -> dict[str, Report]:
    """Reports that apply to the table's columns; each runs when it is called.

    Staging `df` first pays off, as every report reads a few columns of all rows.
    """
    rows = labels.build_target(df)
    numeric = S.numeric_columns(rows)
    reports: dict[str, Report] = {
        "profile": lambda: profiling.profile_table(rows),
        "numeric": lambda: distribution.describe_numeric(rows),
        "categorical": lambda: distribution.describe_categorical(rows),
        "missing": lambda: profiling.missing_fraction(rows),
        "correlation": lambda: correlation.pearson_matrix(rows),
        "top_pairs": lambda: correlation.top_corr_pairs(rows),
    }
    for c in numeric:
        reports[f"histogram {c}"] = lambda c=c: distribution.histogram(rows, c)
        reports[f"boxplot {c}"] = lambda c=c: distribution.boxplot_stats(rows, c)
    for c in S.text_columns(rows):
        reports[f"top values {c}"] = lambda c=c: grouping.value_counts(rows, c, 10)
    if grouping.TARGET in rows.columns:
        reports |= _by_outcome(rows)
    return reports


def _by_outcome(rows: DataFrame) -> dict[str, Report]:
    known = labels.known_target(rows)
    have = set(rows.columns)
    reports: dict[str, Report] = {
        "target": lambda: grouping.target_distribution(rows),
        "categories": lambda: grouping.default_by_category(rows),
        "class means": lambda: grouping.class_mean_difference(known),
    }
    for c in S.present(rows, S.CLASS_COMPARE_COLUMNS):
        reports[f"density {c}"] = lambda c=c: distribution.kde(known, c, grouping.TARGET)
        reports[f"boxplot by outcome {c}"] = lambda c=c: distribution.boxplot_stats(
            known, c, grouping.TARGET
        )
    for c in S.present(rows, ["sub_grade", *RATE_KEYS]):
        reports[f"rate by {c}"] = lambda c=c: grouping.default_rate_by(known, c)
    if "sub_grade" in have:
        reports["best and worst sub-grade"] = lambda: grouping.extreme_groups(
            grouping.default_rate_by(known, "sub_grade"), "sub_grade"
        )
    if "purpose" in have:
        reports["rate by purpose"] = lambda: grouping.default_rate_by(
            known, "purpose", count_keys=True
        )
    if "emp_length" in have:
        reports["rate by employment years"] = lambda: grouping.default_rate_by(
            encoding.emp_years_digits(known), "emp_yrs"
        )
    if "dti" in have:
        reports["class means dti, 99 %"] = lambda: grouping.class_mean_difference(
            encoding.trim_above_quantile(known, "dti"), ["dti"]
        )
    if "annual_inc" in have:
        reports["class means log income"] = lambda: grouping.class_mean_difference(
            encoding.log10_feature(
                encoding.trim_above_quantile(known, "annual_inc", positive=True), "annual_inc", "log_inc"
            ),
            ["log_inc"],
        )
    fico = S.first_present(rows, FICO_CHOICES)
    if fico:
        reports["rate by credit score band"] = lambda: grouping.default_rate_by(
            encoding.band(known, fico, out="fico_band"), "fico_band"
        )
    date = S.first_present(rows, DATE_CHOICES)
    if date and "loan_amnt" in have:
        reports["monthly trend"] = lambda: grouping.monthly_trend(rows, date)
    features = [c for c in S.numeric_columns(rows) if c != grouping.TARGET]
    reports["feature importance"] = lambda: feature_importance(known, grouping.TARGET, features)
    return reports
