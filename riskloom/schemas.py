"""Column vocabularies and the explicit loan schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- Fixed values: column names, statuses and limits the results depend on. ---

LOAN_COLUMNS = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "term", "int_rate", "installment", "sub_grade",
    "emp_title", "emp_length", "home_ownership", "annual_inc", "verification_status", "issue_d",
    "loan_status", "pymnt_plan", "purpose", "dti", "delinq_2yrs", "earliest_cr_line",
    "fico_range_low", "fico_range_high", "inq_last_6mths", "mths_since_last_delinq", "open_acc",
    "pub_rec", "revol_bal", "revol_util", "total_acc", "total_pymnt", "recoveries", "last_pymnt_d",
    "avg_cur_bal", "acc_now_delinq", "mort_acc", "pub_rec_bankruptcies", "initial_list_status",
]
DATE_COLUMNS = ["issue_d", "earliest_cr_line", "last_pymnt_d"]
STRING_COLUMNS = [
    "term", "sub_grade", "emp_title", "emp_length", "home_ownership", "verification_status",
    "loan_status", "pymnt_plan", "purpose", "initial_list_status",
]
COUNT_COLUMNS = [
    "delinq_2yrs", "inq_last_6mths", "mths_since_last_delinq", "open_acc", "pub_rec", "total_acc",
    "acc_now_delinq", "mort_acc", "pub_rec_bankruptcies",
]
AMOUNT_COLUMNS = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "installment", "annual_inc", "revol_bal",
    "total_pymnt", "recoveries", "avg_cur_bal",
]
RATE_COLUMNS = ["int_rate", "revol_util", "dti"]
INDICATOR_COLUMNS = ["CPI", "Unemployment Rate", "Federal Funds Rate"]
INDICATOR_SERIES = {
    "CPIAUCSL": "CPI",
    "UNRATE": "Unemployment Rate",
    "FEDFUNDS": "Federal Funds Rate",
}
FICO_COLUMNS = ["fico_range_low", "fico_range_high"]
NUMERIC_COLUMNS = [
    *FICO_COLUMNS, *COUNT_COLUMNS, *AMOUNT_COLUMNS, *RATE_COLUMNS, *INDICATOR_COLUMNS,
]
NON_NEGATIVE_COLUMNS = [*AMOUNT_COLUMNS, *RATE_COLUMNS, *COUNT_COLUMNS]
MANDATORY_COLUMNS = ["id", "issue_d"]
ZERO_FILL_COLUMNS = [
    "delinq_2yrs", "inq_last_6mths", "mths_since_last_delinq", "pub_rec", "acc_now_delinq",
]
MEDIAN_FILL_COLUMNS = [
    *AMOUNT_COLUMNS, *RATE_COLUMNS, *INDICATOR_COLUMNS, "open_acc", "total_acc", *FICO_COLUMNS,
]
CLIP_COLUMNS = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "installment", "annual_inc", "dti", "revol_bal",
    "revol_util", "total_pymnt", "recoveries", "avg_cur_bal", "int_rate", *INDICATOR_COLUMNS,
]
WHOLE_NUMBER_COLUMNS = ["id", *COUNT_COLUMNS, *FICO_COLUMNS]

GOOD_STATUSES = [
    "Fully Paid", "In Grace Period", "Does not meet the credit policy. Status:Fully Paid",
]
UNRESOLVED_STATUSES = ["Current", "Default"]
DEFAULT_STATUSES = [
    "charged off", "default", "late (31-120 days)", "late (16-30 days)",
    "does not meet the credit policy. status:charged off",
]
NON_DEFAULT_STATUSES = ["fully paid", "does not meet the credit policy. status:fully paid"]

LEAKAGE_COLUMNS = [
    "id", "last_pymnt_d", "total_pymnt", "recoveries", "emp_title", "funded_amnt_inv",
    "fico_range_low", "fico_range_high", "issue_d", "earliest_cr_line",
]
MINMAX_COLUMNS = [
    "loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc", "dti", "delinq_2yrs",
    "inq_last_6mths", "mths_since_last_delinq", "open_acc", "pub_rec", "revol_bal", "revol_util",
    "total_acc", "avg_cur_bal", "acc_now_delinq", "CPI", "Unemployment Rate",
    "Federal Funds Rate", "fico",
]
HOME_OWNERSHIP_KEPT = ["RENT", "MORTGAGE", "OWN"]
ONE_HOT_COLUMNS = ["home_ownership", "verification_status", "purpose"]
FICO_EDGES = [580, 620, 660, 700, 740, 780, 850]

REQUIRED_COLUMNS = [
    "id", "loan_amnt", "funded_amnt", "term", "int_rate", "installment", "sub_grade",
    "home_ownership", "annual_inc", "verification_status", "issue_d", "loan_status", "purpose",
    "dti", "fico_range_low", "fico_range_high", "open_acc", "pub_rec", "revol_bal", "revol_util",
    "total_acc", "total_pymnt",
]
PERCENT_RANGE_COLUMNS = [
    "int_rate", "revol_util", "Unemployment Rate", "Federal Funds Rate", "dti",
]
CATEGORY_SKIP_COLUMNS = ["id", "emp_title", "issue_d", "earliest_cr_line"]
CLASS_COMPARE_COLUMNS = [
    "loan_amnt", "annual_inc", "installment", "dti", "int_rate", "revol_util", "fico_range_high",
    "avg_cur_bal",
]
BASELINE_MODEL = "ZeroR Baseline"

# --- End of fixed values. ---

LANDING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ["id", *LOAN_COLUMNS]])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def present(df: DataFrame, names) -> list[str]:
    have = set(df.columns)
    return [c for c in names if c in have]


def first_present(df: DataFrame, names) -> str | None:
    return next(iter(present(df, names)), None)
