"""The rule suite."""

from __future__ import annotations

from catalogue import views as V
from catalogue.registry import register
from catalogue.sql import query, stacked
from riskloom.operators import quality
from riskloom.session import materialize

NUM = ["loan_amnt", "annual_inc", "int_rate", "revol_util", "dti", "avg_cur_bal", "open_acc"]
REQUIRED = ["id", "loan_amnt", "term", "int_rate", "annual_inc", "issue_d", "loan_status", "dti",
            "open_acc", "revol_util"]
TEXT = ["emp_title", "term", "home_ownership", "loan_status"]


def _counts(kind: str, condition: str, names, table: str = "loans", suffix: str = "") -> str:
    return stacked(
        f"""SELECT '{kind}' AS expectation, '{{n}}{suffix}' AS "column",
            count(*) FILTER ({condition}) AS unexpected_count FROM {table}""", names)


def _status(union: str) -> str:
    return f"SELECT *, CASE WHEN unexpected_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({union})"


NON_NEGATIVE = _counts("non_negative", "{c} < 0", NUM)
RATE = _counts("rate_range", "{c} < 0 OR {c} > 100", ["int_rate", "revol_util", "dti"])
NOT_NULL = _counts("not_null", "{c} IS NULL", REQUIRED)
NOT_BLANK = _counts("not_blank", "regexp_matches({c}, '^\\s*$')", TEXT, "raw_loans")
IQR = stacked(
    """SELECT 'iqr_range' AS expectation, '{n}' AS "column", count(*) FILTER (
       {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS unexpected_count FROM loans,
       (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM loans)""", NUM)
ZSCORE = stacked(
    """SELECT 'zscore_range' AS expectation, '{n}_zscore' AS "column",
       count(*) FILTER (abs(({c} - m) / s) > 3) AS unexpected_count FROM loans,
       (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM loans)""", NUM)


def _unique(table: str) -> str:
    return f"""SELECT 'unique' AS expectation, 'id' AS "column", coalesce(sum(n), 0)::BIGINT AS unexpected_count
               FROM (SELECT count(*) AS n FROM {table} WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)"""


@register("E1_non_negative", query(_status(NON_NEGATIVE)))
def non_negative(spark, sf):
    rows = V.loans(spark, sf, *NUM)
    return quality.check(rows, quality.non_negative(rows))


@register("E2_rate_range", query(_status(RATE)))
def rate_range(spark, sf):
    rows = V.loans(spark, sf, *NUM)
    return quality.check(rows, quality.rate_range(rows))


@register("E3_iqr_range", query(_status(IQR)))
def iqr_range(spark, sf):
    rows = materialize(V.loans(spark, sf, *NUM))
    return quality.check(rows, quality.iqr_range(rows))


@register("E4_zscore_range", query(_status(ZSCORE)))
def zscore_range(spark, sf):
    rows = V.loans(spark, sf, *NUM)
    return quality.check(rows, quality.zscore_range(rows))


@register("E5_not_null", query(_status(NOT_NULL)))
def not_null(spark, sf):
    rows = V.loans(spark, sf, *REQUIRED)
    return quality.check(rows, quality.not_null(rows))


@register("E6_unique", query(_status(_unique("raw_loans"))))
def unique(spark, sf):
    return quality.unique(V.raw_loans(spark, sf, "id"))


@register("E7_not_blank", query(_status(NOT_BLANK)))
def not_blank(spark, sf):
    rows = V.raw_loans(spark, sf, *TEXT)
    return quality.check(rows, quality.not_blank(rows))


SUITE = "\nUNION ALL\n".join([
    NON_NEGATIVE, RATE, IQR, ZSCORE,
    _counts("not_null", "{c} IS NULL", ["id", "loan_amnt", "annual_inc", "int_rate", "revol_util", "dti",
                                        "open_acc", "term", "loan_status"]),
    _counts("not_blank", "regexp_matches({c}, '^\\s*$')", ["term", "loan_status"]),
    _unique("loans"),
    "SELECT 'non_negative', 'id', count(*) FILTER (id < 0) FROM loans",
    """SELECT 'iqr_range', 'id', count(*) FILTER (id < q1 - 1.5 * (q3 - q1) OR id > q3 + 1.5 * (q3 - q1))
       FROM loans, (SELECT quantile_cont(id::DOUBLE, 0.25) AS q1, quantile_cont(id::DOUBLE, 0.75) AS q3 FROM loans)""",
    """SELECT 'zscore_range', 'id_zscore', count(*) FILTER (abs((id - m) / s) > 3) FROM loans,
       (SELECT avg(id) AS m, stddev_pop(id) AS s FROM loans)""",
])


def _suite_rows(spark, sf):
    return materialize(V.loans(spark, sf, "id", *NUM, "term", "loan_status"))


@register("E8_run_suite", query(_status(SUITE)))
def run_suite(spark, sf):
    return quality.run_suite(_suite_rows(spark, sf))


@register(
    "E8_overall",
    query(f"""SELECT count(*) AS rules, count(*) FILTER (unexpected_count > 0) AS failed,
          CASE WHEN count(*) FILTER (unexpected_count > 0) = 0 THEN 'PASSED' ELSE 'FAILED' END AS result
          FROM ({SUITE})"""),
)
def overall(spark, sf):
    return quality.overall(run_suite(spark, sf))


@register(
    "E8_unexpected_samples",
    query("""SELECT 'non_negative' AS expectation, "column", "value", r::INTEGER AS place FROM (
             SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY "value") AS r FROM (""" + stacked(
        """SELECT '{n}' AS "column", {c}::BIGINT::VARCHAR AS "value" FROM loans WHERE {c} < 0""",
        ["loan_amnt", "annual_inc"]) + ")) WHERE r <= 3"),
)
def unexpected_samples(spark, sf):
    rows = V.loans(spark, sf, "loan_amnt", "annual_inc")
    rows = rows.select(*[rows[c].cast("bigint").alias(c) for c in rows.columns])
    return quality.unexpected_samples(rows, quality.non_negative(rows))


@register("E8_statistical_report")
def statistical_report(spark, sf):
    return quality.statistical_report(_suite_rows(spark, sf))
