"""Step plans: cleaning with its audit, and the feature transformation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import views as V
from catalogue.cleaning import sql_date, sql_number, sql_text
from catalogue.registry import register
from catalogue.sql import columns, query
from catalogue.tables import _scratch, land_indicators, rounded
from riskloom import schemas as S
from riskloom.operators import cleaning as C
from riskloom.operators import joins
from riskloom.plans import bundle as B
from riskloom.plans import loans as P
from riskloom.plans import modelling as M
from riskloom.plans.steps import StepPlan, run_steps
from riskloom.sources.readers import read_table
from riskloom.sources.writers import write_table

AUDIT_COLUMNS = ["id", "issue_d", "emp_title", "emp_length", "delinq_2yrs"]


def _boundary(n: int, rows: str, nulls: str, source: str) -> str:
    return f"SELECT {n} AS b, {rows} AS n, {nulls} AS nulls FROM {source}"


_DATE, _GAP = "count(*) FILTER (issue_d IS NULL)", "count(*) FILTER (delinq_2yrs IS NULL)"
_TITLE, _EMP = "count(*) FILTER (emp_title IS NULL)", "count(*) FILTER (emp_length IS NULL)"


@register(
    "M18_audited_steps",
    query(
        """SELECT s.step_no, s.step, a.n AS rows_before, z.n AS rows_after, z.n - a.n AS rows_changed,
           a.nulls::BIGINT AS nulls_before, z.nulls::BIGINT AS nulls_after, 'success' AS status
           FROM (VALUES (0, 'strip'), (1, 'numbers'), (2, 'zeros'), (3, 'mandatory'), (4, 'copies'))
             AS s(step_no, step)
           JOIN bounds a ON a.b = s.step_no JOIN bounds z ON z.b = s.step_no + 1""",
        f"""tidy AS (SELECT id, issue_d, {sql_text('emp_title')} AS emp_title,
            {sql_text('emp_length')} AS emp_length, delinq_2yrs FROM raw_loans)""",
        "dated AS (SELECT * FROM tidy WHERE issue_d IS NOT NULL)",
        "single AS (SELECT DISTINCT ON (id) * FROM dated)",
        "bounds AS (" + " UNION ALL ".join([
            _boundary(0, "count(*)", f"{_DATE} + {_TITLE} + {_EMP} + {_GAP}", "raw_loans"),
            _boundary(1, "count(*)", f"{_DATE} + {_TITLE} + {_EMP} + {_GAP}", "tidy"),
            _boundary(2, "count(*)", f"{_DATE} + {_TITLE} + {_EMP} + {_GAP}", "tidy"),
            _boundary(3, "count(*)", f"{_DATE} + {_TITLE} + {_EMP}", "tidy"),
            _boundary(4, "count(*)", f"{_TITLE} + {_EMP}", "dated"),
            _boundary(5, "count(*)", f"{_TITLE} + {_EMP}", "single"),
        ]) + ")",
    ),
)
def audited_steps(spark, sf):
    steps = [
        ("strip", C.strip_and_standardize_strings, {}),
        ("numbers", C.coerce_numeric_columns, {}),
        ("zeros", C.zero_fill, {}),
        ("mandatory", C.drop_mandatory_nulls, {}),
        ("copies", C.remove_duplicates, {}),
    ]
    return run_steps(V.raw_loans(spark, sf, *AUDIT_COLUMNS), steps)[1].drop("error")


def _at_least(df, column, least):
    """A step of the caller's own."""
    return df.where(F.col(column) >= least)


@register(
    "U1_add_step",
    query("""SELECT id, round(loan_amnt / 1000, 6) AS thousands FROM (
             SELECT id, coalesce(loan_amnt, 0) AS loan_amnt FROM loans) WHERE loan_amnt >= 90000"""),
)
def add_step(spark, sf):
    plan = StepPlan("own").add_step("gaps", lambda df: df.na.fill(0.0, subset=["loan_amnt"]))
    plan.add_step("large", _at_least, column="loan_amnt", least=90_000)
    plan.add_step("thousands", lambda df: df.select("id", F.round(F.col("loan_amnt") / 1000, 6).alias("thousands")))
    return plan.execute(V.loans(spark, sf, "id", "loan_amnt"))


_TEXTS = V.TEXT_NAMES
_NUMBERS = V.NUMBER_NAMES
_MEDIANS = [c for c in S.MEDIAN_FILL_COLUMNS if c in _NUMBERS or c in S.INDICATOR_COLUMNS]
_CLIPPED = [c for c in S.CLIP_COLUMNS if c in _NUMBERS or c in S.INDICATOR_COLUMNS]
_WHOLE = [c for c in S.WHOLE_NUMBER_COLUMNS if c in _NUMBERS]
_ALL = ["id", "issue_d", "earliest_cr_line", *_NUMBERS, *_TEXTS, *S.INDICATOR_COLUMNS]


def _filled(c: str) -> str:
    if c in S.ZERO_FILL_COLUMNS:
        return f'coalesce("{c}", 0) AS "{c}"'
    if c in _MEDIANS:
        return f'coalesce("{c}", (SELECT median("{c}") FROM macro)) AS "{c}"'
    if c in S.STRING_COLUMNS:
        return f"coalesce(\"{c}\", 'Unknown') AS \"{c}\""
    return f'"{c}"'


def _clipped(c: str) -> str:
    if c not in _CLIPPED:
        return f'"{c}"'
    spread = f'("q3 {c}" - "q1 {c}")'
    return (f'CASE WHEN "{c}" IS NULL OR {spread} = 0 THEN "{c}" ELSE '
            f'greatest(least("{c}", "q3 {c}" + 1.5 * {spread}), "q1 {c}" - 1.5 * {spread}) END AS "{c}"')


def _final(c: str) -> str:
    if c == "id":
        return "id::BIGINT AS id"
    if c in _WHOLE:
        return f"round_even({c}, 0)::BIGINT AS {c}"
    if c in _NUMBERS or c in S.INDICATOR_COLUMNS:
        return f'round("{c}", 9) AS "{c}"'
    return c


_CLEANING = [
    """landed AS (SELECT r.* REPLACE (try_strptime(issue_d, '%b-%Y') AS issue_d), "CPI",
         "Unemployment Rate", "Federal Funds Rate" FROM raw_loans r LEFT JOIN indicators i
         ON year(try_strptime(issue_d, '%b-%Y')) = i."Year" AND month(try_strptime(issue_d, '%b-%Y')) = i."Month")""",
    "typed AS (SELECT id, issue_d, " + f"{sql_date('earliest_cr_line')} AS earliest_cr_line, "
    + ", ".join(f"{sql_number(sql_text(c))} AS {c}" for c in _NUMBERS) + ", "
    + ", ".join(f"{sql_text(c)} AS {c}" for c in _TEXTS) + ", "
    + columns("{c}", S.INDICATOR_COLUMNS) + " FROM landed)",
    "repaired AS (SELECT * REPLACE (" + ", ".join(
        f"CASE WHEN {c} >= 0 THEN {c} END AS {c}" for c in _NUMBERS if c in S.NON_NEGATIVE_COLUMNS)
    + """, CASE WHEN fico_range_low > fico_range_high THEN fico_range_high ELSE fico_range_low END AS fico_range_low,
        CASE WHEN fico_range_low > fico_range_high THEN fico_range_low ELSE fico_range_high END AS fico_range_high,
        lower(trim(pymnt_plan)) AS pymnt_plan) FROM typed WHERE id IS NOT NULL AND issue_d IS NOT NULL)""",
    "months AS (SELECT issue_d AS p, " + columns("max({c}) AS {c}", S.INDICATOR_COLUMNS)
    + " FROM repaired GROUP BY 1)",
    "month_fill AS (SELECT p, " + columns(
        "coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "first_value({c} IGNORE NULLS) OVER (ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}",
        S.INDICATOR_COLUMNS) + " FROM months)",
    "macro AS (SELECT r.* REPLACE (" + columns("coalesce(r.{c}, f.{c}) AS {c}", S.INDICATOR_COLUMNS)
    + ") FROM repaired r JOIN month_fill f ON r.issue_d = f.p)",
    "filled AS (SELECT " + ", ".join(_filled(c) for c in _ALL) + " FROM macro)",
    "single AS (SELECT DISTINCT ON (id) * FROM filled)",
    "spreads AS (SELECT " + ", ".join(
        f'quantile_cont("{c}", 0.25) AS "q1 {c}", quantile_cont("{c}", 0.75) AS "q3 {c}"' for c in _CLIPPED)
    + " FROM single)",
    "clipped AS (SELECT " + ", ".join(_clipped(c) for c in _ALL) + " FROM single, spreads)",
]


def landed_loans(spark, sf):
    raw = C.parse_issue_month(V.raw_loans(spark, sf, parallel=True))
    return joins.merge_indicators_with_loans(raw, joins.merge_indicators(V.indicators(spark, sf)))


@register("M19_clean_merged_dataset",
          query("SELECT " + ", ".join(_final(c) for c in _ALL) + " FROM clipped", *_CLEANING))
def clean_merged_dataset(spark, sf):
    source, target = _scratch(spark, "merged"), _scratch(spark, "cleaned")
    write_table(landed_loans(spark, sf), source)
    P.clean_merged_dataset(spark, source, target)
    return rounded(read_table(spark, target), 9)


@register("M20_collect_to_score")
def collect_to_score(spark, sf):
    """From landed files without a key to scored loans: collect, clean, split, train, bundle, score."""
    path = _scratch(spark, "landing") + ".csv"
    write_table(V.raw_loans(spark, sf, parallel=True).drop("id"), path)
    raw = P.collect_loans(spark, path, land_indicators(spark, sf))
    cleaned, _ = P.clean_loans(raw)
    tables = P.prepare_training(cleaned.drop("initial_list_status"))
    specs = [M.spec(S.BASELINE_MODEL), M.spec("Logistic Regression")]
    found = M.train_and_compare(tables["train_undersampled"], tables["test"], specs)
    best = B.make_bundle(found["best"], tables["train"])
    return B.score_batch(tables["transformed"], best)


_HOMES = ["MORTGAGE", "OTHER", "OWN", "RENT"]
_CHECKED = ["Not Verified", "Source Verified", "Verified"]
_PURPOSES = ["high", "low", "medium", "not specified", "urgent"]
_KEPT = [c for c in _NUMBERS if c not in S.LEAKAGE_COLUMNS]


@register(
    "M3_transform_loans",
    query(
        f"""SELECT id, {", ".join(_KEPT)}, (term = '36 months')::INTEGER AS term,
        (dense_rank() OVER (ORDER BY sub_grade DESC) - 1)::INTEGER AS sub_grade,
        CASE coalesce(emp_length, 'Unknown') WHEN '10+ years' THEN 10 WHEN '< 1 year' THEN 0
          WHEN 'Unknown' THEN -1 ELSE split_part(emp_length, ' ', 1)::INTEGER END AS emp_length,
        (pymnt_plan = 'y')::INTEGER AS pymnt_plan, initial_list_status, loan_status,
        (fico_range_low + fico_range_high) / 2 AS fico, """
        + ", ".join(
            [f"(h = '{v}')::INTEGER AS \"home_ownership_{v}\"" for v in _HOMES]
            + [f"(verification_status = '{v}')::INTEGER AS \"verification_status_{v}\"" for v in _CHECKED]
            + [f"(purpose = '{v}')::INTEGER AS \"purpose_{v}\"" for v in _PURPOSES])
        + """ FROM (SELECT *, CASE WHEN home_ownership IN ('RENT', 'MORTGAGE', 'OWN')
              THEN home_ownership ELSE 'OTHER' END AS h FROM modelled)"""
    ),
)
def transform_loans(spark, sf):
    return P.transform_loans(C.unknown_fill(V.loans(spark, sf), ["emp_length"]), keep=["id"])[0]
