"""Row-local cleaning, labels and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import views as V
from catalogue.registry import register
from catalogue.sql import columns, query
from riskloom.functions.exprs import col
from riskloom.operators import cleaning as C
from riskloom.operators import encoding as E
from riskloom.operators import labels as L
from riskloom.session import materialize

TEXT = ["id", "term", "sub_grade", "emp_title", "emp_length", "home_ownership", "loan_status"]


def sql_text(c: str) -> str:
    t = f"regexp_replace(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')"
    return f"(CASE WHEN {t} IN ('', 'nan', 'None', 'null') THEN NULL ELSE {t} END)"


def sql_number(c: str) -> str:
    return f"try_cast(regexp_replace({c}, '[^0-9eE+\\-.]', '', 'g') AS DOUBLE)"


def sql_date(c: str) -> str:
    return f"coalesce(try_strptime({c}, '%b-%Y'), try_strptime({c}, '%Y-%m-%d'))"


@register("P1_normalize_columns", query("SELECT id, loan_amnt, term FROM raw_loans"))
def normalize_columns(spark, sf):
    padded = V.raw_loans(spark, sf, "id", "loan_amnt", "term").toDF("  id  ", " loan_amnt", "term ")
    return C.normalize_columns(padded)


@register(
    "P2_strip_and_standardize_strings",
    query("SELECT " + ", ".join(f"{sql_text(c)} AS {c}" for c in TEXT) + " FROM raw_loans"),
)
def strip_and_standardize_strings(spark, sf):
    return C.strip_and_standardize_strings(V.raw_loans(spark, sf, *TEXT))


@register(
    "P3_parse_dates",
    query(f"SELECT id, {sql_date('issue_d')} AS issue_d, "
          f"{sql_date('earliest_cr_line')} AS earliest_cr_line FROM raw_loans"),
)
def parse_dates(spark, sf):
    return C.parse_dates(V.raw_loans(spark, sf, "id", "issue_d", "earliest_cr_line"))


@register(
    "P3b_parse_issue_month",
    query("SELECT id, try_strptime(earliest_cr_line, '%b-%Y') AS earliest_cr_line FROM raw_loans"),
)
def parse_issue_month(spark, sf):
    return C.parse_issue_month(V.raw_loans(spark, sf, "id", "earliest_cr_line"), "earliest_cr_line")


NUMERIC_TEXT = ["loan_amnt", "funded_amnt", "int_rate", "revol_util", "annual_inc", "dti", "open_acc"]


@register(
    "P4_coerce_numeric_columns",
    query("SELECT id, " + ", ".join(f"{sql_number(c)} AS {c}" for c in NUMERIC_TEXT) + " FROM raw_loans"),
)
def coerce_numeric_columns(spark, sf):
    return C.coerce_numeric_columns(V.raw_loans(spark, sf, "id", *NUMERIC_TEXT))


@register(
    "P5_null_if_negative",
    query("SELECT id, " + columns("CASE WHEN {c} >= 0 THEN {c} END AS {c}",
                                  ["loan_amnt", "annual_inc", "avg_cur_bal", "open_acc"]) + " FROM loans"),
)
def null_if_negative(spark, sf):
    return C.null_if_negative(V.loans(spark, sf, "id", "loan_amnt", "annual_inc", "avg_cur_bal", "open_acc"))


@register(
    "P6_swap_inverted_pair",
    query("""SELECT id, least(fico_range_low, fico_range_high) AS fico_range_low,
             greatest(fico_range_low, fico_range_high) AS fico_range_high FROM loans"""),
)
def swap_inverted_pair(spark, sf):
    rows = V.loans(spark, sf, "id", "fico_range_low", "fico_range_high")
    return C.swap_inverted_pair(rows, "fico_range_low", "fico_range_high")


@register("P7_normalize_flag", query("SELECT id, lower(trim(pymnt_plan)) AS pymnt_plan FROM raw_loans"))
def normalize_flag(spark, sf):
    return C.normalize_flag(V.raw_loans(spark, sf, "id", "pymnt_plan"))


@register("P8_drop_mandatory_nulls", query("SELECT id, issue_d, term FROM loans WHERE issue_d IS NOT NULL"))
def drop_mandatory_nulls(spark, sf):
    return C.drop_mandatory_nulls(V.loans(spark, sf, "id", "issue_d", "term"))


@register(
    "P9_zero_fill",
    query("SELECT id, " + columns("coalesce({c}, 0) AS {c}", ["delinq_2yrs", "mths_since_last_delinq"])
          + ", open_acc FROM loans"),
)
def zero_fill(spark, sf):
    return C.zero_fill(V.loans(spark, sf, "id", "delinq_2yrs", "mths_since_last_delinq", "open_acc"))


@register(
    "P10_unknown_fill",
    query("""SELECT id, coalesce(emp_length, 'Unknown') AS emp_length,
             coalesce(loan_status, 'Unknown') AS loan_status FROM loans"""),
)
def unknown_fill(spark, sf):
    return C.unknown_fill(V.loans(spark, sf, "id", "emp_length", "loan_status"))


@register(
    "P11_finalize_types",
    query("""SELECT id, round_even(int_rate, 0)::BIGINT AS int_rate,
             round_even(open_acc, 0)::BIGINT AS open_acc FROM loans"""),
)
def finalize_types(spark, sf):
    return C.finalize_types(V.loans(spark, sf, "id", "int_rate", "open_acc"), ["id", "int_rate", "open_acc"])


@register("P12_filter_loan_status", query("SELECT id, loan_status FROM modelled"))
def filter_loan_status(spark, sf):
    return L.filter_loan_status(V.loans(spark, sf, "id", "loan_status"))


@register("P13_build_target", query("SELECT id, loan_status, target_default FROM labelled"))
def build_target(spark, sf):
    return L.build_target(V.loans(spark, sf, "id", "loan_status"))


@register(
    "P14_create_fico_feature",
    query("SELECT loan_amnt, term, (fico_range_low + fico_range_high) / 2 AS fico FROM loans"),
)
def create_fico_feature(spark, sf):
    rows = V.loans(spark, sf, "id", "issue_d", "loan_amnt", "total_pymnt", "term", "emp_title",
                   "fico_range_low", "fico_range_high")
    return E.create_fico_feature(rows)


@register(
    "P15_encode_term",
    query("SELECT id, (term IS NOT DISTINCT FROM '36 months')::INTEGER AS term FROM loans"),
)
def encode_term(spark, sf):
    return E.encode_term(V.loans(spark, sf, "id", "term"))


@register(
    "P16_encode_emp_length",
    query("""SELECT id, CASE coalesce(emp_length, 'Unknown') WHEN '10+ years' THEN 10 WHEN '< 1 year' THEN 0
             WHEN 'Unknown' THEN -1 ELSE split_part(emp_length, ' ', 1)::INTEGER END AS emp_length FROM loans"""),
)
def encode_emp_length(spark, sf):
    return E.encode_emp_length(C.unknown_fill(V.loans(spark, sf, "id", "emp_length")))


@register(
    "P16b_emp_years_digits",
    query("""SELECT id, emp_length,
             try_cast(regexp_replace(emp_length, '\\D', '', 'g') AS DOUBLE) AS emp_yrs FROM loans"""),
)
def emp_years_digits(spark, sf):
    return E.emp_years_digits(V.loans(spark, sf, "id", "emp_length"))


@register(
    "P16c_emp_years_dashboard",
    query("""SELECT id, emp_yrs, CASE emp_yrs WHEN 0 THEN '< 1 yr' WHEN 10 THEN '10+ yrs'
             ELSE emp_yrs::VARCHAR || ' yrs' END AS label FROM (
             SELECT id, CASE WHEN emp_length LIKE '%< 1%' THEN 0 WHEN emp_length LIKE '%10+%' THEN 10
             ELSE regexp_replace(emp_length, '\\D', '', 'g')::INTEGER END AS emp_yrs
             FROM loans WHERE emp_length IS NOT NULL)"""),
)
def emp_years_dashboard(spark, sf):
    return E.emp_years_dashboard(V.loans(spark, sf, "id", "emp_length")).drop("emp_length")


@register("P17_encode_pymnt_plan", query("SELECT id, (pymnt_plan = 'y')::INTEGER AS pymnt_plan FROM loans"))
def encode_pymnt_plan(spark, sf):
    return E.encode_pymnt_plan(V.loans(spark, sf, "id", "pymnt_plan"))


@register(
    "P18_collapse_rare",
    query("""SELECT id, CASE WHEN home_ownership IN ('RENT', 'MORTGAGE', 'OWN') THEN home_ownership
             ELSE 'OTHER' END AS home_ownership FROM loans"""),
)
def collapse_rare(spark, sf):
    return E.collapse_rare(V.loans(spark, sf, "id", "home_ownership"))


@register(
    "P19_trim_above_quantile",
    query("""SELECT id, annual_inc FROM loans WHERE annual_inc > 0
             AND annual_inc <= (SELECT quantile_cont(annual_inc, 0.99) FROM loans)"""),
)
def trim_above_quantile(spark, sf):
    return E.trim_above_quantile(V.loans(spark, sf, "id", "annual_inc"), "annual_inc", positive=True)


@register(
    "P20_log10_feature",
    query("""SELECT id, round(log10(CASE WHEN annual_inc > 0 THEN annual_inc END), 9) AS log_inc FROM loans"""),
)
def log10_feature(spark, sf):
    rows = E.log10_feature(V.loans(spark, sf, "id", "annual_inc"), "annual_inc", "log_inc")
    return rows.select("id", F.round("log_inc", 9).alias("log_inc"))


@register(
    "P21_percent_to_double",
    query("SELECT id, replace(int_rate, '%', '')::DOUBLE AS int_rate FROM raw_loans"),
)
def percent_to_double(spark, sf):
    return E.percent_to_double(V.raw_loans(spark, sf, "id", "int_rate"))


@register(
    "P22_band",
    query("""SELECT id, CASE WHEN v > 580 AND v <= 620 THEN '580-620' WHEN v > 620 AND v <= 660 THEN '620-660'
             WHEN v > 660 AND v <= 700 THEN '660-700' WHEN v > 700 AND v <= 740 THEN '700-740'
             WHEN v > 740 AND v <= 780 THEN '740-780' WHEN v > 780 AND v <= 850 THEN '780-850' END AS band,
             CASE WHEN v > 580 AND v <= 850 THEN least(ceil((v - 580) / 40)::INTEGER - 1, 5) END AS band_index
             FROM (SELECT id, fico_range_high AS v FROM loans)"""),
)
def band(spark, sf):
    return E.band(V.loans(spark, sf, "id", "fico_range_high"), "fico_range_high").drop("fico_range_high")


@register(
    "P23_year_month",
    query("""SELECT id, strftime(d, '%Y-%m') AS ym FROM
             (SELECT id, """ + sql_date("earliest_cr_line") + """ AS d FROM raw_loans) WHERE d IS NOT NULL"""),
)
def year_month(spark, sf):
    return E.year_month(V.raw_loans(spark, sf, "id", "earliest_cr_line"), "earliest_cr_line").drop("earliest_cr_line")


@register(
    "P26_code_to_label",
    query("""SELECT id, CASE target_default WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Charge Off' END AS status
             FROM labelled"""),
)
def code_to_label(spark, sf):
    return E.code_to_label(V.labelled(spark, sf, "id"), "target_default").select("id", "status")


@register(
    "P27_margin_to_probability",
    query("SELECT id, round(1 / (1 + exp(-((int_rate - 17) / 4))), 9) AS probability FROM loans"),
)
def margin_to_probability(spark, sf):
    chance = E.margin_to_probability((col("int_rate") - 17) / 4)
    return V.loans(spark, sf, "id", "int_rate").select("id", F.round(chance, 9).alias("probability"))


MEDIAN = ["loan_amnt", "open_acc", "revol_util", "annual_inc"]


@register(
    "A10_median_fill",
    query("SELECT id, " + ", ".join(
        f"coalesce({c}, (SELECT median({c}) FROM loans)) AS {c}" for c in MEDIAN) + " FROM loans"),
)
def median_fill(spark, sf):
    return C.median_fill(V.loans(spark, sf, "id", *MEDIAN))


CLIP = ["loan_amnt", "annual_inc", "revol_util", "installment"]


@register(
    "A26_clip_outliers",
    query(
        "SELECT id, " + ", ".join(
            f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, q3_{c} + 1.5 * (q3_{c} - q1_{c})), "
            f"q1_{c} - 1.5 * (q3_{c} - q1_{c})) END AS {c}" for c in CLIP
        ) + " FROM loans, quartiles",
        "quartiles AS (SELECT " + ", ".join(
            f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in CLIP
        ) + " FROM loans)",
    ),
)
def clip_outliers(spark, sf):
    return C.clip_outliers(materialize(V.loans(spark, sf, "id", *CLIP)))


@register(
    "W2_drop_duplicates_keep_first",
    """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus) AS r FROM lineitem) WHERE r = 1""",
)
def drop_duplicates_keep_first(spark, sf):
    lines = V.table(spark, sf, "lineitem")
    return C.drop_duplicates_keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("D1_distinct_rows", query("SELECT DISTINCT id, term, loan_amnt FROM raw_loans"))
def distinct_rows(spark, sf):
    return C.distinct_rows(V.raw_loans(spark, sf, "id", "term", "loan_amnt"))


@register("L1_sort_by_date", query("SELECT id, issue_d FROM loans ORDER BY issue_d"))
def sort_by_date(spark, sf):
    return C.sort_by_date(V.loans(spark, sf, "id", "issue_d"))


@register(
    "W3_ordinal_encode_desc",
    query("""SELECT id, i AS sub_grade FROM loans JOIN
             (SELECT sub_grade, (dense_rank() OVER (ORDER BY sub_grade DESC) - 1)::INTEGER AS i
              FROM (SELECT DISTINCT sub_grade FROM loans)) USING (sub_grade)"""),
)
def ordinal_encode_desc(spark, sf):
    return E.ordinal_encode_desc(V.loans(spark, sf, "id", "sub_grade"))


OWNERS = ["ANY", "MORTGAGE", "NONE", "OWN", "RENT"]
CHECKED = ["Not Verified", "Source Verified", "Verified"]


@register(
    "M1_one_hot_encode_columns",
    query("SELECT id, " + ", ".join(
        [f"(home_ownership = '{v}')::INTEGER AS \"home_ownership_{v}\"" for v in OWNERS]
        + [f"(verification_status = '{v}')::INTEGER AS \"verification_status_{v}\"" for v in CHECKED]
    ) + " FROM loans"),
)
def one_hot_encode_columns(spark, sf):
    rows = V.loans(spark, sf, "id", "home_ownership", "verification_status")
    return E.one_hot_encode_columns(rows, ["home_ownership", "verification_status", "absent"])
