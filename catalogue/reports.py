"""Grouped, distribution and correlation reports, and profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalogue import views as V
from catalogue.registry import register
from catalogue.sql import query, stacked
from catalogue.tables import rounded
from riskloom.functions.exprs import col
from riskloom.operators import correlation, distribution, encoding, grouping, information, profiling
from riskloom.operators.labels import filter_loan_status, known_target
from riskloom.session import materialize

NUM = ["loan_amnt", "int_rate", "revol_util", "annual_inc", "total_pymnt", "fico_range_low",
       "open_acc", "installment", "dti"]
CAT = ["term", "sub_grade", "emp_length", "home_ownership", "verification_status", "purpose"]


def _rate(key: str, where: str = "true", counted: str = "target_default") -> str:
    return f"""SELECT {key}, round(avg(target_default), 9) AS default_rate, count({counted}) AS n
               FROM labelled WHERE {key} IS NOT NULL AND {where} GROUP BY {key}"""


def _rates(spark, sf, key, **options):
    rows = V.labelled(spark, sf, key)
    return rounded(grouping.default_rate_by(rows, key, **options), 9)


@register("A1_default_rate_by_sub_grade", query(_rate("sub_grade")))
def by_sub_grade(spark, sf):
    return _rates(spark, sf, "sub_grade")


@register("A1_default_rate_by_home_ownership", query(_rate("home_ownership")))
def by_home_ownership(spark, sf):
    return _rates(spark, sf, "home_ownership")


@register("A1_default_rate_by_verification", query(_rate("verification_status")))
def by_verification(spark, sf):
    return _rates(spark, sf, "verification_status")


@register("A1_default_rate_by_term", query(_rate("term")))
def by_term(spark, sf):
    return _rates(spark, sf, "term")


@register("A1_default_rate_by_purpose",
          query(_rate("purpose", "target_default IS NOT NULL", "purpose")))
def by_purpose(spark, sf):
    rows = known_target(V.labelled(spark, sf, "purpose"))
    return rounded(grouping.default_rate_by(rows, "purpose", count_keys=True), 9)


@register(
    "A1_default_rate_by_emp_years",
    query("""SELECT emp_yrs, round(avg(target_default), 9) AS default_rate, count(target_default) AS n FROM (
             SELECT target_default, try_cast(regexp_replace(emp_length, '\\D', '', 'g') AS DOUBLE) AS emp_yrs
             FROM labelled) WHERE emp_yrs IS NOT NULL GROUP BY emp_yrs"""),
)
def by_emp_years(spark, sf):
    rows = encoding.emp_years_digits(V.labelled(spark, sf, "emp_length"))
    return rounded(grouping.default_rate_by(rows, "emp_yrs").withColumnRenamed("emp_yrs", "years"), 9,
                   "default_rate").withColumnRenamed("years", "emp_yrs")


@register(
    "A1_default_rate_by_fico_band",
    query("""SELECT CASE WHEN v <= 580 OR v > 850 THEN NULL WHEN v <= 620 THEN '580-620'
             WHEN v <= 660 THEN '620-660' WHEN v <= 700 THEN '660-700' WHEN v <= 740 THEN '700-740'
             WHEN v <= 780 THEN '740-780' ELSE '780-850' END AS band,
             round(avg(target_default), 9) AS default_rate, count(target_default) AS n
             FROM (SELECT fico_range_high AS v, target_default FROM labelled) GROUP BY 1
             HAVING band IS NOT NULL"""),
)
def by_fico_band(spark, sf):
    rows = encoding.band(V.labelled(spark, sf, "fico_range_high"), "fico_range_high")
    return rounded(grouping.default_rate_by(rows, "band"), 9)


@register(
    "A2_default_by_category",
    query(
        """SELECT "column", "value", round(avg(target_default) FILTER (filled), 9) AS default_rate,
           count(target_default) FILTER (filled) AS n FROM (
             SELECT *, coalesce("value", 'nan') IN (SELECT v FROM top t WHERE t."column" = cells."column") AS kept,
                    "value" IS NOT NULL AS filled FROM cells)
           WHERE kept AND filled GROUP BY 1, 2""",
        "cells AS (" + stacked(
            "SELECT '{n}' AS \"column\", {c} AS \"value\", target_default FROM labelled",
            [*CAT, "loan_status"]) + ")",
        """top AS (SELECT "column", v FROM (SELECT "column", coalesce("value", 'nan') AS v,
             row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, coalesce("value", 'nan')) AS r
             FROM cells GROUP BY 1, 2) WHERE r <= 8)""",
    ),
)
def default_by_category(spark, sf):
    rows = V.labelled(spark, sf, *CAT, "emp_title")
    return rounded(grouping.default_by_category(rows), 9)


@register(
    "A3_monthly_trend",
    query("""SELECT strftime(issue_d, '%Y-%m') AS ym, count(loan_amnt) AS n_loans,
             round(avg(target_default), 9) AS default_rate, round(avg(loan_amnt), 6) AS avg_loan
             FROM labelled WHERE issue_d IS NOT NULL GROUP BY 1"""),
)
def monthly_trend(spark, sf):
    trend = grouping.monthly_trend(V.labelled(spark, sf, "issue_d", "loan_amnt"))
    return rounded(rounded(trend, 9, "default_rate"), 6, "avg_loan")


@register(
    "A4_value_counts",
    query("""SELECT loan_status AS "value", count(*) AS n FROM loans GROUP BY 1"""),
)
def value_counts(spark, sf):
    return grouping.value_counts(V.loans(spark, sf, "loan_status"), "loan_status", with_nulls=True)


@register(
    "A5_target_distribution",
    query("""SELECT n1 AS n_default, n0 AS n_non_default, round(n0::DOUBLE / n1::DOUBLE, 2) AS imbalance_ratio,
             round(n0::DOUBLE / (n0 + n1)::DOUBLE, 4) AS majority_baseline_acc FROM (
             SELECT count(*) FILTER (target_default = 1) AS n1, count(*) FILTER (target_default = 0) AS n0
             FROM labelled)"""),
)
def target_distribution(spark, sf):
    return grouping.target_distribution(V.labelled(spark, sf))


@register(
    "A6_describe_numeric",
    query(stacked(
        """SELECT '{n}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
           round(stddev_samp({c}), 4) AS std, min({c}) AS "min", quantile_cont({c}, 0.25) AS q25,
           quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS "max" FROM loans""",
        NUM)),
)
def describe_numeric(spark, sf):
    table = distribution.describe_numeric(materialize(V.loans(spark, sf, *NUM)))
    return rounded(rounded(table, 6, "mean"), 4, "std")


@register(
    "A6_describe_categorical",
    query(stacked(
        """SELECT '{n}' AS "column", sum(n)::BIGINT AS "count", count(*) AS "unique",
           min(v) FILTER (n = m) AS "top", max(n) AS freq FROM (
             SELECT {c} AS v, count(*) AS n, max(count(*)) OVER () AS m FROM loans
             WHERE {c} IS NOT NULL GROUP BY 1)""", CAT)),
)
def describe_categorical(spark, sf):
    return distribution.describe_categorical(V.loans(spark, sf, *CAT))


MISSING = ["issue_d", "loan_amnt", "delinq_2yrs", "mths_since_last_delinq", "open_acc", "emp_length",
           "loan_status", "term"]


@register(
    "A7_missing_fraction",
    query("""SELECT *, CASE WHEN missing > 0.5 THEN 'high' WHEN missing > 0.2 THEN 'medium' ELSE 'low' END
             AS severity FROM (""" + stacked(
        "SELECT '{n}' AS \"column\", round(count(*) FILTER ({c} IS NULL)::DOUBLE / count(*), 9) AS missing "
        "FROM loans", MISSING) + ") WHERE missing > 0"),
)
def missing_fraction(spark, sf):
    return rounded(profiling.missing_fraction(V.loans(spark, sf, *MISSING)), 9)


@register(
    "A8_total_nulls",
    query("SELECT (" + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in MISSING)
          + ")::BIGINT AS total_nulls FROM loans"),
)
def total_nulls(spark, sf):
    return profiling.total_nulls(V.loans(spark, sf, *MISSING))


@register(
    "A9_business_statistics",
    query("""SELECT round(avg(total_pymnt) FILTER (loan_status = 0)
               - avg(loan_amnt) FILTER (loan_status = 0), 6) AS avg_loan_profit,
             round(avg(loan_amnt) FILTER (loan_status = 1)
               - avg(total_pymnt) FILTER (loan_status = 1), 6) AS avg_loan_loss,
             round(avg(loan_amnt), 6) AS avg_loan_amount FROM modelled"""),
)
def business_statistics(spark, sf):
    rows = filter_loan_status(V.loans(spark, sf, "loan_status", "loan_amnt", "total_pymnt"))
    return rounded(grouping.business_statistics(rows))


@register(
    "A11_extreme_groups",
    query("""SELECT min(sub_grade) FILTER (r = lo) AS best, min(lo) AS best_rate,
             min(sub_grade) FILTER (r = hi) AS worst, max(hi) AS worst_rate FROM (
             SELECT *, min(r) OVER () AS lo, max(r) OVER () AS hi FROM (
             SELECT sub_grade, round(avg(target_default), 9) AS r FROM labelled GROUP BY 1))"""),
)
def extreme_groups(spark, sf):
    return grouping.extreme_groups(by_sub_grade(spark, sf), "sub_grade")


DIFF = ["loan_amnt", "annual_inc", "installment", "dti", "int_rate", "revol_util",
        "fico_range_high", "avg_cur_bal"]


@register(
    "A12_class_mean_difference",
    query(stacked(
        """SELECT '{n}' AS "column", round(a, 6) AS mean_non_default, round(b, 6) AS mean_default,
           round(b - a, 6) AS difference FROM (SELECT avg({c}) FILTER (target_default = 0) AS a,
           avg({c}) FILTER (target_default = 1) AS b FROM labelled)""", DIFF)),
)
def class_mean_difference(spark, sf):
    return rounded(grouping.class_mean_difference(V.labelled(spark, sf, *DIFF)))


@register(
    "A13_histogram",
    query("""SELECT bin, lo + bin * w AS left_edge, lo + (bin + 1) * w AS right_edge, count(*) AS n FROM (
             SELECT least(floor((total_pymnt - lo) / w), 39)::INTEGER AS bin, lo, w FROM loans,
             (SELECT min(total_pymnt) AS lo, (max(total_pymnt) - min(total_pymnt)) / 40 AS w FROM loans))
             GROUP BY bin, lo, w"""),
)
def histogram(spark, sf):
    return distribution.histogram(V.loans(spark, sf, "total_pymnt"), "total_pymnt")


@register(
    "A14_boxplot_stats",
    query("""SELECT target_default::VARCHAR AS "group", q1, median, q3,
             min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
             max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
             count(*) FILTER (v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
             FROM (SELECT target_default, installment AS v FROM labelled) JOIN (
               SELECT target_default, quantile_cont(installment, 0.25) AS q1,
               quantile_cont(installment, 0.5) AS median, quantile_cont(installment, 0.75) AS q3
               FROM labelled GROUP BY 1) USING (target_default)
             WHERE target_default IS NOT NULL GROUP BY 1, 2, 3, 4"""),
)
def boxplot_stats(spark, sf):
    rows = materialize(V.labelled(spark, sf, "installment"))
    return distribution.boxplot_stats(rows, "installment", "target_default")


@register(
    "A15_kde",
    query("""SELECT g::VARCHAR AS "group", i::INTEGER AS point, round(x, 6) AS x, round(sum(w * exp(-0.5::DOUBLE * ((x - v) / h) ** 2))
             / (n * h * sqrt(2 * pi())), 9) AS density FROM (
               SELECT g, v, w, n, h, i, lo - (hi - lo) / 2 + i * (2 * (hi - lo) / 999) AS x FROM (
                 SELECT target_default AS g, loan_amnt AS v, count(*) AS w FROM labelled
                 WHERE target_default IS NOT NULL GROUP BY 1, 2)
               JOIN (SELECT target_default AS g, count(loan_amnt) AS n, min(loan_amnt) AS lo,
                 max(loan_amnt) AS hi,
                 stddev_samp(loan_amnt) * count(loan_amnt) ** (-0.2::DOUBLE) AS h
                 FROM labelled WHERE target_default IS NOT NULL GROUP BY 1) USING (g),
               range(1000) AS r(i))
             GROUP BY g, i, x, n, h"""),
)
def kde(spark, sf):
    rows = V.labelled(spark, sf, "loan_amnt")
    found = distribution.kde(rows, "loan_amnt", by="target_default", cells=None)
    return rounded(rounded(found, 6, "x"), 9, "density")


@register(
    "A15_kde_in_cells",
    query("""SELECT g::VARCHAR AS "group", i::INTEGER AS point, round(x, 6) AS x, round(sum(w * exp(-0.5::DOUBLE * ((x - v) / h) ** 2))
             / (n * sqrt(2 * pi())), 8) AS density_times_bandwidth FROM (
               SELECT g, v, w, n, h, i, lo - (hi - lo) / 2 + i * (2 * (hi - lo) / 999) AS x FROM (
                 SELECT target_default AS g, n, lo, hi, h, avg(loan_amnt) AS v, count(*) AS w FROM labelled
                 JOIN (SELECT target_default, count(loan_amnt) AS n, min(loan_amnt) AS lo, max(loan_amnt) AS hi,
                   stddev_samp(loan_amnt) * count(loan_amnt) ** (-0.2::DOUBLE) AS h
                   FROM labelled GROUP BY 1) USING (target_default)
                 WHERE loan_amnt IS NOT NULL GROUP BY 1, 2, 3, 4, 5, floor((loan_amnt - lo) / (h / 64))),
               range(1000) AS r(i))
             GROUP BY g, i, x, n, h"""),
)
def kde_in_cells(spark, sf):
    """The density of the default cells, times the bandwidth."""
    rows = materialize(V.labelled(spark, sf, "loan_amnt"))
    width = rows.groupBy(F.col("target_default").cast("string").alias("group")).agg(
        (F.stddev_samp("loan_amnt") * F.pow(F.count("loan_amnt").cast("double"), F.lit(-0.2))).alias("h")
    )
    found = distribution.kde(rows, "loan_amnt", by="target_default").join(width, "group")
    scaled = found.select("group", "point", "x", (F.col("density") * F.col("h")).alias("density_times_bandwidth"))
    return rounded(rounded(scaled, 6, "x"), 8, "density_times_bandwidth")


@register(
    "A16_pearson_matrix",
    query("\nUNION ALL\n".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM loans"
        for a in NUM for b in NUM)),
)
def pearson_matrix(spark, sf):
    return rounded(correlation.pearson_matrix(V.loans(spark, sf, *NUM)))


CORR = ["loan_amnt", "funded_amnt", "total_pymnt", "fico_range_low", "fico_range_high", "annual_inc",
        "avg_cur_bal", "installment", "revol_bal"]
PAIRS = "pairs AS (" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM loans" for a, b in combinations(CORR, 2)
) + ")"


@register(
    "A17_high_correlation_pairs",
    query("SELECT a AS column_a, b AS column_b, round(r, 4) AS correlation FROM pairs WHERE abs(r) >= 0.8",
          PAIRS),
)
def high_correlation_pairs(spark, sf):
    return correlation.high_correlation_pairs(V.loans(spark, sf, *CORR))


@register(
    "A17_multicollinearity_risk",
    query("""SELECT n AS n_pairs, CASE WHEN n >= 30 THEN 'high' WHEN n >= 10 THEN 'moderate' ELSE 'low' END
             AS risk FROM (SELECT count(*) AS n FROM pairs WHERE abs(r) >= 0.8)""", PAIRS),
)
def multicollinearity_risk(spark, sf):
    return correlation.multicollinearity_risk(high_correlation_pairs(spark, sf))


@register(
    "A18_top_corr_pairs",
    query("""SELECT a AS feature_1, b AS feature_2, round(abs(r), 6) AS abs_corr FROM pairs
             ORDER BY abs(r) DESC, a, b LIMIT 15""", PAIRS),
)
def top_corr_pairs(spark, sf):
    return rounded(correlation.top_corr_pairs(V.loans(spark, sf, *CORR)))


@register(
    "A19_moments",
    query(stacked(
        """SELECT '{n}' AS "column", round(avg(d ** 3) / avg(d ** 2) ** 1.5::DOUBLE, 4) AS skewness,
           round(avg(d ** 4) / avg(d ** 2) ** 2 - 3, 4) AS kurtosis FROM (
             SELECT {c} - (SELECT avg({c}) FROM loans) AS d FROM loans)""", NUM)),
)
def moments(spark, sf):
    return distribution.moments(V.loans(spark, sf, *NUM))


TESTED = ["annual_inc", "installment", "total_pymnt", "loan_amnt"]


@register(
    "A20_ks_normality",
    # The normal distribution function by its series through gamma values, the p-value by the alternating series.
    query("""SELECT "column", round(d, 6) AS ks_statistic, round(least(greatest(
             CASE WHEN x < 0.3 THEN 1 ELSE (SELECT 2 * sum((-1) ** (j - 1) * exp(-2 * j * j * x * x))
               FROM range(1, 101) AS r(j)) END, 0), 1), 6) AS p_value
             FROM (SELECT "column", d, d * sqrt(t) + 1 / (6 * sqrt(t)) + (d * sqrt(t) - 1) / (4 * t) AS x FROM (
               SELECT "column", t, max(greatest(abs(upto / t - p), abs((upto - n) / t - p))) AS d FROM (
                 SELECT "column", t, n, upto, 0.5 + sign(z) * sum(exp((2 * k + 1) * ln(greatest(abs(z), 1e-300)) - z * z / 2
                   - (k + 1) * ln(2) - lgamma(k + 1.5))) / sqrt(2) AS p FROM (
                   SELECT "column", t, n, (v - m) / s AS z,
                     sum(n) OVER (PARTITION BY "column" ORDER BY v)::DOUBLE AS upto FROM (
                     SELECT "column", v, count(*) AS n FROM cells GROUP BY 1, 2)
                   JOIN (SELECT "column", count(*)::DOUBLE AS t, avg(v) AS m, stddev_samp(v) AS s
                     FROM cells GROUP BY 1) USING ("column")), range(150) AS q(k)
                 GROUP BY "column", t, n, upto, z) GROUP BY 1, 2))""",
          "cells AS (" + stacked("SELECT '{n}' AS \"column\", {c} AS v FROM loans WHERE {c} IS NOT NULL", TESTED) + ")"),
)
def ks_normality(spark, sf):
    return distribution.ks_normality(materialize(V.loans(spark, sf, *TESTED)))


@register(
    "A21_duplicate_rows",
    query("""SELECT coalesce(sum(n - 1), 0)::BIGINT AS surplus_rows, coalesce(sum(n), 0)::BIGINT AS duplicate_rows
             FROM (SELECT count(*) AS n FROM raw_loans
             GROUP BY id, issue_d, loan_amnt, term, home_ownership HAVING count(*) > 1)"""),
)
def duplicate_rows(spark, sf):
    return profiling.duplicate_rows(
        V.raw_loans(spark, sf, "id", "issue_d", "loan_amnt", "term", "home_ownership")
    )


@register(
    "A21_sample_duplicates",
    """SELECT DISTINCT l_orderkey FROM (SELECT l_orderkey FROM lineitem
       GROUP BY l_orderkey, l_linenumber, l_returnflag HAVING count(*) > 1 ORDER BY l_orderkey LIMIT 5)""",
)
def sample_duplicates(spark, sf):
    lines = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return profiling.sample_duplicates(lines, "l_orderkey").distinct()


PROFILED = ["home_ownership", "emp_title", "id", "purpose", "loan_amnt"]
CELLS = "cells AS (" + stacked(
    "SELECT '{n}' AS \"column\", {c} AS v FROM raw_loans WHERE {c} IS NOT NULL AND lower({c}) <> 'nan'",
    PROFILED) + ")"


@register(
    "A22_profile_categorical",
    query("""SELECT "column", u AS unique_count, nu < u AS inconsistent, CASE WHEN u = n THEN 'all_unique'
             WHEN u = 1 THEN 'constant' WHEN u > 0.5 * n THEN 'high_cardinality' END AS cardinality_flag FROM (
             SELECT "column", count(*) AS n, count(DISTINCT v) AS u, count(DISTINCT lower(trim(v))) AS nu
             FROM cells GROUP BY 1)""", CELLS),
)
def profile_categorical(spark, sf):
    return profiling.profile_categorical(V.raw_loans(spark, sf, *PROFILED))


@register(
    "A22_top_values",
    query("""SELECT "column", v AS "value", n, r::INTEGER AS place FROM (SELECT "column", v, count(*) AS n,
             row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, v) AS r FROM cells GROUP BY 1, 2)
             WHERE r <= 5""", CELLS),
)
def top_values(spark, sf):
    return profiling.top_values(V.raw_loans(spark, sf, *PROFILED))


MIXED = ["id", "funded_amnt", "dti", "loan_amnt", "int_rate", "purpose", "open_acc"]


@register(
    "A23_suspected_type_mismatch",
    query("SELECT * FROM (" + stacked(
        """SELECT '{n}' AS "column", round(count(try_cast({c} AS DOUBLE))::DOUBLE
           / greatest(count({c}), 1), 9) AS numeric_share FROM raw_loans""", MIXED)
        + ") WHERE numeric_share > 0.8"),
)
def suspected_type_mismatch(spark, sf):
    return rounded(profiling.suspected_type_mismatch(V.raw_loans(spark, sf, *MIXED)), 9)


@register(
    "A24_profile_table",
    query(f"""SELECT count(*) AS n_rows, 8 AS n_cols, 4 AS n_numeric, 3 AS n_text,
             ({" + ".join(f"count(*) FILTER ({c} IS NULL)" for c in MISSING)})::BIGINT AS total_nulls,
             (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM loans
              GROUP BY {", ".join(MISSING)})) AS surplus_rows FROM loans"""),
)
def profile_table(spark, sf):
    return profiling.profile_table(V.loans(spark, sf, *MISSING))


TYPED = {"id": "bigint", "loan_amnt": "double", "open_acc": "double", "emp_length": "string",
         "loan_status": "string"}


@register(
    "A24_column_types",
    query("\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) FILTER ({c} IS NULL) AS n_nulls,
            count({c}) AS n_values FROM loans""" for c, t in TYPED.items())),
)
def column_types(spark, sf):
    return profiling.column_types(V.loans(spark, sf, *TYPED))


@register(
    "A25_iqr_bounds",
    query("SELECT *, q1 - 1.5 * (q3 - q1) AS \"lower\", q3 + 1.5 * (q3 - q1) AS \"upper\" FROM (" + stacked(
        """SELECT '{n}' AS "column", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3
           FROM loans""", NUM) + ")"),
)
def iqr_bounds(spark, sf):
    return distribution.iqr_bounds_table(V.loans(spark, sf, *NUM))


ANOVA = ["int_rate", "revol_util", "annual_inc", "total_pymnt", "fico_range_low", "open_acc"]
ANOVA_SQL = stacked(
    """SELECT '{n}' AS feature, (sum(n * (m - g) ** 2) / (count(*) - 1))
       / (sum(n * v) / (sum(n) - count(*))) AS f FROM (
         SELECT n, m, v, sum(n * m) OVER () / sum(n) OVER () AS g FROM (
           SELECT count({c})::DOUBLE AS n, avg({c}) AS m, var_pop({c}) AS v FROM modelled
           GROUP BY loan_status))""", ANOVA)


@register("A31_anova_f_scores", query(f"SELECT feature, round(f, 4) AS f_score FROM ({ANOVA_SQL})"))
def anova_f_scores(spark, sf):
    rows = filter_loan_status(V.loans(spark, sf, "loan_status", *ANOVA))
    return rounded(correlation.anova_f_scores(rows, "loan_status", ANOVA), 4)


MI = ["int_rate", "annual_inc", "open_acc"]


@register(
    "A32_mutual_information",
    query("""SELECT feature, round(sum(n / t * ln(n * t / (b * l))), 6) AS mutual_info FROM (
             SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS t,
                    sum(n) OVER (PARTITION BY feature, bin) AS b,
                    sum(n) OVER (PARTITION BY feature, label) AS l FROM (
               SELECT feature, label, len(list_filter(edges, lambda e: v > e)) AS bin, count(*)::DOUBLE AS n
               FROM (""" + stacked(
        """SELECT '{n}' AS feature, {c} AS v, loan_status AS label,
           (SELECT list_distinct(quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) FROM modelled)
           AS edges FROM modelled""", MI) + """) WHERE v IS NOT NULL GROUP BY 1, 2, 3)) GROUP BY feature"""),
)
def mutual_information(spark, sf):
    rows = filter_loan_status(V.loans(spark, sf, "loan_status", *MI))
    return rounded(correlation.mutual_information(rows, "loan_status", MI))


NEAR_MI = ["int_rate", "annual_inc", "installment", "total_pymnt"]


@register(
    "A32_nearest_mutual_information",
    query("""SELECT feature, round(greatest(max(h[t::INTEGER]) + sum(n * (h[kk::INTEGER] - h[c::INTEGER] - h[m::INTEGER])) / max(t), 0), 6)
             AS mutual_info FROM (
               SELECT s.feature, s.y, s.v, s.n, s.c, s.t, CASE WHEN r = 0 THEN s.n - 1 ELSE least(3, s.c - 1) END AS kk, sum(p.n) AS m
               FROM (SELECT feature, y, v, n, c, t, CASE WHEN n - 1 >= least(3, c - 1) THEN 0
                       ELSE min(d) FILTER (cum >= least(3, c - 1) - (n - 1)) END AS r FROM (
                       SELECT *, sum(e.n) OVER (PARTITION BY feature, y, v ORDER BY abs(e.v - v)) AS cum, abs(e.v - v) AS d FROM (
                         SELECT feature, y, v, n, c, t, unnest(coalesce(nullif(near, []), [{'v': v, 'n': 0}])) AS e FROM (
                           SELECT *, list({'v': v, 'n': n}) OVER (PARTITION BY feature, y ORDER BY v
                             ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING EXCLUDE CURRENT ROW) AS near FROM points)))
                     GROUP BY feature, y, v, n, c, t) AS s
               JOIN points AS p ON p.feature = s.feature AND (p.v = s.v OR abs(p.v - s.v) < s.r)
               GROUP BY ALL), psi GROUP BY feature""",
          "cells AS (" + stacked("""SELECT '{n}' AS feature, {c} AS v, loan_status AS y FROM modelled WHERE {c} IS NOT NULL""", NEAR_MI) + ")",
          """points AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS t FROM (
             SELECT feature, y, v, n, sum(n) OVER (PARTITION BY feature, y) AS c FROM (
               SELECT feature, y, v, count(*) AS n FROM cells GROUP BY 1, 2, 3)) WHERE c > 1)""",
          """psi AS (SELECT list(h ORDER BY i) AS h FROM (
             SELECT i, -0.57721566490153286 + coalesce(sum(1 / i) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS h
             FROM range(1, (SELECT max(t) + 1 FROM points)::BIGINT) AS r(i)))"""),
)
def nearest_mutual_information(spark, sf):
    rows = materialize(filter_loan_status(V.loans(spark, sf, "loan_status", *NEAR_MI)))
    return rounded(information.nearest_mutual_information(rows, "loan_status", NEAR_MI))


@register(
    "A34_class_weight_ratio",
    query("""SELECT round(r, 9) AS ratio, round(r * 0.5, 9) AS half, round(r * 1.5, 9) AS one_and_half FROM (
             SELECT count(*) FILTER (loan_status = 0) / (count(*) FILTER (loan_status = 1) + 1e-6::DOUBLE) AS r
             FROM modelled)"""),
)
def class_weight_ratio(spark, sf):
    rows = filter_loan_status(V.loans(spark, sf, "loan_status"))
    return rounded(grouping.class_weight_ratio(rows, "loan_status"), 9)


ZS = ["int_rate", "annual_inc", "open_acc"]


@register(
    "W4_zscore_columns",
    query("SELECT id, " + ", ".join(
        f"{c}, round(({c} - (SELECT avg({c}) FROM loans)) / (SELECT stddev_pop({c}) FROM loans), 6) "
        f"AS {c}_zscore" for c in ZS) + " FROM loans"),
)
def zscore_columns(spark, sf):
    rows = distribution.zscore_columns(V.loans(spark, sf, "id", *ZS), ZS)
    return rounded(rows, 6, *[f"{c}_zscore" for c in ZS])


@register(
    "L2_top_k",
    query("SELECT id, total_pymnt FROM loans ORDER BY total_pymnt DESC, id LIMIT 20"),
)
def top_k(spark, sf):
    rows = V.loans(spark, sf, "id", "total_pymnt")
    return grouping.top_k(rows, [F.desc("total_pymnt"), col("id")], 20)
