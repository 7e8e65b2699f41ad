"""Sources, sinks and joins."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from catalogue import views as V
from catalogue.registry import register
from catalogue.sql import columns, query
from riskloom import schemas as S
from riskloom.functions.exprs import attach_scalars, col
from riskloom.operators import cleaning, correlation, encoding, grouping, joins, scoring
from riskloom.session import staging_dir
from riskloom.sources import readers, writers

RAW_COLUMNS = ["id", "issue_d", "loan_amnt", "int_rate", "term", "sub_grade", "loan_status"]
SCORED_FEATURES = ["int_rate", "revol_util", "total_pymnt", "open_acc"]


def _scratch(spark, name):
    return f"{staging_dir(spark).rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


@register("S1_read_loans", query(f"SELECT {', '.join(RAW_COLUMNS)} FROM raw_loans"))
def read_loans(spark, sf):
    path = _scratch(spark, "landing") + ".csv"
    writers.write_table(V.raw_loans(spark, sf, *RAW_COLUMNS), path)
    return readers.read_loans(spark, path)


@register(
    "S2_project_available",
    query(f"SELECT {', '.join(c for c in S.LOAN_COLUMNS if c in [*V.NUMBER_NAMES, *V.TEXT_NAMES, 'issue_d'])} FROM loans"),
)
def project_available(spark, sf):
    return readers.project_available(V.loans(spark, sf), S.LOAN_COLUMNS)


@register("S3_read_columns", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def read_columns(spark, sf):
    wanted = ["o_orderkey", "o_totalprice", "o_orderstatus", "not_there"]
    return readers.read_columns(spark, f"{sf}/orders.parquet", wanted)


@register(
    "S4_read_observations",
    """SELECT year(m)::INTEGER AS "Year", month(m)::INTEGER AS "Month", n::VARCHAR AS "Shipments"
       FROM (SELECT date_trunc('month', l_shipdate) AS m, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def read_observations(spark, sf):
    monthly = (
        V.table(spark, sf, "lineitem")
        .groupBy(F.date_trunc("month", "l_shipdate").alias("m"))
        .agg(F.count(F.lit(1)).cast("string").alias("value"))
    )
    path = land_series(spark, monthly.select("m", "value"))
    return readers.read_observations(spark, path, "Shipments")


def land_series(spark, monthly):
    """Months and values as the one JSON document that a series arrives as; its folder."""
    item = F.struct(F.date_format("m", "yyyy-MM-dd").alias("date"), F.col("value"))
    path = _scratch(spark, "series")
    monthly.agg(F.collect_list(item).alias("observations")).coalesce(1).write.json(path)
    return path


def land_indicators(spark, sf):
    """{series: folder} of the three indicator series."""
    month = F.make_date("Year", "Month", F.lit(1)).alias("m")
    return {
        name: land_series(spark, series.select(month, col(name).cast("string").alias("value")))
        for name, series in zip(V.SERIES, V.indicators(spark, sf), strict=True)
    }


@register(
    "S5_read_indicator_set",
    query("""SELECT s.* FROM (SELECT 'CPI' AS series, "Year", "Month", "CPI"::DOUBLE AS value FROM cpi
             UNION ALL SELECT 'Unemployment Rate', "Year", "Month", "Unemployment Rate" FROM unemployment
             UNION ALL SELECT 'Federal Funds Rate', "Year", "Month", "Federal Funds Rate" FROM fed_funds) s,
             (SELECT date_trunc('month', min(issue_d)) AS lo, date_trunc('month', max(issue_d)) AS hi FROM loans) e
             WHERE make_date("Year", "Month", 1) BETWEEN lo AND hi"""),
)
def read_indicator_set(spark, sf):
    paths = land_indicators(spark, sf)
    series = readers.read_indicator_set(spark, paths, V.loans(spark, sf, "issue_d"))
    long = [
        s.select(F.lit(name).alias("series"), "Year", "Month", readers.indicator_value(name).alias("value"))
        for name, s in zip(paths, series, strict=True)
    ]
    return reduce(lambda x, y: x.union(y), long)


@register("S6_write_table", query("SELECT id, issue_d, loan_amnt, term FROM loans"))
def write_table(spark, sf):
    path = _scratch(spark, "sink")
    writers.write_table(V.loans(spark, sf, "id", "issue_d", "loan_amnt", "term"), path)
    return readers.read_table(spark, path)


@register("J1_merge_indicators", query("SELECT * FROM indicators"))
def merge_indicators(spark, sf):
    return joins.merge_indicators(V.indicators(spark, sf))


def merged_loans(spark, sf, *names):
    rows = V.loans(spark, sf, "id", "issue_d", *names)
    return joins.merge_indicators_with_loans(rows, merge_indicators(spark, sf))


MERGED_SQL = """merged AS (
  SELECT l.*, "CPI", "Unemployment Rate", "Federal Funds Rate" FROM loans l LEFT JOIN indicators i
  ON year(l.issue_d) = i."Year" AND month(l.issue_d) = i."Month")"""


@register(
    "J2_merge_indicators_with_loans",
    query('SELECT id, issue_d, loan_amnt, "CPI", "Unemployment Rate", "Federal Funds Rate" FROM merged',
          MERGED_SQL),
)
def merge_indicators_with_loans(spark, sf):
    return merged_loans(spark, sf, "loan_amnt")


@register(
    "J3_feature_score_join",
    query(
        f"""SELECT feature, round(abs(r), 6) AS pearson_abs, round(difference, 6) AS difference FROM (
          {" UNION ALL ".join(
              f"SELECT '{c}' AS feature, corr({c}, target_default) AS r, "
              f"avg(CASE WHEN target_default = 1 THEN {c} END) - "
              f"avg(CASE WHEN target_default = 0 THEN {c} END) AS difference FROM labelled"
              for c in SCORED_FEATURES)})"""
    ),
)
def feature_score_join(spark, sf):
    rows = V.labelled(spark, sf, *SCORED_FEATURES)
    pearson = correlation.label_correlation(rows, "target_default", SCORED_FEATURES)
    gaps = grouping.class_mean_difference(rows, SCORED_FEATURES).select(
        F.col("column").alias("feature"), "difference"
    )
    joined = joins.feature_score_join(pearson, [gaps])
    return joined.select(
        "feature", F.round("pearson_abs", 6).alias("pearson_abs"),
        F.round("difference", 6).alias("difference"),
    )


def formula_scores(spark, sf):
    """A score table of fixed formulas: no default, and two cut-offs of one score."""
    rows = V.scored(spark, sf)
    models = {
        S.BASELINE_MODEL: (F.lit(0), F.lit(0.0)),
        "Cut 0.5": ((F.col("probability") > 0.5).cast("int"), F.col("probability")),
        "Cut 0.3": ((F.col("probability") > 0.3).cast("int"), F.col("probability") * 0.5),
    }
    parts = []
    for name, (said, chance) in models.items():
        told = rows.select("label", said.alias("prediction"), chance.alias("probability"))
        parts.append(scoring.score_row(scoring.score_counts(told), name, "test"))
    return scoring.score_table(parts)


AUC_SQL = """(SELECT sum(pos * (cum - neg + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) FROM (
    SELECT pos, neg, sum(neg) OVER (ORDER BY s) AS cum FROM (
      SELECT s, (count(*) FILTER (label = 1))::DOUBLE AS pos,
             (count(*) FILTER (label = 0))::DOUBLE AS neg FROM {rows} GROUP BY s)))"""

_SCORE = """SELECT '{name}' AS model, (tp + tn) / (tp + tn + fp + fn) AS acc,
  {auc} AS auc, coalesce(tp / nullif(tp + fp, 0), 0) AS prec, coalesce(tp / nullif(tp + fn, 0), 0) AS rec,
  coalesce(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 0) AS f2 FROM (
  SELECT count(*) FILTER (label = 1 AND {said})::DOUBLE AS tp,
         count(*) FILTER (label = 0 AND {said})::DOUBLE AS fp,
         count(*) FILTER (label = 1 AND NOT {said})::DOUBLE AS fn,
         count(*) FILTER (label = 0 AND NOT {said})::DOUBLE AS tn FROM scored)"""
SCORES_SQL = "scores AS (" + " UNION ALL ".join(
    _SCORE.format(
        name=name, said=said,
        auc=AUC_SQL.format(rows=f"(SELECT label, {score} AS s FROM scored)"),
    )
    for name, said, score in [
        (S.BASELINE_MODEL, "false", "0.0::DOUBLE"),
        ("Cut 0.5", "(probability > 0.5)", "probability"),
        ("Cut 0.3", "(probability > 0.3)", "probability * 0.5::DOUBLE"),
    ]
) + ")"


def rounded(df, places=6, *names):
    numeric = [c for c, t in df.dtypes if t == "double" and (not names or c in names)]
    return df.withColumns({c: F.round(col(c), places) for c in numeric})


@register(
    "J4_models_vs_baseline",
    query(
        f"""SELECT m.model AS "Model", round(m.acc - b.acc, 6) AS "Delta Accuracy",
        round(m.auc - b.auc, 6) AS "Delta ROC-AUC", round(m.f2 - b.f2, 6) AS "Delta F2-Score"
        FROM scores m, scores b WHERE b.model = '{S.BASELINE_MODEL}' AND m.model <> b.model""",
        SCORES_SQL,
    ),
)
def models_vs_baseline(spark, sf):
    return rounded(joins.models_vs_baseline(formula_scores(spark, sf), "test"))


@register(
    "L3_best_model",
    query(
        f"""SELECT model AS "Model", 'test' AS "Stage", round(acc, 6) AS "Accuracy",
        round(auc, 6) AS "ROC-AUC", round(prec, 6) AS "Precision", round(rec, 6) AS "Recall",
        round(f2, 6) AS "F2-Score" FROM scores WHERE model <> '{S.BASELINE_MODEL}'
        ORDER BY f2 DESC, model LIMIT 1""",
        SCORES_SQL,
    ),
)
def best_model(spark, sf):
    return rounded(scoring.best_model(formula_scores(spark, sf), "test"))


@register(
    "L4_ranked_scores",
    query(
        """SELECT model AS "Model", 'test' AS "Stage", round(acc, 6) AS "Accuracy",
        round(auc, 6) AS "ROC-AUC", round(prec, 6) AS "Precision", round(rec, 6) AS "Recall",
        round(f2, 6) AS "F2-Score" FROM scores ORDER BY f2 DESC, model""",
        SCORES_SQL,
    ),
)
def ranked_scores(spark, sf):
    return rounded(scoring.ranked_scores(formula_scores(spark, sf), "test"))


@register(
    "J5_attach_scalars",
    query("""SELECT id, int_rate, m AS mean_rate, lo AS low, hi AS high FROM loans,
             (SELECT round(avg(int_rate), 6) AS m, min(int_rate) AS lo, max(int_rate) AS hi FROM loans)"""),
)
def attach(spark, sf):
    rows = V.loans(spark, sf, "id", "int_rate")
    stats = rows.agg(
        F.round(F.avg("int_rate"), 6).alias("mean_rate"), F.min("int_rate").alias("low"),
        F.max("int_rate").alias("high"),
    )
    return attach_scalars(rows, stats).select("id", "int_rate", "_stats.*")


@register(
    "A35_date_extent",
    query("SELECT min(issue_d) AS first_date, max(issue_d) AS last_date FROM loans"),
)
def date_extent(spark, sf):
    return readers.date_extent(V.loans(spark, sf, "issue_d"))


@register(
    "A33_feature_extent",
    query("SELECT " + columns("min({c}) AS \"min_{n}\", max({c}) AS \"max_{n}\"",
                              ["loan_amnt", "int_rate", "dti", "annual_inc"]) + " FROM loans"),
)
def feature_extent(spark, sf):
    names = ["loan_amnt", "int_rate", "dti", "annual_inc"]
    return encoding.feature_extent(V.loans(spark, sf, *names), names)


@register(
    "W1_fill_forward_back",
    query(
        f"""SELECT id, issue_d, {columns('coalesce(m.{c}, f.{c}) AS {c}', S.INDICATOR_COLUMNS)}
        FROM merged m LEFT JOIN filled f ON date_trunc('month', m.issue_d) = f.p""",
        MERGED_SQL,
        "known AS (SELECT date_trunc('month', issue_d) AS p, "
        + columns("max({c}) AS {c}", S.INDICATOR_COLUMNS)
        + " FROM merged WHERE issue_d IS NOT NULL GROUP BY 1)",
        "filled AS (SELECT p, "
        + columns(
            "coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING "
            "AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (ORDER BY p ROWS BETWEEN CURRENT ROW "
            "AND UNBOUNDED FOLLOWING)) AS {c}",
            S.INDICATOR_COLUMNS,
        )
        + " FROM known)",
    ),
)
def fill_forward_back(spark, sf):
    return cleaning.fill_forward_back(merged_loans(spark, sf), S.INDICATOR_COLUMNS, "issue_d")
