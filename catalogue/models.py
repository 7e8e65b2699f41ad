"""Selection, the six classifiers, tuning, comparison, importance, scoring.

All fits use the library's own settings and read every resolved loan of the given tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogue import views as V
from catalogue.registry import register
from catalogue.reports import ANOVA, ANOVA_SQL
from catalogue.sql import query
from catalogue.tables import rounded
from riskloom import schemas as S
from riskloom.operators import cleaning as C
from riskloom.operators import scoring
from riskloom.operators.labels import filter_loan_status
from riskloom.plans import bundle as B
from riskloom.plans import linear as L
from riskloom.plans import loans as P
from riskloom.plans import modelling as M
from riskloom.plans.baseline import scored_by
from riskloom.session import materialize, staging_dir
from riskloom.streaming import scoring as T

_PREPARED: dict = {}
_FITTED: dict = {}

def prepared(spark, sf):
    """Training tables and the matrix, staged once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PREPARED:
        # The medians read the loans several times, the later steps again: the joins behind them run once.
        rows = C.unknown_fill(C.null_if_negative(materialize(V.loans(spark, sf), "loans")))
        rows = C.median_fill(C.zero_fill(rows)).drop("initial_list_status")
        tables = P.prepare_training(rows)
        tables["train_undersampled"] = materialize(tables["train_undersampled"], "train")
        tables["test"] = materialize(tables["test"], "test")
        features = M.select_features(tables["train_undersampled"])
        matrix = M.training_matrix(tables["train_undersampled"], features)
        _PREPARED[key] = (tables, features, matrix, matrix.count())
    return _PREPARED[key]


def _fitted(spark, sf, name):
    """The named model at its default settings, fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        _, features, matrix, n = prepared(spark, sf)
        _FITTED[key] = M.fit(M.spec(name), matrix, features, n)
    return _FITTED[key]


def _score(spark, sf, name):
    tables, features, _, _ = prepared(spark, sf)
    test = M.assembled(tables["test"], features)
    return M.evaluate(_fitted(spark, sf, name), test, "test")[0]


@register(
    "M4_select_features",
    query(f"SELECT feature FROM ({ANOVA_SQL}) ORDER BY f DESC, feature LIMIT 3"),
)
def select_features(spark, sf):
    rows = filter_loan_status(V.loans(spark, sf, "id", "loan_status", *ANOVA))
    chosen = M.select_features(rows, k=3)
    return spark.createDataFrame([(c,) for c in chosen], "feature string")


@register(
    "M5_zero_r_baseline",
    query("""SELECT m::DOUBLE AS prediction, m::DOUBLE AS probability, count(*) AS n,
             round(avg((loan_status = m)::INTEGER), 9) AS accuracy FROM modelled,
             (SELECT CASE WHEN count(*) FILTER (loan_status = 1) > count(*) / 2 THEN 1 ELSE 0 END AS m FROM modelled)
             GROUP BY 1, 2"""),
)
def zero_r_baseline(spark, sf):
    rows = filter_loan_status(V.loans(spark, sf, "loan_status")).select(
        F.col("loan_status").cast("double").alias("label")
    )
    told = M.fit(M.spec(S.BASELINE_MODEL), rows, [], 0).predict(rows)
    hit = (F.col("label") == F.col("prediction")).cast("int")
    return rounded(
        told.groupBy("prediction", "probability").agg(
            F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy")), 9, "accuracy")


@register("M6_logistic_regression")
def logistic_regression(spark, sf):
    return _score(spark, sf, "Logistic Regression")


@register("M7_linear_svm")
def linear_svm(spark, sf):
    return _score(spark, sf, "LinearSVC")


@register("M8_boosted_stumps")
def boosted_stumps(spark, sf):
    return _score(spark, sf, "AdaBoost")


@register("M9_gradient_boosting")
def gradient_boosting(spark, sf):
    return _score(spark, sf, "Gradient Boosting")


@register("M10_bagged_trees")
def bagged_trees(spark, sf):
    return _score(spark, sf, "Bagging")


@register("M11_random_search_tune")
def random_search_tune(spark, sf):
    _, features, matrix, n = prepared(spark, sf)
    model = M.spec("Logistic Regression")
    _, settings, f2 = M.random_search_tune(model, matrix, features, n, 2)
    return spark.createDataFrame(
        [(model.name, settings["C"], settings["maxIter"], float(f2))],
        "model string, c double, max_iter int, cv_f2 double",
    )


# Two features of every resolved loan, with balanced class weights and the fold of each loan.
PLANE = ["x1", "x2"]
PLANE_SQL = """plane AS (
  SELECT (int_rate - 15) / 10 AS x1, coalesce(dti, 0) / 60 AS x2, loan_status AS y,
    count(*) OVER () / (2 * count(*) OVER (PARTITION BY loan_status))::DOUBLE AS w,
    ((r > n * 1 // 5)::INTEGER + (r > n * 2 // 5)::INTEGER + (r > n * 3 // 5)::INTEGER + (r > n * 4 // 5)::INTEGER) AS fold
  FROM (SELECT *, count(*) OVER (PARTITION BY loan_status) AS n,
          row_number() OVER (PARTITION BY loan_status ORDER BY md5('39-' || id::VARCHAR)) AS r FROM modelled))"""
# Loss derivatives by the margin m, times the weight; the ridge of the intercept.
LOGISTIC_SQL = ("w * (1 / (1 + exp(-m)) - y)", "w * exp(-abs(m)) / (1 + exp(-abs(m))) ** 2", 0)
HINGE_SQL = ("w * -2 * (2 * y - 1) * greatest(0, 1 - (2 * y - 1) * m)", "w * 2 * ((2 * y - 1) * m < 1)::INTEGER", 1)


def _newton_sql(loss: tuple[str, str, int], starts: str, steps: int) -> str:
    """Recursive table `newton` of coefficients for each (c, fold left out), by plain Newton steps."""
    slope, curve, ridge = loss
    sums = ", ".join(f"c * sum({curve} * {x}) + {r} AS {n}" for n, x, r in (
        ("a", "1", ridge), ("b", "x1", 0), ("d", "x2", 0), ("e", "x1 * x1", 1), ("f", "x1 * x2", 0), ("g", "x2 * x2", 1)))
    return f"""newton AS (
  {starts}
  UNION ALL SELECT k + 1, c, left_out,
    b0 - ((e * g - f * f) * g0 + (d * f - b * g) * g1 + (b * f - d * e) * g2) / det,
    b1 - ((d * f - b * g) * g0 + (a * g - d * d) * g1 + (b * d - a * f) * g2) / det,
    b2 - ((b * f - d * e) * g0 + (b * d - a * f) * g1 + (a * e - b * b) * g2) / det
  FROM (SELECT *, a * (e * g - f * f) - b * (b * g - d * f) + d * (b * f - d * e) AS det FROM (
    SELECT k, c, left_out, b0, b1, b2, c * sum({slope}) + {ridge} * b0 AS g0, c * sum({slope} * x1) + b1 AS g1,
      c * sum({slope} * x2) + b2 AS g2, {sums}
    FROM (SELECT *, b0 + b1 * x1 + b2 * x2 AS m FROM newton, plane WHERE k < {steps} AND fold <> left_out)
    GROUP BY k, c, left_out, b0, b1, b2)))"""


def _coefficients_sql(loss, c):
    start = f"SELECT 0 AS k, {c}::DOUBLE AS c, -1 AS left_out, 0::DOUBLE AS b0, 0::DOUBLE AS b1, 0::DOUBLE AS b2"
    return query(
        """SELECT unnest(['x1', 'x2', 'intercept']) AS feature, round(unnest([b1, b2, b0]), 6) AS coefficient
           FROM newton WHERE k = 25""",
        PLANE_SQL + ", " + _newton_sql(loss, start, 25),
    ).replace("WITH", "WITH RECURSIVE", 1)


def _plane(spark, sf):
    rows = filter_loan_status(V.loans(spark, sf, "id", "loan_status", "int_rate", "dti")).select(
        "id", "loan_status", ((F.col("int_rate") - 15) / 10).alias("x1"), (F.coalesce("dti", F.lit(0)) / 60).alias("x2")
    )
    return M.training_matrix(rows, PLANE)


def _coefficients(spark, sf, loss, c):
    matrix = _plane(spark, sf)
    blocks = L.row_blocks(matrix, PLANE, M.LABEL, M.WEIGHT, None)
    found = L.fit_candidates(blocks, len(PLANE), loss, [L.Candidate(c)], loss != "logistic")[:, 0]
    rows = [(f, float(b)) for f, b in zip([*PLANE, "intercept"], found)]
    return rounded(spark.createDataFrame(rows, "feature string, coefficient double"), 6)


@register("M6_logistic_coefficients", _coefficients_sql(LOGISTIC_SQL, 0.01))
def logistic_coefficients(spark, sf):
    return _coefficients(spark, sf, "logistic", 0.01)


@register("M7_svm_coefficients", _coefficients_sql(HINGE_SQL, 0.01))
def svm_coefficients(spark, sf):
    return _coefficients(spark, sf, "squared hinge", 0.01)


SEARCHED = [0.0001, 0.01, 1.0]


@register(
    "M11_search_scores",
    query(
        """SELECT c, round(avg(5 * tp / greatest(5 * tp + 4 * fn + fp, 1)), 9) AS f2 FROM (
             SELECT c, left_out, count(*) FILTER (said AND y = 0) AS fp, count(*) FILTER (NOT said AND y = 1) AS fn,
               (count(*) FILTER (said AND y = 1))::DOUBLE AS tp
             FROM (SELECT c, left_out, y, b0 + b1 * x1 + b2 * x2 > 0 AS said FROM newton, plane WHERE k = 25 AND fold = left_out)
             GROUP BY c, left_out) GROUP BY c""",
        PLANE_SQL + ", " + _newton_sql(LOGISTIC_SQL, "SELECT 0 AS k, c, left_out, 0::DOUBLE AS b0, 0::DOUBLE AS b1, 0::DOUBLE AS b2 "
        f"FROM (SELECT unnest({SEARCHED}::DOUBLE[]) AS c), (SELECT unnest(range(5)) AS left_out)", 25),
    ).replace("WITH", "WITH RECURSIVE", 1),
)
def search_scores(spark, sf):
    settings = [{"C": c} for c in SEARCHED]
    found = L.search(_plane(spark, sf), PLANE, "logistic", settings, M.FOLDS, M.FOLD, M.LABEL, M.WEIGHT)
    return rounded(spark.createDataFrame(list(zip(SEARCHED, found.scores)), "c double, f2 double"), 9)


# A fixed scoring formula in place of a fitted model, so that scoring can be held against SQL.
FIXED_FEATURES = ["int_rate", "total_pymnt"]
FIXED_MARGIN = "(3D * int_rate - 0.00002D * total_pymnt - 0.6D)"
# int_rate is scaled by its extent; total_pymnt enters as it comes; gaps are 0 after scaling.
FIXED_SQL = """fixed AS (
  SELECT id, loan_status AS label, (m > 0)::INTEGER AS prediction, round(1 / (1 + exp(-m)), 6) AS probability FROM (
    SELECT id, loan_status, 3 * coalesce((int_rate - lo) / (hi - lo), 0) - 0.00002 * coalesce(total_pymnt, 0) - 0.6 AS m
    FROM modelled, (SELECT min(int_rate) AS lo, max(int_rate) AS hi FROM modelled)))"""
SCORED_SQL = query(
    """SELECT id, prediction, CASE prediction WHEN 1 THEN 'Charge Off' ELSE 'Fully Paid' END AS prediction_label,
       round(CASE prediction WHEN 1 THEN probability ELSE 1 - probability END, 6) AS probability FROM fixed""",
    FIXED_SQL,
)


def _fixed_model():
    prediction = f"CASE WHEN {FIXED_MARGIN} > 0 THEN 1 ELSE 0 END"
    chance = f"round(1 / (1 + exp(-{FIXED_MARGIN})), 6)"
    return M.Fitted("Fixed", scored_by(prediction, chance), "column", FIXED_FEATURES)


def _fixed_rows(spark, sf):
    return filter_loan_status(V.loans(spark, sf, "id", "loan_status", *FIXED_FEATURES))


def _fixed_bundle(rows):
    return B.make_bundle(_fixed_model(), rows)


@register(
    "M12_evaluate",
    query("""SELECT 'Fixed' AS "Model", 'test' AS "Stage", round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 9) AS "Accuracy",
             (SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) FROM (
               SELECT pos, neg, sum(neg) OVER (ORDER BY probability) - neg AS below FROM (
                 SELECT probability, (count(*) FILTER (label = 1))::DOUBLE AS pos,
                 (count(*) FILTER (label = 0))::DOUBLE AS neg FROM fixed GROUP BY 1))) AS "ROC-AUC",
             round(tp::DOUBLE / (tp + fp), 9) AS "Precision", round(tp::DOUBLE / (tp + fn), 9) AS "Recall",
             round(5 * tp::DOUBLE / (5 * tp + 4 * fn + fp), 9) AS "F2-Score", tn, fp, fn, tp FROM (
             SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp
             FROM fixed)""", FIXED_SQL),
)
def evaluate(spark, sf):
    rows = _fixed_rows(spark, sf)
    bundle = _fixed_bundle(rows)
    inputs = B.model_inputs(rows, bundle, ["loan_status"]).withColumnRenamed("loan_status", "label")
    row, found = M.evaluate(bundle.fitted, inputs, "test")
    matrix = scoring.confusion_of_counts(found).select(F.struct("*"))
    return rounded(row.withColumn("counts", matrix.scalar()).select(*row.columns, "counts.*"), 9)


@register("M13_train_and_compare")
def train_and_compare(spark, sf):
    tables, _, _, _ = prepared(spark, sf)
    return M.train_and_compare(tables["train_undersampled"], tables["test"])["scores"]


IMPORTANCE = ["int_rate", "revol_util", "annual_inc", "total_pymnt", "fico_range_low", "open_acc"]


@register("M15_forest_importance")
def forest_importance(spark, sf):
    rows = V.labelled(spark, sf, *IMPORTANCE)
    return M.forest_importance(rows, "target_default", IMPORTANCE)


@register("M16_feature_importance")
def feature_importance(spark, sf):
    rows = V.labelled(spark, sf, *IMPORTANCE)
    return M.feature_importance(rows, "target_default", IMPORTANCE)


@register("M17_score_batch", SCORED_SQL)
def score_batch(spark, sf):
    rows = _fixed_rows(spark, sf)
    return rounded(B.score_batch(rows, _fixed_bundle(rows)), 6)


def _scratch(spark, name):
    return f"{staging_dir(spark).rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


@register("S7_save_and_load_bundle", SCORED_SQL)
def save_and_load_bundle(spark, sf):
    rows = _fixed_rows(spark, sf)
    path = _scratch(spark, "bundle")
    B.save_bundle(spark, _fixed_bundle(rows), path)
    return rounded(B.score_batch(rows, B.load_bundle(spark, path)), 6)


@register("T1_score_stream", SCORED_SQL)
def score_stream(spark, sf):
    rows = _fixed_rows(spark, sf)
    arriving, out = _scratch(spark, "arriving"), _scratch(spark, "scored-stream")
    rows.write.parquet(arriving)
    stream = T.loan_stream(spark, arriving, rows.schema)
    T.score_stream(stream, _fixed_bundle(rows), out, _scratch(spark, "stream-log")).awaitTermination()
    return rounded(spark.read.parquet(out), 6)
