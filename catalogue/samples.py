"""Split, scaling, balancing, fixed-size samples and scores of predictions."""

from __future__ import annotations

from catalogue import views as V
from catalogue.registry import register
from catalogue.sql import query
from catalogue.tables import AUC_SQL, rounded
from riskloom.operators import encoding, grouping, sampling, scoring
from riskloom.operators.labels import filter_loan_status

SIZES_SQL = """class_sizes AS (SELECT loan_status AS c, count(*) AS n FROM modelled GROUP BY 1),
quotas AS (
  SELECT c, n - (f + CASE WHEN row_number() OVER (ORDER BY e - f DESC, c) <= spare THEN 1 ELSE 0 END) AS q
  FROM (SELECT *, (tr - sum(f) OVER ())::BIGINT AS spare FROM (
    SELECT *, floor(e)::BIGINT AS f FROM (
      SELECT c, n, tr, (tr * n)::DOUBLE / total AS e FROM (
        SELECT c, n, sum(n) OVER () AS total, (sum(n) OVER () - ceil(0.1::DOUBLE * sum(n) OVER ()))::BIGINT AS tr
        FROM class_sizes))))),
split AS (
  SELECT m.*, row_number() OVER (PARTITION BY loan_status ORDER BY md5('42-' || id::VARCHAR)) <= q AS in_test
  FROM modelled m JOIN quotas ON c = loan_status)"""


def _modelled(spark, sf, *names):
    return filter_loan_status(V.loans(spark, sf, "id", "loan_status", *names))


@register("W5_stratified_split", query("SELECT id, loan_status, in_test FROM split", SIZES_SQL))
def stratified_split(spark, sf):
    from pyspark.sql import functions as F

    train, test = sampling.stratified_split(_modelled(spark, sf))
    return train.withColumn("in_test", F.lit(False)).unionByName(
        test.withColumn("in_test", F.lit(True))
    )


@register(
    "W6_random_undersample",
    query("""SELECT id, loan_status FROM (SELECT id, loan_status,
             row_number() OVER (PARTITION BY loan_status ORDER BY md5('42-' || id::VARCHAR)) AS r FROM modelled)
             WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM modelled GROUP BY loan_status))"""),
)
def random_undersample(spark, sf):
    return sampling.random_undersample(_modelled(spark, sf))


@register(
    "W6_class_counts_after",
    query("""SELECT loan_status::VARCHAR AS "value", min(n) OVER () AS n FROM (
             SELECT loan_status, count(*) AS n FROM modelled GROUP BY 1)"""),
)
def class_counts_after(spark, sf):
    counts = grouping.value_counts(random_undersample(spark, sf), "loan_status")
    return counts.withColumn("value", counts["value"].cast("string"))


@register(
    "L5_exact_sample",
    query("SELECT id, term FROM (SELECT id, term, row_number() OVER (ORDER BY md5('42-' || id::VARCHAR)) AS r "
          "FROM loans) WHERE r <= 5000"),
)
def exact_sample(spark, sf):
    return sampling.exact_sample(V.loans(spark, sf, "id", "term"), 5000)


@register(
    "M11_stratified_folds",
    query("""SELECT id, loan_status, ((r > n * 1 // 5)::INTEGER + (r > n * 2 // 5)::INTEGER
             + (r > n * 3 // 5)::INTEGER + (r > n * 4 // 5)::INTEGER) AS fold FROM (
             SELECT id, loan_status, count(*) OVER (PARTITION BY loan_status) AS n,
             row_number() OVER (PARTITION BY loan_status ORDER BY md5('39-' || id::VARCHAR)) AS r FROM modelled)"""),
)
def stratified_folds(spark, sf):
    return sampling.with_folds(_modelled(spark, sf), "loan_status")


SCALED = ["loan_amnt", "int_rate", "annual_inc"]


@register(
    "M2_normalize_train_test",
    query("SELECT s.id, s.loan_status, " + ", ".join(
        f"round((s.{c} - e.lo_{c}) / CASE WHEN e.hi_{c} = e.lo_{c} THEN 1 ELSE e.hi_{c} - e.lo_{c} END, 9) AS {c}"
        for c in SCALED) + " FROM split s, (SELECT " + ", ".join(
        f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in SCALED)
        + " FROM split WHERE NOT in_test) e WHERE s.in_test", SIZES_SQL),
)
def normalize_train_test(spark, sf):
    train, test = sampling.stratified_split(_modelled(spark, sf, *SCALED))
    return rounded(encoding.normalize_train_test(train, test)[1], 9)


CM_SQL = """cm AS (SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM scored)"""


@register("A27_confusion_matrix", query("SELECT * FROM cm", CM_SQL))
def confusion_matrix(spark, sf):
    return scoring.confusion_matrix(V.scored(spark, sf))


@register(
    "A28_classification_metrics",
    query("""SELECT round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(tp / (tp + fp), 9) AS precision,
             round(tp / (tp + fn), 9) AS recall, round(5 * tp / (5 * tp + 4 * fn + fp), 9) AS f2 FROM (
             SELECT tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tp::DOUBLE AS tp FROM cm)""", CM_SQL),
)
def classification_metrics(spark, sf):
    return rounded(scoring.classification_metrics(confusion_matrix(spark, sf)), 9)


@register(
    "A29_classification_report",
    query("""SELECT "class", round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM (
             SELECT '0' AS "class", p0 AS p, r0 AS r, f0 AS f, tn + fp AS s FROM parts
             UNION ALL SELECT '1', p1, r1, f1, tp + fn FROM parts
             UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM parts
             UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM parts
             UNION ALL SELECT 'weighted avg', (p0 * (tn + fp) + p1 * (tp + fn)) / n,
               (r0 * (tn + fp) + r1 * (tp + fn)) / n, (f0 * (tn + fp) + f1 * (tp + fn)) / n, n FROM parts)""",
          CM_SQL,
          """parts AS (SELECT *, tn + fp + fn + tp AS n, (tp + tn)::DOUBLE / (tn + fp + fn + tp) AS acc,
             tn::DOUBLE / (tn + fn) AS p0, tn::DOUBLE / (tn + fp) AS r0, (2 * tn)::DOUBLE / (2 * tn + fn + fp) AS f0,
             tp::DOUBLE / (tp + fp) AS p1, tp::DOUBLE / (tp + fn) AS r1, (2 * tp)::DOUBLE / (2 * tp + fp + fn) AS f1
             FROM cm)"""),
)
def classification_report(spark, sf):
    return rounded(scoring.classification_report(confusion_matrix(spark, sf)), 6)


@register(
    "A30_business_metrics",
    query("""SELECT round(fp::DOUBLE / (fp + tn), 9) AS false_positive_rate,
             round(tp::DOUBLE / (tp + fn), 9) AS true_positive_rate, round(fp * profit, 4) AS avg_missed_profit,
             round(tn * profit, 4) AS avg_gained_profit, round(fn * amount, 4) AS avg_lost_loans_amount,
             round(tp * amount, 4) AS avg_saved_loans_amnts FROM cm, (
             SELECT avg(total_pymnt) FILTER (loan_status = 0) - avg(loan_amnt) FILTER (loan_status = 0) AS profit,
             avg(loan_amnt) AS amount FROM modelled)""", CM_SQL),
)
def business_metrics(spark, sf):
    stats = grouping.business_statistics(_modelled(spark, sf, "total_pymnt", "loan_amnt"))
    found = scoring.business_metrics(confusion_matrix(spark, sf), stats)
    rates = ("false_positive_rate", "true_positive_rate")
    money = [c for c in found.columns if c not in rates]
    return rounded(rounded(found, 9, *rates), 4, *money)


@register(
    "W7_roc_points",
    query("""SELECT 'inf'::DOUBLE AS threshold, 0::DOUBLE AS fpr, 0::DOUBLE AS tpr UNION ALL
             SELECT threshold, round(cn / sum(neg) OVER (), 9) AS fpr, round(cp / sum(pos) OVER (), 9) AS tpr FROM (
             SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS cp,
             sum(neg) OVER (ORDER BY threshold DESC) AS cn FROM (
               SELECT probability AS threshold, (count(*) FILTER (label = 1))::DOUBLE AS pos,
               (count(*) FILTER (label = 0))::DOUBLE AS neg FROM scored GROUP BY 1))"""),
)
def roc_points(spark, sf):
    return rounded(scoring.roc_points(V.scored(spark, sf)), 9, "fpr", "tpr")


@register(
    "W8_roc_auc",
    query("SELECT round(" + AUC_SQL.format(rows="(SELECT label, probability AS s FROM scored)")
          + ", 9) AS roc_auc"),
)
def roc_auc(spark, sf):
    return rounded(scoring.roc_auc(V.scored(spark, sf)), 9)
