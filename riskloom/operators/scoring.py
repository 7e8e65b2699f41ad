"""Classification scores: confusion matrix, metrics, ROC, model ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import col, ratio, ratio_or_zero
from riskloom.functions.ordering import running_sums
from riskloom.schemas import BASELINE_MODEL
from riskloom.session import materialize


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    actual, said = col(label) == 1, col(prediction) == 1
    return df.agg(
        F.count_if(~actual & ~said).alias("tn"),
        F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"),
        F.count_if(actual & said).alias("tp"),
    )


def classification_metrics(cm: DataFrame, beta: float = 2.0) -> DataFrame:
    """Accuracy, precision, recall and F-beta; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    b2 = beta * beta
    return cm.select(
        ratio_or_zero(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp).alias("f2"),
    )


def classification_report(cm: DataFrame) -> DataFrame:
    """Per class precision, recall, f1 and support, then accuracy, macro and weighted rows."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def scores(name, hit, false_alarm, missed):
        return F.struct(
            F.lit(name).alias("class"),
            ratio_or_zero(hit, hit + false_alarm).alias("precision"),
            ratio_or_zero(hit, hit + missed).alias("recall"),
            ratio_or_zero(2 * hit, 2 * hit + false_alarm + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    both = cm.select(scores("0", tn, fn, fp).alias("a"), scores("1", tp, fp, fn).alias("b"),
                     ratio_or_zero(tp + tn, tp + tn + fp + fn).alias("acc"))
    total = F.col("a.support") + F.col("b.support")
    measures = ("precision", "recall", "f1")

    def blended(name, weight_a, weight_b):
        return F.struct(
            F.lit(name).alias("class"),
            *[(F.col(f"a.{m}") * weight_a + F.col(f"b.{m}") * weight_b).alias(m) for m in measures],
            total.alias("support"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("class"), *[F.col("acc").alias(m) for m in measures],
        total.alias("support"),
    )
    share_a = ratio_or_zero(F.col("a.support"), total)
    share_b = ratio_or_zero(F.col("b.support"), total)
    return both.select(
        F.inline(
            F.array(
                F.col("a"), F.col("b"), accuracy,
                blended("macro avg", F.lit(0.5), F.lit(0.5)),
                blended("weighted avg", share_a, share_b),
            )
        )
    )


def business_metrics(cm: DataFrame, stats: DataFrame) -> DataFrame:
    """Error rates and the money they stand for; `stats` is the one-row statistics table."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    profit = stats.select("avg_loan_profit").scalar()
    amount = stats.select("avg_loan_amount").scalar()
    return cm.select(
        ratio_or_zero(fp, fp + tn).alias("false_positive_rate"),
        ratio_or_zero(tp, tp + fn).alias("true_positive_rate"),
        (fp * profit).alias("avg_missed_profit"),
        (tn * profit).alias("avg_gained_profit"),
        (fn * amount).alias("avg_lost_loans_amount"),
        (tp * amount).alias("avg_saved_loans_amnts"),
    )


def score_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "probability",
) -> DataFrame:
    """Good and bad loans per (score, prediction), staged: one pass over the predictions.

    The confusion matrix, the ROC curve and the AUC all follow from these counts, and
    tied scores are one row however many loans share them.
    """
    counts = df.groupBy(
        col(score).cast("double").alias("threshold"), (col(prediction) == 1).alias("said")
    ).agg(F.count_if(col(label) == 1).alias("pos"), F.count_if(col(label) == 0).alias("neg"))
    return materialize(counts, "score-counts")


def confusion_of_counts(counts: DataFrame) -> DataFrame:
    def total(c: str, said: bool, name: str):
        picked = F.when(F.col("said") == said, F.col(c)).otherwise(0)
        return F.coalesce(F.sum(picked), F.lit(0)).alias(name)

    return counts.agg(
        total("neg", False, "tn"), total("neg", True, "fp"), total("pos", False, "fn"),
        total("pos", True, "tp"),
    )


def _per_score(counts: DataFrame) -> DataFrame:
    known = counts.where(F.col("threshold").isNotNull())
    return known.groupBy("threshold").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _scores_only(df: DataFrame, label: str, score: str) -> DataFrame:
    return score_counts(df.withColumn("_said", F.lit(1)), label, "_said", score)


def roc_points(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """(`threshold`, `fpr`, `tpr`) for every distinct score, highest first, from (inf, 0, 0) on."""
    counts = _per_score(_scores_only(df, label, score))
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    upto = running_sums(counts, "threshold", ["pos", "neg"], descending=True, staged=True)
    placed = upto.withColumn("t", totals)
    points = placed.select(
        "threshold",
        ratio(F.col("cum_neg"), F.col("t.n")).alias("fpr"),
        ratio(F.col("cum_pos"), F.col("t.p")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.union(points)


def auc_of_counts(counts: DataFrame) -> DataFrame:
    """Area under the ROC curve: the chance that a bad loan scores above a good one."""
    upto = running_sums(_per_score(counts), "threshold", ["neg"], staged=True)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    beaten = F.sum(pos * (F.col("cum_neg") - neg + neg / 2))
    return upto.agg(ratio(beaten, F.sum(pos) * F.sum(neg)).alias("roc_auc"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    return auc_of_counts(_scores_only(df, label, score))


def best_model(scores: DataFrame, stage: str = "test", with_baseline: bool = False) -> DataFrame:
    """The stage's model with the highest F2, the first name on ties."""
    rows = scores.where(F.col("Stage") == stage)
    if not with_baseline:
        rows = rows.where(F.col("Model") != BASELINE_MODEL)
    return rows.orderBy(F.desc("F2-Score"), "Model").limit(1)


def ranked_scores(scores: DataFrame, stage: str = "test", by: str = "F2-Score") -> DataFrame:
    rows = scores.where(F.col("Stage") == stage) if "Stage" in scores.columns else scores
    return rows.orderBy(F.desc(by), "Model")


def score_row(counts: DataFrame, model: str, stage: str) -> DataFrame:
    """One row of the score table from the `score_counts` of one model's predictions."""
    metrics = classification_metrics(confusion_of_counts(counts))
    return metrics.select(
        F.lit(model).alias("Model"),
        F.lit(stage).alias("Stage"),
        F.col("accuracy").alias("Accuracy"),
        auc_of_counts(counts).scalar().alias("ROC-AUC"),
        F.col("precision").alias("Precision"),
        F.col("recall").alias("Recall"),
        F.col("f2").alias("F2-Score"),
    )


def score_table(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)
