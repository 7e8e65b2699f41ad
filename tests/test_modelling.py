from __future__ import annotations

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import scoring as Sc
from riskloom.plans import bundle as B
from riskloom.plans import loans as P
from riskloom.plans import modelling as M
from riskloom.streaming import scoring as T

QUICK = {
    S.BASELINE_MODEL: {}, "Logistic Regression": {"maxIter": 10}, "LinearSVC": {"maxIter": 10},
    "AdaBoost": {"numRounds": 4, "minInstancesPerNode": 1}, "Gradient Boosting": {"numTrees": 4, "maxDepth": 3},
    "Bagging": {"numTrees": 5, "maxDepth": 4},
}


def _matrix(make, tn, fp, fn, tp):
    return make("tn long, fp long, fn long, tp long", (tn, fp, fn, tp))


def test_business_metrics(make):
    stats = make("avg_loan_profit double, avg_loan_loss double, avg_loan_amount double", (300.0, 850.0, 1000.0))
    row = Sc.business_metrics(_matrix(make, 100, 20, 10, 30), stats).first()
    assert row.false_positive_rate == 20 / 120 and row.true_positive_rate == 30 / 40
    row = Sc.business_metrics(_matrix(make, 80, 20, 7, 9), stats).first()
    assert tuple(row)[2:] == (20 * 300.0, 80 * 300.0, 7 * 1000.0, 9 * 1000.0)
    row = Sc.business_metrics(_matrix(make, 0, 0, 0, 0), stats).first()
    assert row.false_positive_rate == 0 and row.true_positive_rate == 0


def test_metrics_with_zero_denominators(make):
    assert values(Sc.classification_metrics(_matrix(make, 5, 0, 5, 0))) == [(0.5, 0.0, 0.0, 0.0)]
    row = Sc.classification_metrics(_matrix(make, 50, 10, 5, 35)).first()
    p, r = 35 / 45, 35 / 40
    assert row.f2 == pytest.approx(5 * p * r / (4 * p + r))


def test_report(make):
    rows = {r["class"]: r for r in Sc.classification_report(_matrix(make, 50, 10, 5, 35)).collect()}
    assert rows["1"].precision == 35 / 45 and rows["0"].recall == 50 / 60 and rows["accuracy"].f1 == 0.85
    assert rows["weighted avg"].support == 100
    assert rows["macro avg"].recall == pytest.approx((50 / 60 + 35 / 40) / 2)


def _scores(spark, n=400):
    return spark.range(n).selectExpr(
        "cast(id * 7919 % 101 > 60 AS int) AS label", "round(id * 31 % 97 / 97 + (id * 7919 % 101) / 300, 2) AS probability")


def test_auc_and_roc_equal_brute_force(spark):
    df = _scores(spark)
    pdf = df.toPandas()
    pos, neg = pdf[pdf.label == 1].probability.to_numpy(), pdf[pdf.label == 0].probability.to_numpy()
    wins = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
    assert Sc.roc_auc(df).first().roc_auc == pytest.approx(wins / (len(pos) * len(neg)))
    points = Sc.roc_points(df).toPandas().sort_values("threshold", ascending=False)
    assert points.fpr.iloc[-1] == points.tpr.iloc[-1] == 1.0
    for r in points.itertuples():
        assert r.tpr == pytest.approx((pos >= r.threshold).mean()) and r.fpr == pytest.approx((neg >= r.threshold).mean())
    curve = np.trapezoid(np.r_[0, points.tpr], np.r_[0, points.fpr])
    assert curve == pytest.approx(wins / (len(pos) * len(neg)))


def test_auc_of_one_class_is_null(spark):
    assert Sc.roc_auc(_scores(spark).where("label = 1")).first().roc_auc is None


def test_counts_give_the_same_confusion_matrix(spark):
    df = _scores(spark).withColumn("prediction", (F.col("probability") > 0.6).cast("int"))
    assert values(Sc.confusion_of_counts(Sc.score_counts(df))) == values(Sc.confusion_matrix(df))


def test_best_model_leaves_the_baseline_out(make):
    scores = make("Model string, Stage string, `F2-Score` double", (S.BASELINE_MODEL, "test", 0.99),
                  ("B", "test", 0.5), ("A", "test", 0.5), ("C", "train", 0.9))
    assert values(Sc.best_model(scores), "Model") == ["A"]
    assert values(Sc.best_model(scores, with_baseline=True), "Model") == [S.BASELINE_MODEL]
    assert values(Sc.ranked_scores(scores), "Model") == [S.BASELINE_MODEL, "A", "B"]


@pytest.fixture(scope="module")
def raw(spark):
    """Labelled loans whose outcome follows two of the features."""
    return spark.range(600).selectExpr(
        "id", "cast(id * 13 % 40 AS double) AS int_rate", "cast(id * 29 % 60 AS double) AS dti",
        "cast(id * 17 % 23 AS double) AS open_acc", "id % 2 AS flag",
        "cast((id * 13 % 40) * 2 + id * 29 % 60 + id % 11 > 75 AS int) AS loan_status")


@pytest.fixture(scope="module")
def tables(raw):
    from riskloom.operators.encoding import normalize_train_test
    from riskloom.operators.sampling import random_undersample, stratified_split

    train, test = stratified_split(raw)
    train_norm, test_norm = normalize_train_test(train, test)
    return {"raw_train": train, "train": random_undersample(train_norm), "test": test_norm}


@pytest.fixture(scope="module")
def compared(tables):
    specs = [M.spec(name, **settings) for name, settings in QUICK.items()]
    return M.train_and_compare(tables["train"], tables["test"], specs, k=3)


def test_feature_selection_prefers_what_matters(tables):
    chosen = M.select_features(tables["train"], k=2)
    assert chosen == ["int_rate", "dti"]
    assert M.select_features(tables["train"], k=30) == ["int_rate", "dti", "open_acc", "flag"]


def test_comparison_has_every_model_and_stage(compared):
    rows = compared["scores"].collect()
    assert len(rows) == 12
    assert {(r["Model"], r["Stage"]) for r in rows} == {(m, s) for m in QUICK for s in ("train", "test")}
    for r in rows:
        for c in ("Accuracy", "ROC-AUC", "Precision", "Recall", "F2-Score"):
            assert 0 <= r[c] <= 1
    assert compared["deltas"]["test"].count() == 5
    assert compared["best"].name != S.BASELINE_MODEL
    good = {r["Model"]: r["ROC-AUC"] for r in rows if r["Stage"] == "test"}
    assert good[S.BASELINE_MODEL] == 0.5
    assert all(auc > 0.75 for name, auc in good.items() if name != S.BASELINE_MODEL), good


def test_tuning_tries_points_and_refits(tables):
    features = M.select_features(tables["train"], k=3)
    matrix = M.training_matrix(tables["train"], features, folds=3)
    model = M.spec("Logistic Regression", maxIter=5)
    grid = {"C": [0.1, 1.0], "maxIter": [5]}
    fitted, settings, f2 = M.random_search_tune(model, matrix, features, matrix.count(), 2, grid, folds=3)
    assert settings["C"] in (0.1, 1.0) and 0.5 < f2 <= 1
    assert fitted.predict(matrix).where("probability IS NULL").count() == 0
    plain, none, score = M.random_search_tune(model, matrix, features, matrix.count(), 1, grid={})
    assert none == {} and score is None and plain.name == model.name


def test_own_estimators_take_part_in_tuning(tables):
    features = M.select_features(tables["train"], k=2)
    matrix = M.training_matrix(tables["train"], features, folds=2)
    small = M.spec("AdaBoost", numRounds=2)
    _, settings, f2 = M.random_search_tune(small, matrix, features, matrix.count(), 2, {"maxDepth": [1, 2]}, folds=2)
    assert settings["maxDepth"] in (1, 2) and f2 > 0.5
    zero, settings, _ = M.random_search_tune(M.spec(S.BASELINE_MODEL), matrix, features, 1, 4, folds=2)
    assert settings["strategy"] in M.GRIDS[S.BASELINE_MODEL]["strategy"]
    assert zero.predict(matrix).count() == matrix.count()


def test_sampled_settings_are_distinct_and_reproducible():
    grid = M.GRIDS["AdaBoost"]
    points = M.sampled_settings(grid, 10)
    assert len({tuple(p.items()) for p in points}) == 10 and points == M.sampled_settings(grid, 10)
    assert len(M.sampled_settings({"a": [1, 2]}, 10)) == 2


def test_importance(raw):
    out = M.feature_importance(raw, "loan_status", ["int_rate", "dti", "open_acc"], trees=5, depth=3)
    assert values(out, "feature")[0] in ("int_rate", "dti") and out.count() == 3
    top = M.normalised_top(out, 3).toPandas()
    assert top.random_forest.max() == 1.0 and top.random_forest.min() == 0.0
    near = M.feature_importance(raw, "loan_status", ["int_rate", "dti"], trees=5, depth=3, nearest=True)
    assert near.count() == 2 and near.where("mutual_info >= 0").count() == 2


@pytest.mark.parametrize("name", ["Logistic Regression", "AdaBoost", "LinearSVC", "Gradient Boosting", "Bagging"])
def test_bundle_round_trip_scores_raw_rows(spark, raw, tables, compared, tmp_path, name):
    fitted = compared["models"][name]
    bundle = B.make_bundle(fitted, tables["raw_train"])
    B.save_bundle(spark, bundle, str(tmp_path / "bundle"))
    loaded = B.load_bundle(spark, str(tmp_path / "bundle"))
    assert loaded.feature_order == bundle.feature_order and loaded.feature_min == bundle.feature_min
    extra = raw.withColumn("note", F.lit("ignored"))
    got = B.score_batch(extra, loaded).orderBy("id").toPandas()
    want = B.score_batch(raw, bundle).orderBy("id").toPandas()
    assert got.equals(want) and len(got) == 600
    assert got.probability.between(0.0, 1.0).all()
    if name != "LinearSVC":
        assert (got.probability >= 0.5 - 1e-9).all()
    assert set(got.prediction_label) == {"Fully Paid", "Charge Off"}
    assert (got.prediction_label == got.prediction.map({0: "Fully Paid", 1: "Charge Off"})).all()


def test_missing_features_are_named(raw, tables, compared):
    bundle = B.make_bundle(compared["models"]["Logistic Regression"], tables["raw_train"])
    with pytest.raises(ValueError, match=r"\['dti'\]"):
        B.score_batch(raw.drop("dti"), bundle)
    nulls = raw.withColumn("dti", F.lit(None).cast("double"))
    assert B.score_batch(nulls, bundle).where("probability IS NULL").count() == 0


def test_stream_equals_batch(spark, raw, tables, compared, tmp_path):
    bundle = B.make_bundle(compared["models"]["Logistic Regression"], tables["raw_train"])
    arriving, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    raw.where("id < 300").write.parquet(arriving)

    def run():
        T.score_stream(T.loan_stream(spark, arriving, raw.schema), bundle, out, log).awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 300
    raw.where("id >= 300").write.mode("append").parquet(arriving)
    run()
    run()
    streamed = spark.read.parquet(out).orderBy("id").toPandas()
    assert streamed.equals(B.score_batch(raw, bundle).orderBy("id").toPandas())


def test_training_tables_end_to_end(spark, tmp_path):
    from catalogue import views as V
    from riskloom.operators import cleaning as C

    rows = C.median_fill(C.zero_fill(C.unknown_fill(V.loans(spark, "/root/testdata/sf0.001"))))
    tables = P.prepare_training(rows.drop("initial_list_status"))
    n = {k: t.count() for k, t in tables.items()}
    assert n["train"] + n["test"] == n["transformed"] and n["business_statistics"] == 1
    balance = tables["train_undersampled"].groupBy("loan_status").count().collect()
    assert len({r["count"] for r in balance}) == 1
    P.save_training(tables, str(tmp_path / "out"))
    saved = spark.read.parquet(str(tmp_path / "out" / "train_norm"))
    assert saved.count() == n["train"] and "id" not in saved.columns
    extent = saved.agg(F.min("int_rate"), F.max("int_rate")).first()
    assert tuple(extent) == (0.0, 1.0)


def test_every_report_of_the_exploration_runs(spark):
    from catalogue import views as V
    from riskloom.plans.reports import explore
    from riskloom.session import materialize

    names = ["id", "issue_d", "loan_amnt", "dti", "annual_inc", "fico_range_high", "sub_grade", "emp_length",
             "purpose", "term", "loan_status"]
    reports = explore(materialize(V.loans(spark, "/root/testdata/sf0.001", *names)))
    assert len(reports) > 40
    for name in ("profile", "target", "histogram dti", "boxplot by outcome dti", "rate by credit score band",
                 "rate by employment years", "class means log income", "monthly trend", "top values term",
                 "best and worst sub-grade", "class means dti, 99 %"):
        assert reports[name]().count() > 0, name
    assert explore(V.loans(spark, "/root/testdata/sf0.001", "dti")).keys().isdisjoint({"target", "categories"})
