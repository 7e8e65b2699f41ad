from __future__ import annotations

import pytest
from helpers import values
from pyspark.sql import functions as F

from riskloom.operators import encoding as E
from riskloom.operators import labels as L
from riskloom.operators import sampling as Sm
from riskloom.operators.grouping import business_statistics
from riskloom.plans import loans as P
from riskloom.plans import modelling as M


def test_status_filter(make):
    df = make("loan_status string", "Fully Paid", "Current", "Default", "In Grace Period", "Charged Off", None)
    assert values(L.filter_loan_status(df)) == [0, 0, 1, 1]


def test_analysis_label(make):
    df = make("loan_status string", "Current", " current ", "Fully Paid", "LATE (16-30 days)", "In Grace Period", None)
    assert values(L.build_target(df), "target_default") == [0, 1, None, None]
    assert L.known_target(L.build_target(df)).count() == 2
    assert L.build_target(make("loan_status string", "Current")).count() == 0
    plain = make("a int", 1)
    assert L.build_target(plain) is plain


def test_fico(make):
    df = make("id int, fico_range_low double, fico_range_high double, last_pymnt_d string", (1, 680.0, 700.0, "x"))
    out = E.create_fico_feature(df)
    assert out.columns == ["fico"] and values(out) == [690.0]


def test_flags(make):
    df = make("term string, pymnt_plan string", ("36 months", "y"), ("60 months", "n"), (None, None))
    assert values(E.encode_pymnt_plan(E.encode_term(df))) == [(1, 1), (0, 0), (0, 0)]


def test_employment_length(make):
    df = make("emp_length string", "5 years", "3 years", "10+ years", "< 1 year", "Unknown")
    assert values(E.encode_emp_length(df)) == [5, 3, 10, 0, -1]
    assert values(E.emp_years_digits(df), "emp_yrs") == [5.0, 3.0, 10.0, 1.0, None]
    assert values(E.emp_years_dashboard(df), "emp_yrs", "label") == [
        (5, "5 yrs"), (3, "3 yrs"), (10, "10+ yrs"), (0, "< 1 yr")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        E.encode_emp_length(make("emp_length string", "long")).collect()


def test_home_ownership_and_one_hot(make):
    df = E.collapse_rare(make("home_ownership string", "RENT", "MORTGAGE", "OWN", "NONE", "ANY", None))
    assert values(df) == ["RENT", "MORTGAGE", "OWN", "OTHER", "OTHER", "OTHER"]
    out = E.one_hot_encode_columns(df, ["home_ownership", "absent"])
    assert out.columns == [f"home_ownership_{v}" for v in ("MORTGAGE", "OTHER", "OWN", "RENT")]
    again = E.one_hot_encode_columns(make("home_ownership string", "RENT"), ["home_ownership"],
                                     {"home_ownership": ["OWN", "RENT"]})
    assert values(again) == [(0, 1)]


def test_one_hot_null_is_all_zero(make):
    assert values(E.one_hot_encode_columns(make("c string", "a b", None), ["c"]), "c_a b") == [1, 0]


def test_sub_grades_descending(make):
    df = make("sub_grade string", "A1", "C2", "B1", "A1", None)
    assert values(E.ordinal_encode_desc(df)) == [2, 0, 1, 2, None]


def test_many_ordinals_are_numbered_range_by_range(spark):
    df = spark.range(12_000).select(F.format_string("v%05d", "id").alias("sub_grade"))
    out = E.ordinal_encode_desc(df, out="n").where("n <> 11999 - cast(substring(sub_grade, 2) AS int)")
    assert out.count() == 0


def test_bands_are_right_closed(make):
    df = make("v double", 580.0, 580.5, 620.0, 620.5, 850.0, 851.0, None)
    assert values(E.band(df, "v"), "band") == [None, "580-620", "580-620", "620-660", "780-850", None, None]


def test_scaling(make):
    schema = "loan_amnt double, fico double, loan_status int"
    train, test = E.normalize_train_test(make(schema, (10.0, 50.0, 0), (30.0, 150.0, 1)), make(schema, (20.0, 100.0, 1)))
    assert values(train, order=["loan_amnt"]) == [(0.0, 0.0, 0), (1.0, 1.0, 1)]
    assert values(test) == [(0.5, 0.5, 1)]
    flat, _ = E.normalize_train_test(make(schema, (7.0, 1.0, 0), (7.0, 2.0, 1)), make(schema, (9.0, 1.0, 1)))
    assert values(flat, "loan_amnt") == [0.0, 0.0]
    assert "Join" not in train._jdf.queryExecution().executedPlan().toString()


def test_business_statistics(make):
    df = make("loan_status int, total_pymnt double, loan_amnt double", (0, 1200.0, 1000.0), (0, 1400.0, 1000.0),
              (1, 100.0, 1000.0), (1, 200.0, 1000.0))
    assert values(business_statistics(df)) == [(300.0, 850.0, 1000.0)]


def _classes(spark, n, good):
    return spark.range(n).withColumn("loan_status", (F.col("id") >= good).cast("int"))


def test_split_sizes_and_shares(spark):
    train, test = Sm.stratified_split(_classes(spark, 10, 3), test_size=0.2)
    assert (train.count(), test.count()) == (8, 2)
    train, test = Sm.stratified_split(_classes(spark, 100, 80), test_size=0.2)
    assert test.count() == 20 and test.where("loan_status = 0").count() == 16
    assert train.join(test, "id").count() == 0 and train.count() == 80
    again = Sm.stratified_split(_classes(spark, 100, 80), test_size=0.2)[1]
    assert sorted(values(again, "id")) == sorted(values(test, "id"))
    other = Sm.stratified_split(_classes(spark, 100, 80), test_size=0.2, seed=7)[1]
    assert sorted(values(other, "id")) != sorted(values(test, "id"))


def test_sampling_does_not_shuffle_the_table(spark):
    train, _ = Sm.stratified_split(_classes(spark, 100, 80))
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ratio,kept", [(1.0, 20), (0.5, 40), (0.3, 66)])
def test_undersampling(spark, ratio, kept):
    out = Sm.random_undersample(_classes(spark, 100, 80), ratio=ratio)
    assert out.where("loan_status = 1").count() == 20
    assert out.where("loan_status = 0").count() == kept
    again = Sm.random_undersample(_classes(spark, 100, 80), ratio=ratio)
    assert sorted(values(again, "id")) == sorted(values(out, "id"))


def test_undersampling_edges(spark):
    balanced = _classes(spark, 40, 20)
    assert Sm.random_undersample(balanced).count() == 40
    for bad in (0, -1, 1.5):
        with pytest.raises(ValueError, match="ratio"):
            Sm.random_undersample(balanced, ratio=bad)
    with pytest.raises(ValueError, match="not found"):
        Sm.random_undersample(balanced, target="nope")
    with pytest.raises(ValueError, match="more than"):
        Sm.random_undersample(_classes(spark, 100, 60), ratio=0.5)


def test_folds_cover_every_class_evenly(spark):
    counts = Sm.with_folds(_classes(spark, 103, 80), "loan_status").groupBy("loan_status", "fold").count()
    per = {(r[0], r[1]): r[2] for r in counts.collect()}
    assert len(per) == 10
    for label in (0, 1):
        sizes = [per[label, f] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_exact_sample(spark):
    rows = spark.range(10_000)
    assert Sm.exact_sample(rows, 1234).count() == 1234
    assert Sm.exact_sample(rows, 20_000) is rows


def test_transform_end_to_end(make):
    schema = ("loan_status string, fico_range_low double, fico_range_high double, term string, sub_grade string, "
              "emp_length string, pymnt_plan string, home_ownership string, verification_status string, "
              "purpose string, total_pymnt double, loan_amnt double")
    df = make(schema,
              ("Fully Paid", 680.0, 700.0, "36 months", "A1", "10+ years", "n", "RENT", "Verified", "car", 12.0, 10.0),
              ("Charged Off", 600.0, 610.0, "60 months", "B2", "< 1 year", "y", "NONE", "Source Verified", "house", 3.0, 10.0),
              ("Current", 600.0, 610.0, "60 months", "B2", "1 year", "n", "OWN", "Not Verified", "car", 3.0, 10.0))
    out, stats = P.transform_loans(df)
    row = {r["loan_status"]: r.asDict() for r in out.collect()}
    assert set(row) == {0, 1}
    assert row[0]["fico"] == 690.0 and row[0]["term"] == 1 and row[0]["sub_grade"] == 1
    assert row[1]["emp_length"] == 0 and row[1]["pymnt_plan"] == 1 and row[1]["sub_grade"] == 0
    assert row[1]["home_ownership_OTHER"] == 1 and row[0]["home_ownership_RENT"] == 1
    assert row[1]["verification_status_Source Verified"] == 1 and row[0]["purpose_car"] == 1
    assert "total_pymnt" not in out.columns and P.remaining_text(out) == []
    assert values(stats) == [(2.0, 7.0, 10.0)]


def test_text_features_are_named_early(make):
    with pytest.raises(ValueError, match="initial_list_status"):
        M.feature_names(make("id int, loan_status int, initial_list_status string", (1, 0, "w")), "loan_status")
