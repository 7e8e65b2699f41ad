from __future__ import annotations

from datetime import datetime

import pytest
from helpers import values

from riskloom.operators import cleaning as C
from riskloom.plans import loans as P
from riskloom.plans.steps import StepPlan
from riskloom.sources.readers import read_table
from riskloom.sources.writers import write_table


def test_column_names(make):
    assert C.normalize_columns(make("`  id  ` int, ` term ` string", (1, "a"))).columns == ["id", "term"]


def test_strings(make):
    df = make("term string, sub_grade string", (" 36   months ", " A1 "), ("", "B2"), ("nan", "  C3  "),
              ("None", "null"), ("ok", "D4"), (" a\t \nb ", "NULL"))
    assert values(C.strip_and_standardize_strings(df)) == [
        ("36 months", "A1"), (None, "B2"), (None, "C3"), (None, None), ("ok", "D4"), ("a b", "NULL")]


def test_dates(make):
    out = C.parse_dates(make("issue_d string", "2020-01-01", "not-a-date", "Dec-2015", "2020-13-45"))
    assert values(out) == [datetime(2020, 1, 1), None, datetime(2015, 12, 1), None]


def test_strict_month(make):
    out = C.parse_issue_month(make("issue_d string", "Dec-2015", "2015-12-01", None))
    assert values(out) == [datetime(2015, 12, 1), None, None]


def test_numbers(make):
    df = make("loan_amnt string, int_rate string, dti string, annual_inc double", ("$1,200", "12.5%", "10.2", 5.0),
              ("300", "7%", "bad", -1.0), ("--5", "1e2", "", None))
    assert values(C.coerce_numeric_columns(df)) == [
        (1200.0, 12.5, 10.2, 5.0), (300.0, 7.0, None, -1.0), (None, 100.0, None, None)]


def test_repairs(make):
    df = make("fico_range_low double, fico_range_high double, loan_amnt double, pymnt_plan string",
              (750.0, 700.0, -10.0, " Y "), (650.0, 680.0, 100.0, "n"), (None, 680.0, 0.0, None))
    assert values(C.repair_logical_relationships(df)) == [
        (700.0, 750.0, None, "y"), (650.0, 680.0, 100.0, "n"), (None, 680.0, 0.0, None)]


def test_missing_values(make):
    df = make("id int, issue_d timestamp, CPI double, delinq_2yrs double, loan_amnt double, term string",
              (1, datetime(2020, 1, 1), None, None, None, None),
              (2, datetime(2020, 2, 1), 250.0, 1.0, 200.0, "36 months"),
              (None, datetime(2020, 3, 1), None, None, None, None))
    out = C.handle_missing_values(df)
    assert values(out, "CPI", "delinq_2yrs", "loan_amnt", "term", order=["id"]) == [
        (250.0, 0.0, 200.0, "Unknown"), (250.0, 1.0, 200.0, "36 months")]


def test_indicators_fill_forward_then_back(make):
    rows = [(i, datetime(2020, m, d), v) for i, (m, d, v) in enumerate(
        [(1, 5, None), (2, 1, 1.0), (2, 9, None), (3, 1, None), (4, 1, 4.0), (5, 2, None)])]
    out = C.fill_forward_back(make("id int, issue_d timestamp, CPI double", *rows), ["CPI"], "issue_d")
    assert values(out, "CPI", order=["id"]) == [1.0, 1.0, 1.0, 1.0, 4.0, 4.0]


def test_all_null_column_has_no_median(make):
    df = make("loan_amnt double, dti double", (None, 1.0), (None, None), (None, 4.0))
    assert values(C.median_fill(df)) == [(None, 1.0), (None, 2.5), (None, 4.0)]


def test_duplicates(make):
    df = make("id int, loan_amnt int", (1, 100), (1, 200), (2, 300), (2, 300))
    assert values(C.remove_duplicates(df), order=["id"]) == [(1, 100), (2, 300)]
    assert C.remove_duplicates(df.drop("id")).count() == 3


@pytest.mark.parametrize("max_repeated", [0, 100])
def test_duplicates_of_a_hot_key(spark, max_repeated):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, -1, if(id = 4, NULL, if(id = 5, NULL, id))) AS id", "id AS v",
                                      "cast(NULL AS string) AS gap")
    out = C.drop_duplicates_keep_first(df, ["id"], ["v"], max_repeated)
    assert out.count() == 2000
    assert values(out.where("id = -1"), "v") == [0] and values(out.where("id IS NULL"), "v") == [4]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert ("BroadcastHashJoin" in plan) == (max_repeated > 0)


def test_unique_rows_are_not_shuffled(spark):
    df = spark.range(100)
    assert C.drop_duplicates_keep_first(df, ["id"]) is df


def test_outliers(make):
    df = make("loan_amnt double, dti double", (10.0, None), (11.0, None), (12.0, None), (1000.0, None))
    out = values(C.clip_outliers(df))
    amounts = sorted(a for a, _ in out)
    assert amounts[0] == 10.0 and amounts[-1] == pytest.approx(259.0 + 1.5 * (259.0 - 10.75))
    assert all(d is None for _, d in out)


def test_no_spread_is_not_clipped(make):
    df = make("loan_amnt double", 5.0, 5.0, 5.0, 5.0, 9.0)
    assert sorted(values(C.clip_outliers(df))) == [5.0, 5.0, 5.0, 5.0, 9.0]


def test_final_types_round_half_to_even(make):
    df = make("id double, delinq_2yrs double, fico_range_low string", (1.0, 0.5, "700"), (2.0, 1.5, None), (3.0, 2.5, "9"))
    out = C.finalize_types(df)
    assert [t for _, t in out.dtypes] == ["bigint"] * 3
    assert values(out) == [(1, 0, 700), (2, 2, None), (3, 2, 9)]


def test_step_audit(make, spark):
    plan = StepPlan().add_step("add", lambda d, by: d.withColumn("b", d.a + by), by=1)
    plan.add_step("keep", lambda d: d.where("a > 1"))
    assert values(plan.execute(make("a long", 1, 2, 3)), order=["a"]) == [(2, 3), (3, 4)]
    rows = plan.report(spark).collect()
    assert [(r.step, r.rows_before, r.rows_after, r.rows_changed, r.status) for r in rows] == [
        ("add", 3, 3, 0, "success"), ("keep", 3, 2, -1, "success")]


def test_failing_step_is_audited_and_raised(make, spark):
    def broken(df):
        raise ValueError("boom")

    plan = StepPlan().add_step("ok", lambda d: d).add_step("broken", broken)
    with pytest.raises(ValueError, match="boom"):
        plan.execute(make("a long", 1))
    last = plan.report(spark).collect()[-1]
    assert (last.step, last.status, last.error) == ("broken", "failed", "boom")


def test_error_in_the_data_is_audited_and_raised(make, spark):
    plan = StepPlan().add_step("cast", lambda d: d.selectExpr("cast(a AS int) AS a"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        plan.execute(make("a string", "x"))
    assert plan.report(spark).first().status == "failed"


def test_audit_adds_no_pass_and_models_still_fit_in_the_session(make, spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    StepPlan().add_step("same", lambda d: d).execute(make("a long", 1))
    rows = make("x double, label double", (0.0, 0.0), (1.0, 1.0), (2.0, 1.0), (3.0, 0.0))
    matrix = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    assert LogisticRegression(maxIter=2).fit(matrix).transform(matrix).count() == 4


def test_clean_file_end_to_end(make, spark, tmp_path):
    source, target = str(tmp_path / "raw.csv"), str(tmp_path / "clean")
    write_table(make("id string, issue_d string, loan_amnt string, int_rate string, term string",
                     ("1", "Jan-2020", "1000", "5%", " 36 months"), ("2", "Feb-2020", "2000", "7.5%", None)), source)
    audit = P.clean_merged_dataset(spark, source, target)
    assert audit.count() == 9 and audit.where("status <> 'success'").count() == 0
    out = read_table(spark, target)
    assert values(out, "id", "loan_amnt", "int_rate", "term", order=["id"]) == [
        (1, 1000.0, 5.0, "36 months"), (2, 2000.0, 7.5, "Unknown")]
