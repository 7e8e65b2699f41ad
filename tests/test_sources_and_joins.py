from __future__ import annotations

import json
from datetime import datetime

import pytest
from helpers import values
from pyspark.sql import types as T

from riskloom.operators import cleaning as C
from riskloom.operators import joins as J
from riskloom.plans import loans as P
from riskloom.sources import readers as R
from riskloom.sources.writers import write_table


def test_dataset_csv_keeps_requested_columns_and_parses_months(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text("id,issue_d,loan_amnt,extra\n1,Jan-2020,1000,a\n2,invalid-date,2000,b\n3,2020-01-01,5,c\n")
    loans = C.parse_issue_month(
        R.project_available(R.read_loans(spark, str(path)), ["id", "issue_d", "loan_amnt"])
    )
    assert loans.columns == ["id", "issue_d", "loan_amnt"]
    assert values(loans, "issue_d", order=["id"]) == [datetime(2020, 1, 1), None, None]


def test_missing_file_is_empty_for_collection_and_raises_elsewhere(spark, tmp_path):
    assert R.read_loans(spark, str(tmp_path / "none.csv")).isEmpty()
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, str(tmp_path / "none"))


def test_no_requested_column_gives_an_empty_table(make):
    out = R.project_available(make("other long", 1, 2), ["id", "loan_amnt"])
    assert out.columns == [] and out.count() == 0


def test_part_of_the_columns_missing(make):
    out = R.project_available(make("id long, loan_amnt long", (1, 2), (3, 4)), ["id", "loan_amnt", "zip"])
    assert out.columns == ["id", "loan_amnt"] and out.count() == 2


def _series(tmp_path, document):
    path = tmp_path / "series.json"
    path.write_text(json.dumps(document, indent=1))
    return str(path)


def test_observations(spark, tmp_path):
    path = _series(tmp_path, {"observations": [
        {"date": "2020-01-01", "value": "1.5"}, {"date": None, "value": "2.0"},
        {"date": "2020-02-01", "value": "1.7"}]})
    out = R.read_observations(spark, path, "CPI", "CPIAUCSL")
    assert out.columns == ["Year", "Month", "CPI"]
    assert values(out, order=["Month"]) == [(2020, 1, "1.5"), (2020, 2, "1.7")]
    assert R.read_observations(spark, path, series_id="CPIAUCSL").columns[-1] == "CPIAUCSL"


def test_observations_without_the_key(spark, tmp_path):
    assert R.read_observations(spark, _series(tmp_path, {"data": []}), "CPI").count() == 0


def test_merge_indicators_skips_empty(make, spark):
    cpi = make("Year int, Month int, CPI double", (2020, 1, 1.5))
    rate = make("Year int, Month int, `Unemployment Rate` double", (2020, 1, 3.5))
    empty = spark.createDataFrame([], T.StructType([]))
    merged = J.merge_indicators([cpi, rate, empty])
    assert merged.columns == ["Year", "Month", "CPI", "Unemployment Rate"]
    assert values(merged) == [(2020, 1, 1.5, 3.5)]
    assert J.merge_indicators([empty, empty]) is None
    assert values(J.merge_indicators([cpi])) == [(2020, 1, 1.5)]


def test_merge_indicators_is_a_full_outer_join(make):
    a = make("Year int, Month int, A double", (2020, 1, 1.0))
    b = make("Year int, Month int, B double", (2020, 2, 2.0))
    assert values(J.merge_indicators([a, b]), order=["Month"]) == [(2020, 1, 1.0, None), (2020, 2, None, 2.0)]


def test_loans_with_indicators(make):
    loans = make("id int, issue_d timestamp, loan_amnt int", (1, datetime(2020, 1, 15), 10),
                 (2, datetime(2020, 2, 20), 20), (3, datetime(2023, 6, 15), 30))
    monthly = make("Year int, Month int, CPI double", (2020, 1, 1.5), (2020, 2, 1.7))
    out = J.merge_indicators_with_loans(loans, monthly)
    assert out.columns == ["id", "issue_d", "loan_amnt", "CPI"]
    assert values(out, "CPI", order=["id"]) == [1.5, 1.7, None]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_empty_sides_return_the_other_table(make, spark):
    loans = make("id int, issue_d timestamp", (1, datetime(2020, 1, 15)))
    monthly = make("Year int, Month int, CPI double", (2020, 1, 1.5))
    assert J.merge_indicators_with_loans(loans.limit(0), monthly) is monthly
    assert J.merge_indicators_with_loans(loans, None) is loans
    assert J.merge_indicators_with_loans(loans, monthly.limit(0)) is loans


def test_csv_and_parquet_round_trip(make, spark, tmp_path):
    df = make("a string, `b c` int", (" x ", 1), (None, 2))
    for name in ("t.csv", "t"):
        path = str(tmp_path / "deep" / name)
        write_table(df, path)
        assert sorted(values(R.read_table(spark, path, df.schema)), key=str) == sorted(values(df), key=str)


def test_collect_loans_end_to_end(spark, tmp_path):
    (tmp_path / "l.csv").write_text("issue_d,loan_amnt,note\nJan-2020,100,x\nMar-2020,200,y\n")
    months = [{"date": f"2020-{m:02d}-01", "value": v} for m, v in [(1, "1.5"), (2, "1.6"), (3, "."), (4, "9")]]
    path = _series(tmp_path, {"observations": months})
    out = P.collect_loans(spark, str(tmp_path / "l.csv"), {"CPI": path})
    assert out.columns == ["loan_amnt", "issue_d", "CPI"] or set(out.columns) == {"loan_amnt", "issue_d", "CPI"}
    assert values(out, "loan_amnt", "CPI", order=["loan_amnt"]) == [("100", 1.5), ("200", None)]


def test_indicator_months_outside_the_loans_are_dropped(make):
    loans = make("issue_d timestamp", datetime(2020, 2, 1), datetime(2020, 3, 1))
    series = make("Year int, Month int, CPI double", (2020, 1, 1.0), (2020, 2, 2.0), (2020, 3, 3.0), (2020, 4, 4.0))
    assert values(R.limit_to_extent(series, R.date_extent(loans)), "Month", order=["Month"]) == [2, 3]


def test_baseline_deltas(make):
    schema = "Model string, Stage string, Accuracy double, `ROC-AUC` double, Precision double, Recall double, `F2-Score` double"
    scores = make(schema, ("ZeroR Baseline", "test", 0.60, 0.50, 0.0, 0.0, 0.0),
                  ("LR", "test", 0.82, 0.87, 0.7, 0.8, 0.75), ("No AUC", "test", 0.7, None, 0.1, 0.1, 0.2),
                  ("LR", "train", 0.9, 0.9, 0.9, 0.9, 0.9))
    rows = {r["Model"]: r for r in J.models_vs_baseline(scores, "test").collect()}
    assert set(rows) == {"LR", "No AUC"}
    assert rows["LR"]["Delta Accuracy"] == pytest.approx(0.22)
    assert rows["No AUC"]["Delta ROC-AUC"] is None
    assert J.models_vs_baseline(scores, "train").count() == 0
