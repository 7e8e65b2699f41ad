"""Cases that an earlier version got wrong or could not do."""

from __future__ import annotations

import time
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import distribution, encoding, profiling, sampling, scoring
from riskloom.plans import bundle as B
from riskloom.plans import loans as P
from riskloom.plans import modelling as M
from riskloom.session import discard, materialize
from riskloom.sources.readers import project_available, read_loans
from riskloom.sources.writers import write_table

SMALL = "/root/testdata/sf0.001"


def test_duplicates_see_microseconds_and_fold_signed_zero(make):
    stamp = datetime(2020, 1, 1)
    near = make("id int, t timestamp", (1, stamp), (1, stamp.replace(microsecond=1)))
    zeros = make("id int, x double", (1, 0.0), (1, -0.0), (2, None), (2, None), (None, 2.0))
    gaps = make("a int, b int", (None, 1), (1, None))
    for df, surplus, members in ((near, 0, 0), (zeros, 2, 4), (gaps, 0, 0)):
        row = profiling.duplicate_rows(df).first()
        assert (row.surplus_rows, row.duplicate_rows) == (surplus, members)
        assert profiling.duplicate_groups(df).agg(F.sum("n")).first()[0] in (members, None)


def test_read_loans_takes_parquet_as_it_is(spark, make, tmp_path):
    path = str(tmp_path / "loans")
    make("loan_amnt double, term string", (1.5, "36 months")).write.parquet(path)
    loans = project_available(read_loans(spark, path), S.LOAN_COLUMNS)
    assert loans.dtypes == [("loan_amnt", "double"), ("term", "string")]


def test_long_ordinal_lists_are_joined(spark):
    rows = spark.range(200_000).select((F.col("id") % 9000).cast("string").alias("v"))
    start = time.perf_counter()
    found = encoding.ordinal_encode_desc(rows, "v", "code").groupBy("v").agg(F.min("code").alias("code"), F.max("code"))
    got = {r.v: r.code for r in found.collect()}
    assert time.perf_counter() - start < 20
    assert got == {v: i for i, v in enumerate(sorted(got, reverse=True))}
    many = spark.range(20_000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("v"))
    assert encoding.ordinal_encode_desc(many, "v", "code").agg(F.countDistinct("code"), F.max("code")).first()[:] == (20_000, 19_999)


def test_one_hot_has_no_limit_unless_asked(spark):
    wide = spark.range(1500).select(F.col("id").cast("string").alias("v"))
    assert len(encoding.one_hot_values(wide, ["v"])["v"]) == 1500
    with pytest.raises(ValueError, match="more than 1000"):
        encoding.one_hot_values(wide, ["v"], limit=1000)


def test_samples_of_many_classes(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 5000).alias("c"), F.lit("x").alias("_number_kept"))
    rows = materialize(rows)
    train, test = sampling.stratified_split(rows, "c", test_size=0.25)
    assert train.columns == rows.columns and (train.count(), test.count()) == (15_000, 5000)
    assert test.groupBy("c").count().select("count").distinct().collect()[0][0] == 1
    assert train.join(test, "id", "left_semi").count() == 0
    folds = sampling.with_folds(rows, "c", folds=4).groupBy("c", "fold").count()
    assert folds.count() == 20_000 and folds.agg(F.max("count")).first()[0] == 1
    uneven = rows.where("c > 0 OR id = 0")
    assert sampling.random_undersample(uneven, "c").groupBy("c").count().agg(F.max("count"), F.count("*")).first()[:] == (1, 5000)


def test_box_plots_of_many_classes_match_those_of_few(spark):
    rows = materialize(spark.range(3000).select((F.col("id") % 300).alias("c"), F.pmod(F.hash("id"), F.lit(50)).cast("double").alias("v")))
    many = {r["group"]: r for r in distribution.boxplot_stats(rows, "v", "c").collect()}
    assert len(many) == 300
    few = distribution.boxplot_stats(rows.where("c < 20"), "v", "c").collect()
    assert len(few) == 20 and all(many[r["group"]] == r for r in few)


def test_kde_plan_spreads_no_rows(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("c"), (F.col("id") * 1.7).alias("v"))
    found = distribution.kde(rows, "v", "c", points=50)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    areas = found.groupBy("group").agg((F.sum("density") * (F.max("x") - F.min("x")) / 49).alias("a")).collect()
    assert len(areas) == 3 and all(abs(r.a - 1) < 0.05 for r in areas)


def test_roc_curve_starts_at_zero(make):
    rows = make("label int, probability double", (1, 0.9), (0, 0.4), (1, 0.4), (0, 0.1))
    points = scoring.roc_points(rows).orderBy(F.desc("threshold")).collect()
    assert [tuple(p)[1:] for p in points] == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]
    assert points[0].threshold == float("inf")


def test_discard_removes_a_staged_table(spark):
    staged = materialize(spark.range(10))
    folder = staged.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    import os

    assert os.path.isdir(folder)
    discard(staged)
    assert not os.path.isdir(folder)


def test_from_landed_files_to_scores(spark, tmp_path):
    """The block of the README, on loans without a key."""
    from catalogue import views as V
    from catalogue.tables import land_indicators

    path = str(tmp_path / "loans.csv")
    write_table(V.raw_loans(spark, SMALL, parallel=True).drop("id"), path)
    raw = P.collect_loans(spark, path, land_indicators(spark, SMALL))
    assert "id" not in raw.columns and set(S.INDICATOR_COLUMNS) <= set(raw.columns)
    cleaned, audit = P.clean_loans(raw)
    assert audit.where("status = 'success'").count() == 9
    tables = P.prepare_training(cleaned.drop("initial_list_status"))
    assert tables["train"].count() + tables["test"].count() == tables["transformed"].count()
    specs = [M.spec(S.BASELINE_MODEL), M.spec("Logistic Regression", maxIter=20)]
    result = M.train_and_compare(tables["train_undersampled"], tables["test"], specs)
    assert result["scores"].count() == 4 and "id" not in result["features"]
    best = B.make_bundle(result["best"], tables["train"])
    B.save_bundle(spark, best, str(tmp_path / "bundle"))
    scored = B.score_batch(tables["transformed"], B.load_bundle(spark, str(tmp_path / "bundle")))
    assert scored.count() == tables["transformed"].count()
    assert scored.where("prediction_label IS NULL OR probability < 0.5").count() == 0
