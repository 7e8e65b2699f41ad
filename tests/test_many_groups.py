"""Samples, folds and box plots of many classes, one of them holding a third of the rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import ordering
from riskloom.functions.exprs import col
from riskloom.operators import distribution, sampling
from riskloom.session import materialize


def _classes(spark, n=30_000, classes=5000):
    """One class, the null one, holds a third of all rows."""
    kind = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("id") % classes))
    return materialize(spark.range(n).select("id", kind.alias("y")))


@pytest.mark.parametrize("group_rows", [10, 100_000])
def test_many_classes_are_cut_like_few(spark, monkeypatch, group_rows):
    df = _classes(spark, 6000, 40)
    few = sampling.stratified_split(df, "y")[1], sampling.random_undersample(df, "y"), sampling.with_folds(df, "y")
    monkeypatch.setattr(sampling, "LITERAL_CLASSES", 0)
    small = lambda *a: ordering.values_at_ranks(*a, group_rows=group_rows)
    monkeypatch.setattr(sampling, "values_at_ranks", small)
    many = sampling.stratified_split(df, "y")[1], sampling.random_undersample(df, "y"), sampling.with_folds(df, "y")
    for a, b in zip(few, many):
        assert a.columns == b.columns and a.schema.simpleString() == b.schema.simpleString()
        assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


@pytest.mark.parametrize("bound", [100_000, 10])
def test_five_thousand_classes_and_a_hot_one(spark, monkeypatch, bound):
    df = _classes(spark)
    small = ordering.broadcastable
    monkeypatch.setattr(ordering, "broadcastable", lambda t, n=bound: small(t, min(n, bound)))
    train, test = sampling.stratified_split(df, "y")
    assert (train.count(), test.count()) == (27_000, 3000)
    assert train.intersect(test).isEmpty()
    hot = test.where("y IS NULL").count()
    assert abs(hot - 1000) <= 1
    folds = sampling.with_folds(df, "y").groupBy("y", "fold").count().where("y IS NULL").collect()
    assert sorted(r["count"] for r in folds) == [2000] * 5
    for part in (train, sampling.with_folds(df, "y"), sampling.random_undersample(df, "y")):
        assert "Window" not in part._jdf.queryExecution().executedPlan().toString()
    assert sampling.random_undersample(df, "y").groupBy("y").count().select("count").distinct().count() == 1


@pytest.mark.parametrize("group_rows", [1, 50, 100_000])
def test_ranks_of_many_groups_equal_brute_force(spark, group_rows):
    value = F.when(F.col("id") % 3 == 0, 42.0).when(F.col("id") % 50 == 1, None).otherwise(
        F.pow(F.lit(10.0), (F.col("id") * 7919 % 9973) / 700.0) - 5e3)
    df = materialize(spark.range(9000).select((F.col("id") % 7).alias("g"), value.alias("v")))
    pdf = df.toPandas().dropna()
    ordered = {g: sorted(part.v) for g, part in pdf.groupby("g")}
    ranks = [(g, k, r) for g in ordered for k, r in enumerate([1, 2, 300, len(ordered[g]) // 2, len(ordered[g])])]
    wanted = spark.createDataFrame([*ranks, (0, 9, 10**9), (1, 9, 0), (99, 0, 1)], "_g long, _k int, _rank long")
    found = ordering.values_at_ranks(df, col("g"), col("v"), wanted, ordering.value_cell, group_rows)
    assert {(r["_g"], r["_k"]): r["_at"] for r in found.collect()} == {(g, k): ordered[g][r - 1] for g, k, r in ranks}


def test_ranks_without_rows(spark):
    df = spark.createDataFrame([], "g int, v double")
    wanted = spark.createDataFrame([(1, 0, 1)], "_g int, _k int, _rank long")
    assert ordering.values_at_ranks(df, col("g"), col("v"), wanted, ordering.value_cell).count() == 0


def test_box_plots_of_many_classes_equal_pandas(spark, monkeypatch):
    monkeypatch.setattr(distribution, "LITERAL_CLASSES", 3)
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 30).alias("c"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") * F.col("id") % 977 / 7).alias("v"))
    plots = {int(r["group"]): r for r in distribution.boxplot_stats(df, "v", "c").collect()}
    groups = {g: p.v.dropna() for g, p in df.toPandas().groupby("c")}
    assert set(plots) == set(groups)
    for g, v in groups.items():
        want = np.quantile(v, [0.25, 0.5, 0.75])
        assert [plots[g].q1, plots[g].median, plots[g].q3] == pytest.approx(list(want), rel=1e-12)
        reach = 1.5 * (want[2] - want[0])
        inside = v[(v >= want[0] - reach) & (v <= want[2] + reach)]
        assert (plots[g].whisker_low, plots[g].whisker_high) == (inside.min(), inside.max())
        assert plots[g].n_outliers == len(v) - len(inside)
