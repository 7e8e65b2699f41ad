"""Mutual information from nearest neighbours against a plain loop over all rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.exprs import digamma
from riskloom.operators.information import nearest_mutual_information
from riskloom.session import materialize


def _psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))


def _brute(v, y, k=3):
    known = ~np.isnan(v) & np.array([label is not None for label in y])
    v, y = v[known], np.array(y)[known]
    kept = np.array([np.sum(y == label) > 1 for label in y], bool)
    v, y = v[kept], y[kept]
    total = 0.0
    for i in range(len(v)):
        mine = y == y[i]
        size = int(mine.sum())
        gaps = np.sort(np.abs(v[mine] - v[i]))
        at = min(k, size - 1)
        r = gaps[at]
        if r == 0:
            at, m = int((gaps == 0).sum()) - 1, int((v == v[i]).sum())
        else:
            m = int((np.abs(v - v[i]) < r).sum())
        total += _psi(at) - _psi(size) - _psi(m)
    return max(_psi(len(v)) + total / len(v), 0.0) if len(v) else 0.0


def test_digamma(spark):
    rows = spark.range(1, 400).select("id", digamma(F.col("id")).alias("p")).collect()
    assert all(r.p == pytest.approx(_psi(r.id), abs=1e-12) for r in rows)


@pytest.mark.parametrize("range_rows", [15, 100_000])
def test_nearest_information_equals_brute_force(spark, range_rows):
    """Hot values, gaps, an outlier, a class of one row, one of two, a class rare in most ranges, no label."""
    y = (F.when(F.col("id") == 7, "one").when(F.col("id").isin(8, 600), "two").when(F.col("id") % 97 == 0, "rare")
         .when(F.col("id") % 50 == 3, None).when(F.col("id") % 3 == 0, "a").otherwise("b"))
    whole = F.floor(F.rand(5) * 4096)
    df = materialize(spark.range(700).select(
        y.alias("y"), whole.cast("double").alias("even"),
        (whole + F.when(F.col("id") % 3 == 0, 2500).otherwise(0)).alias("shifted"),
        F.when(F.col("id") % 3 == 1, 42.0).when(F.col("id") % 9 == 0, None).when(F.col("id") == 5, 1e9)
        .when(F.col("id") == 11, float("nan")).otherwise(whole).alias("hot"),
        (F.col("id") % 4).cast("int").alias("few"), F.lit(None).cast("double").alias("none"), F.lit(2.0).alias("flat")))
    pdf = df.toPandas()
    names = ["even", "shifted", "hot", "few", "none", "flat"]
    got = {r.feature: r.mutual_info for r in nearest_mutual_information(df, "y", names, range_rows=range_rows).collect()}
    labels = [label if isinstance(label, str) else None for label in pdf.y]
    for c in names:
        assert got[c] == pytest.approx(_brute(pdf[c].to_numpy(float), labels), abs=1e-9), c
    assert got["shifted"] > 0.2 > got["even"]


def test_information_of_nothing(spark):
    df = spark.createDataFrame([], "y int, v double")
    assert [tuple(r) for r in nearest_mutual_information(df, "y", ["v"]).collect()] == [("v", 0.0)]


def test_no_window_over_a_whole_column(spark):
    df = materialize(spark.range(200).select((F.col("id") % 2).alias("y"), F.sqrt("id").alias("v")))
    plan = nearest_mutual_information(df, "y", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert all("range" in line or "_start" in line for line in plan.splitlines() if "Window [" in line)
    assert math.isfinite(nearest_mutual_information(df, "y", ["v"]).first().mutual_info)
