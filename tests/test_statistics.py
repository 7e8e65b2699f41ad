from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from riskloom.functions.exprs import col, kolmogorov_p, normal_cdf
from riskloom.functions.ordering import carry_values, hash_cuts, hash_key, running_sums
from riskloom.functions.quantiles import exact_quantiles
from riskloom.operators import correlation as K
from riskloom.operators import distribution as D
from riskloom.operators import grouping as G
from riskloom.operators import profiling as Pr
from riskloom.operators import quality as Q
from riskloom.session import broadcastable

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def _skewed(spark, n=40_000):
    """A third of the rows share one value; the rest is long-tailed, with gaps."""
    tail = F.pow(F.lit(10.0), (F.col("id") * 7919 % 9973) / 1500.0)
    value = F.when(F.col("id") % 3 == 0, 42.0).when(F.col("id") % 50 == 1, None).otherwise(tail)
    return spark.range(n).select(value.alias("v"), (F.col("id") % 5).cast("double").alias("few"),
                                 F.lit(None).cast("double").alias("none"))


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_quantiles_by_narrowing_equal_brute_force(spark, accuracy):
    df = _skewed(spark)
    got = exact_quantiles(df, {c: col(c) for c in df.columns}, PROBS, rank_limit=50, accuracy=accuracy)
    pdf = df.toPandas()
    for c in ("v", "few"):
        assert got[c] == pytest.approx([pdf[c].quantile(p) for p in PROBS], rel=1e-12)
    assert got["none"] == [None] * len(PROBS)


def test_quantiles_of_small_columns_equal_brute_force(spark):
    df = _skewed(spark, 999)
    pdf = df.toPandas()
    got = exact_quantiles(df, {"v": col("v")}, PROBS)["v"]
    assert got == pytest.approx([pdf.v.quantile(p) for p in PROBS], rel=1e-12)


@pytest.mark.parametrize("single_rows", [0, 10_000])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_equal_brute_force(spark, single_rows, descending):
    df = spark.range(3000).selectExpr("cast(id * 37 % 3001 AS double) AS k", "id AS a", "id % 7 AS b")
    got = running_sums(df, "k", ["a", "b"], descending, buckets=16, single_rows=single_rows).toPandas()
    got = got.sort_values("k", ascending=not descending)
    assert (got.cum_a == got.a.cumsum()).all() and (got.cum_b == got.b.cumsum()).all()
    assert len(got) == 3000


@pytest.mark.parametrize("single_rows", [0, 10_000])
def test_carried_values_equal_brute_force(spark, single_rows):
    df = spark.range(2000).selectExpr(
        "id AS k", "if(id < 300 OR id % 211 <> 0, NULL, cast(id AS double)) AS v", "cast(NULL AS double) AS e")
    got = carry_values(df, "k", ["v", "e"], buckets=32, single_rows=single_rows).toPandas().sort_values("k")
    want = df.toPandas().sort_values("k").v.ffill().bfill()
    assert got.v.tolist() == want.tolist() and got.e.isna().all()


@pytest.mark.parametrize("single_rows", [0, 1, 10_000])
def test_hash_cuts_find_the_exact_rank(spark, single_rows):
    df = spark.range(5000).withColumn("g", F.col("id") % 2).withColumn("h", hash_key(42, F.col("id")))
    pdf = df.toPandas()
    cuts = hash_cuts(df, "h", {0: [1, 700], 1: [2500, 0]}, col("g"), single_rows)
    for (g, r), cut in cuts.items():
        ordered = sorted(pdf[pdf.g == g].h)
        assert cut == (ordered[r - 1] if r else None)
    with pytest.raises(ValueError, match="fewer"):
        hash_cuts(df, "h", {0: [2501]}, col("g"))


def test_broadcast_only_behind_a_size_check(spark):
    left, right = spark.range(1000), spark.range(100)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = left.join(broadcastable(right), "id")._jdf.queryExecution().executedPlan().toString()
        large = left.join(broadcastable(right, 10), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


def test_describe(make):
    df = make("a double, s string", (1.0, "x"), (2.0, "y"), (3.0, "y"), (None, None))
    assert values(D.describe_numeric(df), "count", "mean", "std", "min", "q25", "q50", "q75", "max") == [
        (3, 2.0, 1.0, 1.0, 1.5, 2.0, 2.5, 3.0)]
    assert values(D.describe_categorical(df), "count", "unique", "top", "freq") == [(3, 2, "y", 2)]


def test_histogram_equals_numpy(spark):
    df = spark.range(1000).selectExpr("cast(id * id % 997 AS double) AS v")
    counts, edges = np.histogram(df.toPandas().v, bins=40)
    got = {r["bin"]: r["n"] for r in D.histogram(df, "v").collect()}
    assert [got.get(i, 0) for i in range(40)] == counts.tolist()
    assert values(D.histogram(make_constant(spark), "v", 4), "bin", "n") == [(0, 5)]


def make_constant(spark):
    return spark.range(5).selectExpr("7.0D AS v")


def test_boxplot(spark):
    df = spark.range(101).selectExpr("if(id = 100, 1000.0D, cast(id AS double)) AS v", "id % 2 AS g")
    row = D.boxplot_stats(df, "v").first()
    pdf = df.toPandas()
    q1, q3 = pdf.v.quantile(0.25), pdf.v.quantile(0.75)
    inside = pdf.v[(pdf.v >= q1 - 1.5 * (q3 - q1)) & (pdf.v <= q3 + 1.5 * (q3 - q1))]
    assert (row.q1, row.q3, row.whisker_low, row.whisker_high, row.n_outliers) == (
        q1, q3, inside.min(), inside.max(), 1)
    assert {r.group for r in D.boxplot_stats(df, "v", "g").collect()} == {"0", "1"}


def test_kde_equals_brute_force(spark):
    df = spark.range(60).selectExpr("cast(id * id % 31 AS double) AS v", "id % 2 AS g")
    got = D.kde(df, "v", "g", points=50, cells=None).toPandas()
    for g, part in df.toPandas().groupby("g"):
        v = part.v.to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        lo, hi = v.min() - (v.max() - v.min()) / 2, v.max() + (v.max() - v.min()) / 2
        x = np.linspace(lo, hi, 50)
        density = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
        mine = got[got.group == str(g)].sort_values("point")
        assert np.allclose(mine.x, x) and np.allclose(mine.density, density)


@pytest.mark.parametrize("cells", [1, 4, 64])
def test_density_in_cells_keeps_its_bound(spark, cells):
    df = spark.range(20_000).select(F.pow(F.rand(3), 3).alias("v"), (F.col("id") % 2).alias("g"))
    exact = D.kde(df, "v", "g", points=200, cells=None).toPandas().sort_values(["group", "point"])
    rough = D.kde(df, "v", "g", points=200, cells=cells).toPandas().sort_values(["group", "point"])
    h = df.toPandas().groupby("g").v.apply(lambda v: v.std(ddof=1) * len(v) ** -0.2).min()
    assert np.abs(exact.density.to_numpy() - rough.density.to_numpy()).max() <= 0.05 / (h * cells**2) + 1e-12
    assert np.allclose(exact.x, rough.x)


def test_moments_and_zscores(spark):
    df = spark.range(200).selectExpr("cast(id * id AS double) AS v", "1.0D AS c")
    pdf = df.toPandas()
    d = pdf.v - pdf.v.mean()
    row = {r.column: r for r in D.moments(df).collect()}["v"]
    assert row.skewness == pytest.approx(round((d**3).mean() / (d**2).mean() ** 1.5, 4))
    assert row.kurtosis == pytest.approx(round((d**4).mean() / (d**2).mean() ** 2 - 3, 4))
    scored = D.zscore_columns(df).toPandas()
    assert np.allclose(scored.v_zscore, d / pdf.v.std(ddof=0)) and scored.c_zscore.isna().all()


def _ks(values, mean, sd):
    v = np.sort(values)
    expected = np.array([0.5 * math.erfc((mean - x) / sd / math.sqrt(2)) for x in v])
    last, first = np.searchsorted(v, v, "right") / len(v), np.searchsorted(v, v, "left") / len(v)
    return max(np.abs(last - expected).max(), np.abs(first - expected).max())


@pytest.mark.parametrize("range_rows", [5, 1_000_000])
def test_ks_equals_brute_force(spark, range_rows):
    df = spark.range(3000).select(
        F.randn(7).alias("bell"), F.pow(F.rand(7), 4).alias("skewed"),
        F.when(F.col("id") % 3 == 0, 42.0).when(F.col("id") % 50 == 1, None).otherwise(F.rand(9) * 100).alias("hot"),
        F.when(F.col("id") == 5, 1e12).when(F.col("id") == 6, float("nan")).otherwise(F.rand(4)).alias("far"),
        (F.col("id") % 4).alias("few"), F.lit(1.0).alias("flat"), F.lit(None).cast("double").alias("none"))
    pdf = df.toPandas()
    got = {r.column: r for r in D.ks_normality(df, range_rows=range_rows).collect()}
    assert set(got) == {"bell", "skewed", "hot", "far", "few"}
    for c, r in got.items():
        v = pdf[c].dropna().to_numpy(float)
        assert r.ks_statistic == pytest.approx(_ks(v, v.mean(), v.std(ddof=1)), abs=2e-6)
    assert got["bell"].p_value > 0.01 > got["skewed"].p_value


def test_ks_p_values_and_normal_distribution(spark):
    """Known quantiles of the limit, both ends of the series, and the library's distribution function."""
    z = [-9.0, -7.9, -3.0, -0.1, 0.0, 0.5, 2.0, 6.0, 9.0]
    cdf = spark.createDataFrame([(v,) for v in z], "z double").select("z", normal_cdf(F.col("z")).alias("p"))
    for r in cdf.collect():
        assert r.p == pytest.approx(0.5 * math.erfc(-r.z / math.sqrt(2)), abs=1e-14)
    n = 10**10
    known = [(1.3580986, 0.05), (1.6276236, 0.01), (0.8275736, 0.5), (0.5711653, 0.9), (0.0, 1.0), (30.0, 0.0)]
    for x, p in known:
        row = spark.range(1).select(kolmogorov_p(F.lit(x / math.sqrt(n)), F.lit(n)).alias("p")).first()
        assert row.p == pytest.approx(p, abs=1e-4)


def test_correlations_equal_pandas_with_gaps_and_constants(spark):
    df = spark.range(500).selectExpr(
        "cast(id AS double) AS a", "if(id % 7 = 0, NULL, 2.0D * id + id % 5) AS b",
        "if(id % 3 = 0, NULL, cast(id * id % 101 AS double)) AS c", "4.25D AS flat", "cast(NULL AS double) AS none",
        "1e9D + id % 2 AS far").repartition(7)
    pdf = df.toPandas().astype(float)
    pdf["far"] -= 1e9  # the shift costs pandas digits, not the operator
    want = pdf.corr()
    for r in K.pearson_matrix(df).collect():
        expected = want.loc[r.column_a, r.column_b]
        if math.isnan(expected):
            assert r.r is None, r
        else:
            assert r.r == pytest.approx(expected, abs=1e-9), r
    assert K.pearson_matrix(df).count() == 36


def test_high_pairs_and_risk(spark):
    df = spark.range(10).selectExpr("cast(id AS double) AS feature1", "2.0D * id AS feature2", "id % 2 AS odd")
    pairs = K.high_correlation_pairs(df)
    assert values(pairs) == [("feature1", "feature2", 1.0)]
    assert values(K.multicollinearity_risk(pairs)) == [(1, "low")]
    assert values(K.top_corr_pairs(df, k=1), "feature_1", "feature_2") == [("feature1", "feature2")]


def test_anova_equals_brute_force(spark):
    df = spark.range(300).selectExpr("id % 3 AS y", "cast(id % 3 * 2 + id % 11 AS double) AS x", "1.0D AS flat")
    pdf = df.toPandas()
    groups = [g.x.to_numpy() for _, g in pdf.groupby("y")]
    grand = pdf.x.mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups) / 2
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (300 - 3)
    scores = {r.feature: r.f_score for r in K.anova_f_scores(df, "y", ["x", "flat"]).collect()}
    assert scores["x"] == pytest.approx(between / within) and scores["flat"] is None


def test_mutual_information_ranks_features(spark):
    df = spark.range(1000).selectExpr("id % 2 AS y", "cast(id % 2 * 10 + id % 5 AS double) AS strong", "cast(id div 2 % 7 AS double) AS weak")
    mi = {r.feature: r.mutual_info for r in K.mutual_information(df, "y", ["strong", "weak"]).collect()}
    assert mi["strong"] == pytest.approx(math.log(2), abs=1e-9) and mi["weak"] < 0.02


def test_target_distribution(spark):
    df = spark.range(105).selectExpr("if(id < 5, 1, 0) AS target_default")
    assert values(G.target_distribution(df)) == [(5, 100, 20.0, round(100 / 105, 4))]
    none = G.target_distribution(df.where("target_default = 0")).first()
    assert none.imbalance_ratio == math.inf


def test_rates_trend_and_extremes(make):
    df = make("sub_grade string, target_default int, issue_d string, loan_amnt double",
              ("A", 1, "2020-01-05", 10.0), ("A", 0, "2020-01-20", 20.0), ("B", 0, "2020-02-01", None),
              ("C", 1, "bad", 5.0), (None, 1, "2020-02-02", 7.0), ("D", None, None, 1.0))
    rates = G.default_rate_by(df, "sub_grade")
    assert values(rates, order=["sub_grade"]) == [("A", 0.5, 2), ("B", 0.0, 1), ("C", 1.0, 1), ("D", None, 0)]
    assert values(G.extreme_groups(rates, "sub_grade")) == [("B", 0.0, "C", 1.0)]
    assert values(G.monthly_trend(df), order=["ym"]) == [("2020-01", 2, 0.5, 15.0), ("2020-02", 1, 0.5, 7.0)]


def test_categories_keep_the_most_frequent(spark):
    df = spark.range(600).selectExpr("concat('v', cast(sqrt(id) AS int)) AS c", "cast(id % 2 AS int) AS target_default",
                                     "if(id % 2 = 0, NULL, 'x') AS half")
    got = G.default_by_category(df, top=8)
    assert got.where("column = 'c'").count() == 8
    assert values(got.where("column = 'half'"), "value", "default_rate", "n") == [("x", 1.0, 300)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_value_counts_and_class_difference(make):
    df = make("c string, target_default int, dti double", ("a", 0, 1.0), ("b", 1, 4.0), ("b", 1, 6.0), (None, 0, 3.0))
    assert values(G.value_counts(df, "c")) == [("b", 2), ("a", 1)]
    assert values(G.value_counts(df, "c", n=1, with_nulls=True)) == [("b", 2)]
    assert values(G.class_mean_difference(df)) == [("dti", 2.0, 5.0, 3.0)]


def test_profiles(make):
    df = make("id long, home string, n string", (1, "RENT", "100"), (2, "rent", "200"), (3, "RENT", "300"), (4, "Rent", None))
    flags = {r.column: r for r in Pr.profile_categorical(df).collect()}
    assert flags["home"].inconsistent and flags["home"].unique_count == 3
    assert flags["n"].cardinality_flag == "all_unique"
    assert values(Pr.suspected_type_mismatch(df), "column") == ["n"]
    assert values(Pr.total_nulls(df)) == [1]
    assert values(Pr.missing_fraction(df)) == [("n", 0.25, "medium")]
    assert values(Pr.top_values(df, ["home"]), "value", "n", order=["place"]) == [("RENT", 2), ("Rent", 1), ("rent", 1)]
    row = Pr.profile_table(df).first()
    assert (row.n_rows, row.n_cols, row.n_numeric, row.n_text, row.total_nulls, row.surplus_rows) == (4, 3, 1, 2, 1, 0)


def test_empty_and_constant_categories(make):
    df = make("e string, c string", *[(None, "k")] * 3)
    flags = {r.column: r.cardinality_flag for r in Pr.profile_categorical(df).collect()}
    assert flags == {"e": "all_unique", "c": "constant"}


def test_duplicate_rows(make):
    df = make("id int, v int", (1, 1000), (1, 1000), (2, 2000), (3, None), (3, None), (3, None))
    assert values(Pr.duplicate_rows(df)) == [(3, 5)]
    assert values(Pr.sample_duplicates(df, "id")) == [1, 3]


def test_suite(make):
    df = make("id int, int_rate double, dti double, term string, loan_amnt double",
              (1, 5.0, 10.0, "36 months", 1.0), (1, 120.0, -3.0, " ", 2.0), (2, None, 5.0, None, 3.0), (3, 6.0, 7.0, "x", None))
    found = {(r.expectation, r.column): (r.unexpected_count, r.status) for r in Q.run_suite(df).collect()}
    assert found["unique", "id"] == (2, "FAIL")
    assert found["rate_range", "int_rate"] == (1, "FAIL") and found["rate_range", "dti"] == (1, "FAIL")
    assert found["non_negative", "dti"] == (1, "FAIL") and found["non_negative", "int_rate"] == (0, "PASS")
    assert found["not_null", "loan_amnt"] == (1, "FAIL") and found["not_null", "id"] == (0, "PASS")
    assert found["not_blank", "term"] == (1, "FAIL")
    assert values(Q.overall(Q.run_suite(df)), "result") == ["FAILED"]
    assert ("unique", "id") not in {(r.expectation, r.column) for r in Q.run_suite(df.drop("id")).collect()}


def test_suite_without_violations_passes(spark):
    df = spark.range(20).selectExpr("id", "cast(id AS double) AS int_rate")
    assert values(Q.overall(Q.run_suite(df)), "result") == ["PASSED"]


def test_rules_share_one_scan(spark):
    df = spark.range(10).selectExpr("id", "cast(id AS double) AS dti", "'a' AS term")
    rules = [*Q.non_negative(df), *Q.rate_range(df), *Q.not_null(df), *Q.not_blank(df)]
    plan = Q.check(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert len(rules) == 7 and plan.count("Range (") == 1


def test_samples_of_unexpected_values(spark):
    df = spark.range(50).selectExpr("cast(id - 10 AS double) AS dti")
    got = Q.unexpected_samples(df, Q.non_negative(df))
    assert got.count() == 3 and set(values(got, "column")) == {"dti"}


def test_statistical_report(make):
    df = make("a double, b double, c string", *[(float(i), 2.0 * i, "x") for i in range(10)])
    sections = {r.section for r in Q.statistical_report(df).collect()}
    assert sections == {"Profile", "Duplicates", "Categorical", "Distribution", "Relationships"}


