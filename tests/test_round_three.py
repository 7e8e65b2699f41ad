"""Steps that did their work more often, or in fewer tasks, than the rows ask for."""

import pytest
from pyspark.sql import functions as F

from catalogue import models
from riskloom.operators import cleaning as C
from riskloom.plans import ensembles as N
from riskloom.plans.steps import run_steps


def test_training_tables_read_staged_loans(spark, tmp_path, monkeypatch):
    """F8 M7_linear_svm, F10 M6_logistic_regression: the passes of the medians do not repeat the joins behind the loans."""

    class Seen(Exception):
        pass

    def seen(rows):
        raise Seen(rows.inputFiles())

    loans = spark.range(20).selectExpr("id", "cast(id AS double) AS dti", "'f' AS initial_list_status")
    path = str(tmp_path / "loans")
    loans.write.parquet(path)
    monkeypatch.setattr(models.V, "loans", lambda *_: spark.read.parquet(path))
    monkeypatch.setattr(models.C, "median_fill", seen)
    with pytest.raises(Seen) as found:
        models.prepared(spark, str(tmp_path))
    assert found.value.args[0] and all("/riskloom/" in f for f in found.value.args[0])


def test_blocks_are_shared_among_cores(spark):
    """F13 M15_forest_importance, F11 M16_feature_importance: one staged file is not one task."""
    n = 4 * N.BLOCK_ROWS
    rows = spark.range(n, numPartitions=1).selectExpr("id", "cast(id % 97 AS double) AS x", "cast(id % 2 AS double) AS y")
    rounds = N._Rounds(N.binned(rows, ["x"], N.bin_edges(rows, ["x"]), "y", None))
    held = rounds.blocks.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()
    cores = spark.sparkContext.defaultParallelism
    assert rounds.rows == n == sum(r["n"] for r in held)
    assert len(held) > 1 and rounds.tasks == rounds.blocks.rdd.getNumPartitions() >= min(cores, 4)
    rounds.end()


def test_small_tables_stay_in_one_task(spark):
    rows = spark.range(50, numPartitions=1).selectExpr("id", "cast(id AS double) AS x", "cast(id % 2 AS double) AS y")
    rounds = N._Rounds(N.binned(rows, ["x"], N.bin_edges(rows, ["x"]), "y", None))
    assert (rounds.tasks, rounds.blocks.rdd.getNumPartitions(), rounds.rows) == (1, 1, 50)
    rounds.end()


def test_a_text_is_translated_once(spark):
    """F9 M19_clean_merged_dataset, F12 M20_collect_to_score: parts of the clean text are not worked out again."""
    given = ["a", " a\t b ", "a  b", "\xa0", "", "nan", " null", "None x", None]
    rows = spark.createDataFrame([(t,) for t in given], "t string").repartition(2)
    clean = C.strip_and_standardize_strings(rows)
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
    wanted = ["a", "a b", "a b", "None x"] + [None] * 5
    assert sorted((r["t"] for r in clean.collect()), key=str) == sorted(wanted, key=str)


def test_steps_keep_methods_compilable(spark):
    """the limit holds in the session of the steps, not in the caller's."""
    key, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(key)

    def step(df):
        seen.append(df.sparkSession.conf.get(key))
        return df

    result, _ = run_steps(spark.range(3).toDF("id"), [("look", step, {})])
    assert result.count() == 3 and seen == ["8000"] and spark.conf.get(key) == before
