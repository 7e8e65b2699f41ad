"""The registered queries and the pipeline."""

from __future__ import annotations

import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from riskloom.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_is_its_sql(name, result):
    db = duckdb.connect()
    for file in os.listdir(SMALL):
        db.sql(f"create view {file.split('.')[0]} as select * from '{SMALL}/{file}'")
    found, wanted = result(name), db.sql(queries.SQL[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    a, b = (df[columns].sort_values(columns).reset_index(drop=True).astype(str) for df in (found, wanted))
    assert len(a) and a.equals(b)


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.SQL) <= set(entry.oracle_sql())


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.schema == docs.schema and 0 < after.count() <= docs.count()
        if name == "quality classifier":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            good = docs.join(labels.where("quality = 1"), "doc_id")
            assert good.join(after, "doc_id", "left_semi").count() >= 0.97 * good.count()
            assert after.subtract(docs).count() == 0
        if name == "line dedup":
            assert after.count() == docs.count()
            lines = after.select(F.explode(F.split("text", "\n")).alias("x")).where("trim(x) <> ''")
            assert lines.count() == lines.distinct().count()
            assert after.where(F.length("text") != F.col("n_chars")).join(docs, ["doc_id", "text"]).count() == after.where(
                F.length("text") != F.col("n_chars")).count()
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.count()
    whole = corpus_pipeline.run(spark, SMALL)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, packed.select(columns).collect()))


def test_stages_keep_columns_of_any_name(spark):
    """Columns that stages use for themselves, and a table without `n_chars`."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(80).select("doc_id", "text")
    given = docs.withColumns({c: F.concat(F.lit("own "), "doc_id") for c in ("score", "predicted", "n_dropped", "uid", "cell", "fp", "h1")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, given, SMALL)
        assert after.columns == given.columns and after.count() > 0
        for c in given.columns[2:]:
            assert after.where(F.col(c) != F.concat(F.lit("own "), "doc_id")).isEmpty()


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_rest_works_without_this_folder(tmp_path):
    """A copy of the library without the folder still offers its other queries, whether the pipeline stands beside it or not."""
    import subprocess
    import sys

    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for part in ("riskloom", "catalogue"):
        shutil.copytree(f"{home}/{part}", tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for file in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(f"{home}/{file}", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.returncode == 0, said.stderr
    assert said.stdout.split(maxsplit=1)[1].strip() == "[]" and int(said.stdout.split()[0]) > 100
