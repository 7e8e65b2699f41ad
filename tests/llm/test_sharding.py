"""Shards by histogram sort."""

from __future__ import annotations

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from riskloom.llm import queries, sharding


def _sizes(rows):
    sizes: dict[int, int] = {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    return sizes


@pytest.fixture(scope="module")
def crowded(spark):
    """20 000 texts; a third of all rows hold one text, and one long text fills several shards."""
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text é "), F.repeat(F.col("id").cast("string"), 3))).alias("text"),
    )
    return rows.union(spark.createDataFrame([(20_000, "long " * 30_000)], rows.schema)).repartition(7)


@pytest.mark.parametrize("bucket", [100, 16_384])
def test_shards_are_even_and_slots_have_no_gaps(crowded, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    placed = sharding.assign_shards(crowded, 24).collect()
    assert sorted(r["doc_id"] for r in placed) == list(range(20_001))
    for r in placed:
        assert r["size"] == len(r["text"].encode()) + 8 and r["text_crc32"] == zlib.crc32(r["text"].encode())
    sizes, share = _sizes(placed), sum(r["size"] for r in placed) / 24
    long_one = next(r["shard"] for r in placed if r["doc_id"] == 20_000)
    # Only the shards around the long text may be off, by that text.
    assert sum(abs(n - share) > share / 100 + 60 for n in sizes.values()) <= 6 and sizes[long_one] >= 150_000
    for shard in sizes:
        slots = sorted(r["slot"] for r in placed if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    # Only the text of a third of all rows lies in more than one shard.
    shards_of: dict[str, set[int]] = {}
    for r in placed:
        shards_of.setdefault(r["text"], set()).add(r["shard"])
    assert {t for t, s in shards_of.items() if len(s) > 1} == {"the same text"}


def test_groups_stay_whole_where_another_boundary_is_near(spark):
    """Groups of copies smaller than the tolerance are never cut."""
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), (F.col("id") % 20_000).cast("string").alias("text"))
    placed = sharding.assign_shards(rows, 8)
    assert placed.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").isEmpty()
    sizes = sorted(r["n"] for r in placed.groupBy("shard").agg(F.sum("size").alias("n")).collect())
    assert len(sizes) == 8 and sizes[-1] - sizes[0] <= sizes[0] / 50


@pytest.mark.parametrize("shards", [1, 2, 24, 700])
def test_any_number_of_shards(crowded, shards):
    sizes = _sizes(sharding.assign_shards(crowded, shards).collect())
    assert set(sizes) <= set(range(shards)) and sum(sizes.values()) == crowded.select(F.sum(F.octet_length("text") + 8)).first()[0]


def test_the_sql_says_the_same_of_crowded_rows(spark, crowded, tmp_path):
    crowded.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_sharding(spark, str(tmp_path))
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = db.sql(queries.SQL["op13_sharding"])
    assert sorted(map(tuple, found.select(want.columns).collect())) == sorted(want.fetchall())


def test_shards_of_odd_texts(odd_docs):
    placed = sharding.assign_shards(odd_docs, 3).collect()
    assert len(placed) == odd_docs.count() and {r["shard"] for r in placed} <= {0, 1, 2}
    assert next(r["size"] for r in placed if r["doc_id"] == 0) == 8
    twice = [(r["shard"], r["slot"]) for r in placed if r["doc_id"] == 3 and r["text"] == "a"]
    assert len({s for s, _ in twice}) == 1 and len(set(twice)) == len(twice)
    assert sharding.assign_shards(odd_docs.limit(0), 3).collect() == []


def test_sharding_stays_in_the_jvm(crowded):
    plan = sharding.assign_shards(crowded, 24)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_written_shards_are_in_order(spark, crowded, tmp_path):
    sharding.write_shards(sharding.assign_shards(crowded, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 20_001 and back.select("shard").distinct().count() == 4
