"""Exact top-k inner products by a vector-approximation file."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import finite_vector, slices
from riskloom.session import materialize, ship_package

SCALE = 1024
# Cells per component, as bits; one byte each in the file.
BITS = 8
# Vectors of one block of the approximation file, and queries that meet it at a time.
BLOCK = 4096
QUERY_BLOCK = 512
# Blocks on either side of a tile at most (16 MB of the file and as much of the queries for 64
# components), and pairs of tiles below which tiles stay smaller.
TILE = 64
TILES = 1024
# Exact vectors read per query in the first round, as a multiple of k.
FIRST_ROUND = 2


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """`id`, `v` (floor(scale * x) of each component, as long) of the rows that take part; repeated rows once.

    Components end where products of vectors of their length could leave a long: 2^28 for 64 of them.
    """
    ship_package(vectors.sparkSession)
    most = F.floor(F.sqrt(F.lit(float(1 << 62)) / F.size(vec_col)))
    comps = F.transform(
        vec_col, lambda x: F.greatest(-most, F.least(most, F.floor(x.cast("double") * F.lit(float(scale)))))
    )
    rows = vectors.where(finite_vector(vec_col) & F.col(id_col).isNotNull())
    return rows.select(F.col(id_col).alias("id"), comps.alias("v")).distinct()


def component_ranges(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """By length of the vectors: least and largest value of each component, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in slices(batches):
            for size, (_, values) in _by_size(batch.column(0), batch.column(0)).items():
                low, high, n = seen.get(size, (values[0], values[0], 0))
                seen[size] = [
                    np.minimum(low, values.min(axis=0)), np.maximum(high, values.max(axis=0)), n + len(values)
                ]
        for size, (low, high, n) in seen.items():
            columns = [np.full(size, size), np.arange(size), low, high, np.full(size, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "at", "low", "high", "n"])

    found = rows.select("v").mapInArrow(run, "size long, at long, low long, high long, n long").groupBy("size", "at")
    out: dict[int, list] = {}
    for r in found.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect():
        low, high, _ = out.setdefault(r["size"], [np.zeros(r["size"]), np.zeros(r["size"]), r["n"]])
        low[r["at"]], high[r["at"]] = r["low"], r["high"]
    return {size: tuple(x) for size, x in out.items()}


def _by_size(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[pa.Array, np.ndarray]]:
    """Ids and values of the vectors of each length, as matrices."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = {}
    for size in np.unique(lengths).tolist():
        at = pa.array(np.flatnonzero(lengths == size))
        out[size] = ids.take(at), vectors.take(at).flatten().to_numpy().reshape(-1, size)
    return out


def cells(values: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    """The cell of each component: equal steps between the least and the largest value."""
    return ((values - low) // cell_width(low, high, bits)).astype(np.uint8)


def cell_width(low: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    return np.floor((high - low) / (1 << bits)) + 1


def bounds(queries: np.ndarray, cell: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query with any integer vector of each cell row.

    One product with the lower corners of the cells; what a cell's width may add or take
    is the same for all rows.
    """
    lower = (low + cell * width).T
    corner = queries @ lower
    down, up = np.minimum(queries, 0) @ (width - 1), np.maximum(queries, 0) @ (width - 1)
    # What rounding may take from a sum of doubles; nothing while all products are below 2^53.
    reach = np.maximum(np.abs(lower), np.abs(lower + (width - 1)[:, None])).max(initial=0.0)
    most = np.abs(queries).sum(axis=1, keepdims=True) * reach
    slack = np.where(most < 1 << 53, 0.0, most * 2.0**-40)
    return corner + down[:, None] - slack, corner + up[:, None] + slack


def _blocks(rows: DataFrame, count: Column, seed: int, encode) -> DataFrame:
    """Rows of one length packed into blocks: `size`, `block`, `ids` and `data` as bytes."""
    keyed = rows.select(
        F.size("v").cast("long").alias("size"), F.pmod(F.xxhash64("id", F.lit(seed)), count).alias("block"), "id", "v"
    )

    def pack(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        values = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, size)
        return pa.table(
            {
                "size": pa.array([size], pa.int64()),
                "block": table.column("block").slice(0, 1),
                "ids": pa.array([table.column("id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "data": pa.array([encode(values, size).tobytes()], pa.binary()),
            }
        )

    return keyed.groupBy("size", "block").applyInArrow(pack, "size long, block long, ids binary, data binary")


def candidates(
    data: DataFrame, queries: DataFrame, ranges: dict[int, tuple[np.ndarray, np.ndarray, int]], k: int, bits: int
) -> DataFrame:
    """`query_id`, `id`, `most`: per tile and query those that the bounds inside the tile cannot rule out.

    A tile of the file and one of the queries (blocks with the same `size`, `tile` and
    `query_tile`) meet in one task, which compares them block by block. `least` comes along:
    the kth largest of all lower bounds of a query rules out more across the tiles.
    """

    def unpacked(table: pa.Table, size: int, kind: type) -> list[tuple[np.ndarray, np.ndarray]]:
        blocks = zip(table.column("ids").to_pylist(), table.column("data").to_pylist())
        return [(np.frombuffer(i, np.int64), np.frombuffer(d, kind).reshape(-1, size)) for i, d in blocks]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))]
        if left.num_rows and right.num_rows:
            size = left.column("size")[0].as_py()
            low, high, _ = ranges[size]
            width = cell_width(low, high, bits)
            file = unpacked(left, size, np.uint8)
            for query_ids, wanted in unpacked(right, size, np.int64):
                best = np.full((len(query_ids), k), -np.inf)
                some = []
                for ids, cell in file:
                    least, most = bounds(wanted.astype(np.float64), cell.astype(np.float64), low, width)
                    own = query_ids[:, None] == ids[None, :]
                    least[own], most[own] = -np.inf, -np.inf
                    best = np.partition(np.concatenate([best, least], axis=1), -k, axis=1)[:, -k:]
                    q, c = np.nonzero((most >= best[:, :1]) & ~own)
                    some.append((q, ids[c], most[q, c], least[q, c]))
                q, ids, most, least = map(np.concatenate, zip(*some))
                kept = most >= best[q, 0]
                found.append((query_ids[q[kept]], ids[kept], most[kept], least[kept]))
        columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
        return pa.table(dict(zip(("query_id", "id", "most", "least"), columns)))

    key = ("size", "tile", "query_tile")
    met = data.groupBy(*key).cogroup(queries.groupBy(*key))
    return met.applyInArrow(run, "query_id long, id long, most double, least double")


def tile_edge(pairs: int) -> int:
    """Blocks on either side of a tile, for so many pairs of blocks."""
    return min(TILE, max(1, math.isqrt(pairs // TILES)))


def _score(cands: DataFrame, rows: DataFrame) -> DataFrame:
    """Candidates with the exact inner product of the integer vectors."""
    wanted = cands.hint("merge").join(rows.select("id", "v"), "id").join(
        rows.select(F.col("id").alias("query_id"), F.col("v").alias("q")).hint("merge"), "query_id"
    )
    products = F.zip_with("v", "q", lambda a, b: a * b)
    return wanted.select("query_id", "id", F.aggregate(products, F.lit(0).cast("long"), lambda s, x: s + x).alias("score"))


def top_k(
    vectors: DataFrame,
    queries: Callable[[Column], Column],
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    bits: int = BITS,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """`query_id`, `rank`, `id`, `score`: the k largest integer inner products of every query row.

    Each row is cut to integers and quantised into the approximation file, one byte per
    component, staged in blocks. Every block meets every block of queries, tile by tile: cells give a lower
    and an upper bound of each product. A row whose upper bound is under the kth lower
    bound of the query is out. The exact vectors of the rest are read in the order of
    their bounds, a first round of `FIRST_ROUND * k` per query and a second one of those
    whose bound still reaches the kth exact score, after which the result is certain.

    `queries` says by the id which rows ask. Ties go to the smaller id, and no row meets its own
    id. Ids are whole numbers. Null vectors, empty ones, those with null or non-finite
    components, and null ids take no part; rows that repeat id and vector count once; only
    vectors of one length are compared; other columns are ignored; with fewer than k
    others all are returned; an empty table gives an empty result. Components whose
    products could leave a long (beyond 2^28 after scaling, for 64 components) count as that limit.
    """
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    ranges = component_ranges(rows)
    out = f"query_id long, rank int, {id_col} long, score long"
    if not ranges:
        return vectors.sparkSession.createDataFrame([], out)
    per_size = F.create_map(*(F.lit(x) for size, (_, _, n) in ranges.items() for x in (size, -(-n // block))))
    count = per_size[F.size("v")]

    def encode(values: np.ndarray, size: int) -> np.ndarray:
        low, high, _ = ranges[size]
        return cells(values, low, high, bits)

    file = materialize(_blocks(rows, count, 1, encode), "approximations")
    asked = rows.where(queries(F.col("id")))
    total = asked.count()
    blocks = max(1, -(-total // query_block))
    packed = materialize(_blocks(asked, F.lit(blocks), 2, lambda values, _: values.astype(np.int64)), "queries")
    # Each pair of tiles meets under a key of its own, so no key is larger than another. Tiles grow with
    # the table, so what is copied for their meeting grows with it too, not with its square.
    edge = {size: tile_edge(-(-n // block) * blocks) for size, (_, _, n) in ranges.items()}
    edges = F.create_map(*(F.lit(x) for item in edge.items() for x in item))[F.col("size").cast("int")]

    def tiles(of: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.floor((of - 1) / edges)))

    own = F.floor(F.col("block") / edges)
    data = file.select("size", own.alias("tile"), tiles(F.lit(blocks)).alias("query_tile"), "ids", "data")
    count = per_size[F.col("size").cast("int")]
    spread = packed.select("size", tiles(count).alias("tile"), own.alias("query_tile"), "ids", "data")
    found = materialize(candidates(data, spread, ranges, k, bits), "candidates")

    by_query = Window.partitionBy("query_id")
    kth = (
        found.withColumn("r", F.row_number().over(by_query.orderBy(F.desc("least"))))
        .where(F.col("r") <= k)
        .groupBy("query_id")
        .agg(F.when(F.count("*") == k, F.min("least")).otherwise(F.lit(float("-inf"))).alias("kth"))
    )
    likely = found.join(kth.hint("merge"), "query_id").where("most >= kth").select("query_id", "id", "most")
    order = by_query.orderBy(F.desc("most"), "id")
    likely = materialize(likely.withColumn("r", F.row_number().over(order)), "bound-order")
    first = materialize(_score(likely.where(F.col("r") <= FIRST_ROUND * k), rows), "first-round")
    best = by_query.orderBy(F.desc("score"), "id")
    sure = (
        first.withColumn("n", F.row_number().over(best))
        .where(F.col("n") == k)
        .select("query_id", F.col("score").alias("sure"))
    )
    rest = likely.where(F.col("r") > FIRST_ROUND * k).join(sure.hint("merge"), "query_id").where("most >= sure")
    ranked = first.union(_score(rest, rows)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(
        F.col("query_id").cast("long"), F.col("rank").cast("int"), F.col("id").cast("long").alias(id_col), "score"
    )
