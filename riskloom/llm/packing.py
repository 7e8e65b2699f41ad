"""Best-fit packing of tokenised documents: inside partitions first, then up a tree of merges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import word_bpe
from riskloom.llm.common import doc_texts, field, slices
from riskloom.session import materialize, ship_package

CAPACITY = 2048
END_ID = 0
# Items that one task packs at a time; only their lengths are held.
ITEMS_PER_TASK = 200_000
# So many partitions meet in one in each round.
FAN_IN = 8
# A bin with less free space than this share is done.
NEARLY_FULL = 1 / 128
MAX_ROUNDS = 40


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and offset of each item, and the fill of each bin; longest items first, each where least is left."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_sizes, fills = 0, []  # bit r is set if some bin has r tokens left
    for item, length in zip(order.tolist(), lengths[order].tolist()):
        wide = open_sizes >> length
        if wide:
            left = length + (wide & -wide).bit_length() - 1
            at = free[left].pop()
            if not free[left]:
                open_sizes ^= 1 << left
        else:
            at, left = len(fills), capacity
            fills.append(0)
        bins[item], offsets[item] = at, fills[at]
        fills[at] += length
        left -= length
        if left:
            free[left].append(at)
            open_sizes |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def token_pieces(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """`id_col`, `piece`, `start`, `length`, `ids` (binary, little-endian 32 bits each).

    A document's ids end with `end_id`; only a document of more than `capacity` ids is
    cut, its last piece may be shorter. A null or empty text has the one piece `end_id`.
    """
    rows = doc_texts(docs, id_col, text_col)
    names = [id_col, "piece", "start", "length", "ids"]
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_bpe.load(path).encode, end_id.to_bytes(4, "little")
        for batch in slices(batches):
            of, piece, start, parts = [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py()) + end
                for no, at in enumerate(range(0, len(ids), width)):
                    of.append(row)
                    piece.append(no)
                    start.append(at // 4)
                    parts.append(ids[at : at + width])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array([len(p) // 4 for p in parts], pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                names=names,
            )

    schema = T.StructType(
        [
            field(rows, id_col),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def _pack_partitions(items: DataFrame, capacity: int, per_task: int) -> DataFrame:
    """Every item with its first bin, its place there, and the bin's fill; no shuffle."""
    extra = ["_pack_bin", "_pack_at", "_pack_fill"]

    def packed(batches: list[pa.RecordBatch], base: int) -> tuple[pa.Table, int]:
        table = pa.Table.from_batches(batches)
        bins, offsets, fills = best_fit(table.column("length").to_numpy().astype(np.int64), capacity)
        for name, column in zip(extra, (bins + base, offsets, fills[bins])):
            table = table.append_column(name, pa.array(column))
        return table, len(fills)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, rows = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= per_task:
                table, used = packed(held, base)
                yield from table.to_batches()
                base, held, rows = base + used, [], 0
        if rows:
            yield from packed(held, base)[0].to_batches()

    schema = T.StructType([*items.schema.fields, *(T.StructField(c, T.LongType()) for c in extra)])
    return items.mapInArrow(run, schema)


def _merge_round(bins: DataFrame, tasks: int, seed: int, capacity: int) -> DataFrame:
    """Underfull bins (`bin`, `fill`) as items: `bin`, `parent`, `at`, `parent_fill`."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("fill", "descending"), ("bin", "ascending")])
        number, offsets, fills = best_fit(table.column("fill").to_numpy().astype(np.int64), capacity)
        ids = table.column("bin").to_numpy()
        # A merged bin is named after its first member.
        names = np.zeros(len(fills), np.int64)
        names[number[offsets == 0]] = ids[offsets == 0]
        return pa.table({"bin": ids, "parent": names[number], "at": offsets, "parent_fill": fills[number]})

    group = F.pmod(F.xxhash64("bin", F.lit(seed)), F.lit(tasks)).alias("task")
    return (
        bins.select(group, "bin", "fill")
        .groupBy("task")
        .applyInArrow(merge, "bin long, parent long, at long, parent_fill long")
    )


def pack(
    items: DataFrame,
    capacity: int = CAPACITY,
    per_task: int = ITEMS_PER_TASK,
    fan_in: int = FAN_IN,
    nearly_full: float = NEARLY_FULL,
) -> DataFrame:
    """`items` with `sequence_id` and `offset`: items of `length` 1 to `capacity` in few sequences.

    Each partition packs its own items best-fit; nearly full bins are done. The others
    move on as items, so many partitions together as `fan_in` says, round by round up to
    one task, or to as many as keep `per_task` bins each; then the bins up to half full
    meet alone, until one task holds them. Only bins move, never
    tokens, and items that fill a sequence alone are done at once. Sequences have no
    gaps; their numbers are arbitrary. An empty table gives an empty result.
    """
    ship_package(items.sparkSession)
    placed = materialize(_pack_partitions(items, capacity, per_task), "packed-items")
    first = placed.where("_pack_at = 0").select(F.col("_pack_bin").alias("bin"), F.col("_pack_fill").alias("fill"))
    done_at = capacity * (1 - nearly_full)
    under = first.where(F.col("fill") < done_at)
    size = placed.where("_pack_at = 0").agg(
        F.count(F.when(F.col("_pack_fill") < done_at, 1)).alias("n"),
        F.countDistinct(F.shiftright("_pack_bin", 40)).alias("tasks"),
    ).first()
    left, tasks = size["n"], size["tasks"]
    moves: DataFrame | None = None
    for turn in range(MAX_ROUNDS):
        before, tasks = tasks, max(1, -(-tasks // fan_in), -(-left // per_task))
        if turn and tasks == before and tasks > 1:
            # The bins are more than one task holds: those that can still take each other go on alone.
            under = under.where(F.col("fill") <= capacity // 2)
            left = under.count()
            tasks = max(1, -(-left // per_task))
        if left < 2:
            break
        step = materialize(_merge_round(under, tasks, turn, capacity), "packed-bins")
        if moves is None:
            moves = step.select("bin", F.col("parent").alias("seq"), F.col("at").alias("base"))
        else:
            above = step.select(F.col("bin").alias("seq"), "parent", "at")
            moves = materialize(
                moves.join(above, "seq", "left").select(
                    "bin", F.coalesce("parent", "seq").alias("seq"), (F.col("base") + F.coalesce("at", F.lit(0))).alias("base")
                ),
                "packed-moves",
            )
        under = step.where("at = 0").select(F.col("parent").alias("bin"), F.col("parent_fill").alias("fill"))
        under = under.where(F.col("fill") < done_at)
        left = under.count()
        if tasks == 1:
            break
    columns = [F.col(c) for c in items.columns]
    if moves is None:
        return placed.select(*columns, F.col("_pack_bin").alias("sequence_id"), F.col("_pack_at").alias("offset"))
    return placed.join(moves, placed["_pack_bin"] == moves["bin"], "left").select(
        *columns, F.coalesce("seq", "_pack_bin").alias("sequence_id"), (F.col("_pack_at") + F.coalesce("base", F.lit(0))).alias("offset")
    )


def pack_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Tokenised and packed documents: the pieces with `ids_crc32`, `sequence_id` and `offset`.

    Null texts are empty; null ids and repeated rows are packed as any other; other
    columns are ignored.
    """
    pieces = token_pieces(docs, path, id_col, text_col, capacity)
    sizes = pieces.select(id_col, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    # Staged, so that no task holds two Python workers, one of them with the vocabulary, at a time.
    return pack(materialize(sizes, "pieces"), capacity)
