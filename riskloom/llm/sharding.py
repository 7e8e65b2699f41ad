"""Shards of equal size by histogram sort, on DataFrame functions alone."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import broadcastable, discard, materialize

# Bits of a key: the first fifteen hex digits of an md5.
KEY_BITS = 60
# Candidate boundaries counted in one round, of all splitters together.
PROBES = 1 << 16
# A splitter settles within one part in so many of a shard.
PARTS = 200
# Bytes that a document takes besides its text.
OVERHEAD = 8
# Rows numbered together.
BUCKET_ROWS = 16_384


def round_bits(shards: int) -> int:
    """Key bits by which a round refines the probes around every splitter."""
    return max(4, PROBES.bit_length() - 1 - (shards - 1).bit_length())


def _key(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `text_col`, `size`, `text_crc32` and the sort key: `h` by the text, `g` by id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col),
        F.col(text_col),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"),
    )
    own = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), "digest").cast("binary"))
    return rows.withColumns({"h": _key(F.col("digest")), "g": _key(own)}).drop("digest")


def _cells(sizes: DataFrame, level: str, before: int, shift: int, pending: dict[int, tuple[int, int, int]]) -> dict:
    """The cells inside every pending interval: (`h`, interval) to its (cell, bytes, rows) in key order."""
    rows = sizes
    if level == "g":
        rows = rows.where(F.col("h").isin(sorted({h for _, h, _ in pending.values()})))
    if before < KEY_BITS:
        rows = rows.where(F.shiftright(level, before).isin(sorted({prefix for *_, prefix in pending.values()})))
    group = F.col("h") if level == "g" else F.lit(0).cast("long")
    counts = rows.groupBy(group.alias("group"), F.shiftright(level, shift).alias("cell")).agg(F.sum("size"), F.count("*"))
    cells: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for group, cell, n, rows in sorted(map(tuple, counts.collect())):
        cells.setdefault((group, cell >> before - shift), []).append((cell, n, rows))
    return cells


def splitters(sizes: DataFrame, shards: int) -> list[tuple[int, int]]:
    """Keys (`h`, `g`) at which each shard but the first begins, for a staged table `h`, `g`, `size`.

    The bytes below evenly spaced candidate keys are counted exactly, over all
    partitions at once; each splitter then goes on with the interval that holds its
    target, cut into as many candidates again, until one is within the tolerance. Equal
    texts share `h`; only where no text begins near enough is a group cut, along `g`.
    """
    total = sizes.agg(F.sum("size")).first()[0]
    if not total:
        return []
    bits = round_bits(shards)
    # Splitter: bytes below its interval, the text's key once that is known, the interval.
    pending = {i: (0, 0, 0) for i in range(1, shards)}
    found: dict[int, tuple[int, int]] = {}
    for level in ("h", "g"):
        if level == "g":
            pending = {i: (below, h, 0) for i, (below, _, h) in pending.items()}
        shift = KEY_BITS
        while shift and pending:
            before, shift = shift, max(0, shift - bits)
            cells = _cells(sizes, level, before, shift, pending)
            for i, (below, h, prefix) in list(pending.items()):
                edges, inside, single = [], None, False
                for cell, n, rows in cells[h, prefix]:
                    edges.append((below, cell << shift))
                    if inside is None and (below + n) * shards > total * i:
                        inside, single = (below, h, cell), rows == 1
                    below += n
                edges.append((below, prefix + 1 << before))
                gap, key = min((abs(at * shards - total * i), key) for at, key in edges)
                if gap * PARTS <= total or single or (level == "g" and not shift):
                    found[i] = (key, 0) if level == "h" else (h, key)
                    del pending[i]
                else:
                    pending[i] = inside
    return [found[i] for i in range(1, shards)]


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `text_col`, `size`, `text_crc32`, `shard`, `slot` for every row.

    `size` is the text's UTF-8 bytes and eight more. Rows are sorted by a hash of the
    text and cut at the splitters, so shards differ by one part in a hundred, or by a
    document if that is more. Copies of a text lie in one shard, unless their group
    stands at a splitter and is too large to move. `slot` numbers a shard's rows
    without gaps in the order of a hash of id and text. A null text counts as empty; rows
    that repeat id and text stand beside each other; a null id is a value like others;
    other columns are ignored; an empty table gives an empty one.

    Rows are exchanged once, into buckets of a bounded number of rows.
    """
    rows = keyed(docs, id_col, text_col)
    sizes = materialize(rows.select("h", "g", "size"), "shard-keys")
    cuts = [{"h": h, "g": g} for h, g in splitters(sizes, shards)]
    # One constant instead of an expression per splitter: plans stay small.
    table = F.from_json(F.lit(json.dumps(cuts)), "array<struct<h:bigint,g:bigint>>")
    passed = F.filter(table, lambda s: (s.h < F.col("h")) | ((s.h == F.col("h")) & (s.g <= F.col("g"))))
    bits = max(0, (sizes.count() // (shards * BUCKET_ROWS)).bit_length())
    place = {"shard": F.size(passed), "bucket": F.shiftright("g", KEY_BITS - bits)}
    counts = sizes.withColumns(place).groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    offsets = broadcastable(materialize(offsets, "shard-offsets"))
    discard(sizes)
    own = Window.partitionBy("shard", "bucket").orderBy("g", "h")
    numbered = rows.withColumns(place).withColumn("nth", F.row_number().over(own))
    return numbered.join(offsets, ["shard", "bucket"]).select(
        id_col, text_col, "size", "text_crc32", "shard", (F.col("offset") + F.col("nth") - 1).alias("slot")
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """The shards as folders `shard=0`, `shard=1`, … of Parquet files, each file in the order of its slots."""
    assigned.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
