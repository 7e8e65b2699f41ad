"""Near-duplicate documents by 64-bit SimHash fingerprints and pivot distance tables."""

from __future__ import annotations

import gc
import json
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import doc_texts, field, slices, text_key
from riskloom.llm.components import components
from riskloom.llm.prefixes import possible_pairs, shared_first
from riskloom.session import discard, materialize

SEED = 42
SHINGLE = 3
MAX_BITS = 2
# Documents whose texts may be fetched by a broadcast of their places (some 60 bytes each).
BROADCAST_PLACES = 200_000
# Shingles from which the chance of a bit to differ is taken from its limit for large sets.
SHORT = 14
# Likely partners of each row that are settled first, beside its nearest.
PARTNERS = 3
# Fingerprints on either side of one comparison inside a crowded cell.
BLOCK = 512
# Words of the fingerprints that compare the rows of a crowded cell.
WIDE = 32
# Chance that a pair of exactly the similarity meets in a cell, and the subsets of references of one wave.
RECALL = 0.995
WAVE = 96
# Bits of a subset at least.
LEAST_BITS = 16
# Hashes whose bits are spread and summed at a time.
_PART = 1 << 14

# The reference fingerprints: zero, and one for each group of three neighbouring bits
# (the last group has four). 63 bits hold three for every group's distance.
PIVOT_GROUPS = 21


def _mixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """More hash bits of the same shingles; the first 64 are the hash itself."""
    if turn == 0:
        return hashes
    x = hashes + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of `width` words, ASCII letters in lower case; of all words if there are fewer."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    width = min(width, len(tokens))
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(tokens) - width + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.empty(count, np.uint64)
    for at in range(0, count, _PART):
        till = min(count, at + _PART)
        pairs = zip(starts[at:till].tolist(), ends[at + width - 1 : till + width - 1].tolist())
        hashes[at:till] = np.fromiter((digest(joined[s:e], seed) for s, e in pairs), np.uint64, till - at)
    return hashes


def set_key(hashes: np.ndarray) -> int:
    """A hash that names a set of shingles (distinct, in order), as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED, words: int = 1, distinct: bool = False) -> list[int]:
    """SimHash of one text, 64 bits a word: a bit is set if more than half of the shingle hashes set it.

    Repeated shingles count as often as they are there, or once if `distinct`.
    """
    hashes = shingle_hashes(text, width, seed)
    return _folded(np.unique(hashes) if distinct else hashes, words)


def _folded(hashes: np.ndarray, words: int) -> list[int]:
    count = len(hashes)
    sums = np.zeros((words, 64), np.int64)
    for at in range(0, count, _PART):
        for turn in range(words):
            mixed = _mixed(hashes[at : at + _PART], turn)
            sums[turn] += _column_sums(np.unpackbits(mixed.astype(">u8").view(np.uint8)).reshape(-1, 64))
    return [int.from_bytes(np.packbits(2 * row > count).tobytes(), "big") for row in sums]


def _column_sums(bits: np.ndarray) -> np.ndarray:
    """Sums of 0/1 columns; up to 255 rows fit one byte, so eight columns add up as one number."""
    rows = len(bits) - len(bits) % 255
    total = bits[rows:].sum(axis=0, dtype=np.int64)
    if rows:
        packed = np.ascontiguousarray(bits[:rows]).view(np.uint64).reshape(-1, 255, 8)
        total += packed.sum(axis=1).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return total


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
    words: int = 1,
    distinct: bool = False,
    keyed: bool = False,
) -> DataFrame:
    """`id_col`, `fp` (64-bit words as signed longs) for every row; whole texts, no shuffle.

    A null text counts as empty; a text without words has fingerprint zero. With
    `keyed`, two hashes of the text (`h1`, `h2`) come along to find the row again, the
    number of its shingles (`n_shingles`) and a hash of their set (`s`).
    """
    rows = doc_texts(docs, id_col, text_col)
    keep = [id_col, "h1", "h2"] if keyed else [id_col]
    rows = rows.select(id_col, *(text_key(text_col) if keyed else ()), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = (shingle_hashes(t.as_py(), width, seed) for t in batch.column(len(keep)))
            sized = [(_folded(x, words), len(x), set_key(np.unique(x)) if keyed else 0) for x in (map(np.unique, sets) if distinct else sets)]
            values = [fp for fp, _, _ in sized]
            flat = pa.array(np.array(values, np.uint64).reshape(-1).view(np.int64))
            offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * words)
            columns = [*(batch.column(i) for i in range(len(keep))), pa.ListArray.from_arrays(offsets, flat)]
            if keyed:
                columns += [pa.array([n for _, n, _ in sized], pa.int32()), pa.array([s for *_, s in sized], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    schema = T.StructType([*(field(rows, c) for c in keep), T.StructField("fp", T.ArrayType(T.LongType()))])
    if keyed:
        schema = T.StructType([*schema, T.StructField("n_shingles", T.IntegerType()), T.StructField("s", T.LongType())])
    return rows.mapInArrow(run, schema)


def _mask(group: int) -> int:
    bits = 4 if group == PIVOT_GROUPS - 1 else 3
    value = ((1 << bits) - 1) << (3 * group)
    return value - (1 << 64) if value >> 63 else value


def pivot_distances(fp: Column) -> list[Column]:
    """Hamming distances to the reference fingerprints: zero first, then one per bit group."""
    zero = F.bit_count(fp)
    return [zero, *(F.bit_count(fp.bitwiseXOR(F.lit(_mask(g)))) for g in range(PIVOT_GROUPS))]


def pivot_cells(fps: DataFrame) -> DataFrame:
    """`fp`, `cell`: the cells of the distance table that a fingerprint shares with all others up to two bits away.

    The distances to zero and to a group's pivot give the number of bits set in the
    group; the numbers of all groups, three bits each, name a cell of the table. Two
    fingerprints that differ in one bit lie in neighbouring cells; two that differ in
    two bits have a common neighbour. So each emits its own cell and those one step
    away. Fingerprints without a common cell have some pivot distance that differs by
    more than two, or differ by more than two in all, and are discarded.
    """
    zero, *others = pivot_distances(F.col("fp"))
    sizes = [4 if g == PIVOT_GROUPS - 1 else 3 for g in range(PIVOT_GROUPS)]
    # d(f, group) = |f| + size - 2 * set bits of f in the group
    counts = {f"n{g}": F.shiftright(zero + sizes[g] - d, 1).cast("long") for g, d in enumerate(others)}
    counted = fps.select("fp", *(n.alias(name) for name, n in counts.items()))
    cell = reduce(Column.bitwiseOR, (F.shiftleft(name, 3 * g) for g, name in enumerate(counts)))
    placed = counted.select("fp", *counts, cell.alias("cell"))
    near = []
    for group, (name, size) in enumerate(zip(counts, sizes)):
        step = F.lit(1 << (3 * group))
        near += [F.when(F.col(name) < size, F.col("cell") + step), F.when(F.col(name) > 0, F.col("cell") - step)]
    around = F.explode(F.array("cell", *near)).alias("near")
    return placed.select("fp", around).where("near IS NOT NULL").select("fp", F.col("near").alias("cell"))


def flips(fp: Column) -> Column:
    """A fingerprint and the 64 that differ from it in one bit."""
    steps = [1 << b if b < 63 else -(1 << 63) for b in range(64)]
    return F.array(fp, *(fp.bitwiseXOR(F.lit(s).cast("long")) for s in steps))


def near_links(distinct_fps: DataFrame) -> DataFrame:
    """Links `a`, `b` that connect all fingerprints (`fp`, distinct) at most two bits apart.

    A fingerprint alone in all its cells of the pivot table has no partner and goes.
    The rest are verified exactly: two fingerprints are at most two bits apart if and
    only if some fingerprint is at most one bit from both, and all around one such
    middle are that close to each other. So each middle links its neighbours to the
    smallest of them: whole links for the components, and never all pairs of a group.
    """
    # A fingerprint becomes many rows: as many tasks as a shuffle has, however small the table is.
    tasks = int(distinct_fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = pivot_cells(distinct_fps.repartition(tasks, "fp"))
    shared = cells.groupBy("cell").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi")
    survivors = cells.join(shared.hint("merge"), "cell", "left_semi").select("fp").distinct()
    middles = survivors.select("fp", F.explode(flips(F.col("fp"))).alias("middle"))
    least = (
        middles.groupBy("middle")
        .agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
        .where("lo <> hi")
        .select("middle", "lo")
    )
    return middles.join(least.hint("merge"), "middle").where("fp <> lo").select(F.col("fp").alias("a"), F.col("lo").alias("b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """`id_col`, `fingerprint` (16 hex digits), `component_id` for every row.

    Rows link when their 64-bit fingerprints differ in at most two bits; the component
    is the smallest id reachable, the row's own included. Copies share a fingerprint
    and meet on that alone, so a group of any size is never spread into pairs. Null
    texts are empty; rows with a null id take part, and the component is null only if
    no row of the group has an id; repeated rows stay; an empty table gives an empty
    result; other columns are ignored.
    """
    rows = fingerprints(docs, id_col, text_col, width, seed).withColumn("fp", F.get("fp", F.lit(0)))
    rows = materialize(rows, "fingerprints")
    fps = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    linked = materialize(components(near_links(rows.select("fp").distinct())), "fingerprint-components")
    # Names are shuffled: their files are small enough to broadcast long after their rows are too many for the driver.
    grouped = fps.join(linked.hint("merge"), fps["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    roots = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(roots.hint("merge"), "root").select("fp", "component_id")
    return rows.join(named.hint("merge"), "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def bit_chance(similarity: float) -> float:
    """Chance that a SimHash bit of two shingle sets of this Jaccard similarity differs."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def exact_chance(x: int, y: int, common: int) -> float:
    """Chance that a SimHash bit of sets of x and y shingles differs, `common` of them shared."""

    def chances(n: int) -> list[float]:
        return [math.comb(n, k) / 2**n for k in range(n + 1)]

    total = 0.0
    for k, p in enumerate(chances(common)):
        sets = sum(q for i, q in enumerate(chances(x - common)) if 2 * (k + i) > x)
        other = sum(q for i, q in enumerate(chances(y - common)) if 2 * (k + i) > y)
        total += p * (sets * (1 - other) + other * (1 - sets))
    return total


def worst_chances(similarity: float) -> list[float]:
    """For the size of the smaller of two unequal sets, the largest chance that a bit of theirs differs.

    Both are at least as similar as asked. Sets of few shingles are far from the limit of
    large ones, which is the last entry and stands for SHORT shingles and more.
    """
    worst = []
    for x in range(SHORT):
        sizes = range(x, math.floor(x / similarity + 1e-9) + 1)
        pairs = [(x, y, c) for y in sizes for c in range(1, x + 1) if c < y and c >= similarity * (x + y - c) - 1e-9]
        worst.append(max((exact_chance(*p) for p in pairs), default=0.0))
    return [*worst, bit_chance(similarity)]


def cuts_of(similarity: float, total: int) -> list[int]:
    """Most bits of `total` in which such sets differ, four standard deviations from the mean, by the smaller size."""
    return [int(total * p + 4 * math.sqrt(total * p * (1 - p))) for p in worst_chances(similarity)]


def subset_sizes(count: int, total: int) -> tuple[int, float]:
    """Bits of a subset for so many rows, and the share of subsets with one bit more.

    Unlike rows that agree by chance share cells. Every doubling of the rows takes nine
    eighths of a bit, so that rows in cells of more than three, which grow with the third power of the
    rows a cell, make up for the further subsets that more bits need: they grow about as
    the rows do. Bits are whole, so a share of the subsets stands for the fraction: that
    with which the rows in such cells are as many as with the broken size.
    """
    size = min(float(total), max(LEAST_BITS, 1.125 * math.log2(max(count, 2)) - 1))
    return int(size), (1 - 8 ** (int(size) - size)) * 8 / 7


def subsets_for(chance: float, size: int, total: int, recall: float, longer: float = 0.0) -> int:
    """Subsets of so many of the bits in which rows whose bits differ with this chance agree at least once.

    The number of differing bits is spread around its mean, and the pairs far above it are those that are lost.
    The share `longer` of the subsets has one bit more.
    """
    bits = range(total + 1)
    weight = np.array([math.comb(total, d) * chance**d * (1 - chance) ** (total - d) for d in bits])

    def apart(k: int) -> np.ndarray:
        return 1 - np.array([math.comb(total - d, k) / math.comb(total, k) for d in bits])

    once = apart(size) ** (1 - longer) * apart(size + 1) ** longer if longer else apart(size)
    subsets = 1
    while weight @ once**subsets > 1 - recall:
        subsets = subsets + 1 + subsets // 50
    return subsets


def bit_subsets(count: int, words: int, similarity: float, recall: float) -> tuple[list[list[int]], int]:
    """Random subsets of the bits as masks, and how many of them rows of many shingles need.

    Of so many bits that unlike rows seldom agree in all, and so many subsets that two
    rows of the similarity agree in some with the given chance; rows of few shingles,
    whose bits differ more often, take all the subsets. Subsets of one bit more are
    spread evenly, and never more than their share of the first ones.
    """
    total = 64 * words
    size, longer = subset_sizes(count, total)
    chances = worst_chances(similarity)
    usual, subsets = (subsets_for(p, size, total, recall, longer) for p in (chances[-1], max(chances)))
    drawn = np.random.default_rng(SEED)
    masks = np.zeros((subsets, total), np.uint8)
    for i, mask in enumerate(masks):
        more = int((i + 1) * longer) - int(i * longer)
        mask[drawn.choice(total, size + more, replace=False)] = 1
    return np.packbits(masks, axis=1).view(">i8").astype(np.int64).tolist(), usual


def shared_cells(fps: DataFrame, masks: list[list[int]], words: int, similarity: float, usual: int) -> DataFrame:
    """`cell`, `uid`, `lo`, `hi`, `n`: the rows of wide fingerprints (`uid`, `fp`, `size`) in cells that hold several.

    The references are the fingerprints with one bit set: two rows that are equally far
    from such a reference, and from zero, agree in its bit. With more bits to differ, a
    bound over all references at once discards too little, so rows meet in cells of equal
    distances to subsets of the references. Rows of many shingles take the first `usual`
    of the masks. `lo` and `hi` are the ends of a cell in an order of its own, and `n` its rows.
    """
    # One constant instead of an expression per subset: plans and generated code stay small.
    table = F.from_json(F.lit(json.dumps(masks)), "array<array<bigint>>")
    # A fingerprint becomes many rows: as many tasks as a shuffle has, however small the table is.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.when(F.col("size") <= SHORT / similarity, table).otherwise(F.slice(table, 1, usual)) if usual else table
    rows = fps if usual else fps.where(F.col("size") <= SHORT / similarity)
    each = rows.repartition(tasks, "uid").select("uid", "fp", F.posexplode(own).alias("turn", "mask"))
    parts = [F.get("fp", F.lit(w)).bitwiseAND(F.get("mask", F.lit(w))) for w in range(words)]
    # One exchange by cell serves both the ends and the join.
    rows = each.select("uid", F.xxhash64("turn", *parts).alias("cell")).repartition("cell")
    # The order inside a cell is that of the uids after an exclusive or with the cell's own name.
    place = F.col("uid").bitwiseXOR(F.col("cell"))
    shared = rows.groupBy("cell").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("n"))
    return materialize(rows.join(shared.where("lo <> hi"), "cell"), "shared-cells")


def end_pairs(cells: DataFrame, fps: DataFrame, words: int, cuts: list[int]) -> DataFrame:
    """Pairs `a`, `b` (uids) of a cell's rows with its two ends, with `differ`; at most the cut for their size."""
    ends = F.explode(F.array(*(F.col(c).bitwiseXOR(F.col("cell")) for c in ("lo", "hi")))).alias("b")
    pairs = cells.select(F.col("uid").alias("a"), ends).where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = fps.select(F.col("uid").alias("a"), F.col("fp").alias("fp_a"), F.col("size").alias("size_a"))
    right = fps.select(F.col("uid").alias("b"), F.col("fp").alias("fp_b"), F.col("size").alias("size_b"))
    differ = sum(
        (F.bit_count(F.get("fp_a", F.lit(w)).bitwiseXOR(F.get("fp_b", F.lit(w)))) for w in range(words)), F.lit(0)
    )
    most = F.get(F.array(*map(F.lit, cuts)), F.least("size_a", "size_b", F.lit(len(cuts) - 1)))
    return pairs.join(left, "a").join(right, "b").where(differ <= most).select("a", "b", differ.alias("differ"))


def mixed_cells(cells: DataFrame, known: DataFrame) -> DataFrame:
    """`cell`, `uid`, `n`, `root`: the cells of more than three rows that hold more than one group (`node`, `component`).

    Up to three rows meet through the ends of a cell.
    """
    names = known.select(F.col("node").alias("uid"), "component")
    rows = cells.where("n > 3").select("cell", "uid", "n").join(names, "uid", "left")
    rows = rows.select("cell", "uid", "n", F.coalesce("component", "uid").alias("root"))
    mixed = rows.groupBy("cell").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("cell")
    return rows.join(mixed, "cell", "left_semi")


def _compared(rows: DataFrame, fps: DataFrame, words: int, cuts: list[int], block: int, pairs: bool) -> DataFrame:
    """Near rows of mixed cells that are not in one group yet: their pairs `a`, `b`, `differ`, or just the rows `cell`, `uid`.

    Cells are cut into blocks, and each pair of blocks is one group of bounded size, in
    which every row is compared with every other.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    rows = rows.join(fps.select("uid", "fp", "size"), "uid").withColumn("blocks", blocks)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    member = F.struct((F.col("mine") == low).alias("left"), "uid", "root", "size", "fp").alias("m")
    groups = rows.select("cell", low.alias("low"), high.alias("high"), member).groupBy("cell", "low", "high")
    limits = np.array(cuts)
    groups = groups.agg(F.collect_list("m").alias("m")).select((F.col("low") == F.col("high")).alias("same"), "m", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [np.empty((3 if pairs else 2, 0), np.int64)]
            for same, members, cell in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                *plain, fp = (members.values.field(i) for i in range(5))
                left, uid, root, size = (x.to_numpy(zero_copy_only=False) for x in plain)
                bits = fp.flatten().to_numpy().view(np.uint64).reshape(-1, words)
                x = np.flatnonzero(left)
                y = x if same else np.flatnonzero(~left)
                differ = np.zeros((len(x), len(y)), np.uint16)
                for w in range(words):
                    differ += np.bitwise_count(bits[x, None, w] ^ bits[None, y, w])
                most = limits[np.minimum(np.minimum(size[x, None], size[None, y]), len(limits) - 1)]
                near = (differ <= most) & (root[x, None] != root[None, y])
                if pairs:
                    i, j = np.nonzero(np.triu(near) if same else near)
                    a, b = uid[x[i]], uid[y[j]]
                    found.append(np.stack([np.minimum(a, b), np.maximum(a, b), differ[i, j].astype(np.int64)]))
                else:
                    some = np.concatenate((uid[x[near.any(axis=1)]], uid[y[near.any(axis=0)]]))
                    found.append(np.stack([np.full(len(some), cell), some]))
            columns = [pa.array(c) for c in np.concatenate(found, axis=1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "differ"] if pairs else ["cell", "uid"])

    return groups.mapInArrow(run, "a long, b long, differ long" if pairs else "cell long, uid long").distinct()


def crowded_rows(rows: DataFrame, fps: DataFrame, words: int, cuts: list[int], block: int = BLOCK) -> DataFrame:
    """The rows of mixed cells that have some near row of another group in their cell."""
    return rows.join(_compared(rows, fps, words, cuts, block, False), ["cell", "uid"], "left_semi")


def crowded_pairs(rows: DataFrame, fps: DataFrame, words: int, cuts: list[int], block: int = BLOCK) -> DataFrame:
    """Pairs `a`, `b`, `differ` of the rows of mixed cells that are not in one group yet."""
    return _compared(rows, fps, words, cuts, block, True)


def shingle_sets(texts: DataFrame, width: int, seed: int) -> DataFrame:
    """`uid`, `shingles` (hashes of the distinct runs of `width` words) of rows `uid`, `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sets = [np.unique(shingle_hashes(t.as_py(), width, seed)).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["uid", "shingles"]
            )

    return texts.select("uid", "text").mapInArrow(run, "uid long, shingles array<long>")


def texts_of(docs: DataFrame, rows: DataFrame, fps: DataFrame, wanted: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """`uid`, `text`: one of the texts of each wanted set of shingles (`uid`)."""
    first = F.min(F.struct(F.col(id_col).alias("id"), "h1", "h2")).alias("x")
    places = rows.join(fps.join(wanted, "uid", "left_semi"), ["fp", "s"]).groupBy("uid").agg(first)
    places = materialize(places.select("uid", "x.id", "x.h1", "x.h2"), "doubtful-documents")
    if places.count() <= BROADCAST_PLACES:
        places = F.broadcast(places)
    given = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    there = (
        F.col("doc").eqNullSafe(F.col("id"))
        & (F.xxhash64("text") == F.col("h1"))
        & (F.xxhash64(F.lit(1), "text") == F.col("h2"))
    )
    return given.join(places, there).select("uid", "text")


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs whose shingles have the Jaccard similarity; pairs of too unequal sizes go first."""
    for end in "ab":
        pairs = pairs.join(sets.select(F.col("uid").alias(end), F.size("shingles").alias(f"n_{end}")), end)
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    pairs = pairs.where(least >= similarity * most - 1e-6).select("a", "b")
    left = sets.select(F.col("uid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("uid").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    settled = pairs.join(left, "a").join(right, "b").where(common >= similarity * (F.size("x") + F.size("y") - common))
    return settled.select("a", "b")


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those of the pairs whose ends are not in one group (`node`, `component`)."""
    for end in "ab":
        found = known.select(F.col("node").alias(end), F.col("component").alias(f"group_{end}"))
        pairs = pairs.join(found, end, "left")
    return pairs.where(F.coalesce("group_a", "a") != F.coalesce("group_b", "b")).drop("group_a", "group_b")


def widened(sets: DataFrame, words: int) -> DataFrame:
    """`uid`, `fp` of so many words, `size` from the shingles of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            hashes = [np.asarray(x.values).view(np.uint64) for x in batch.column(1)]
            wide = np.array([_folded(h, words) for h in hashes], np.uint64).reshape(-1).view(np.int64)
            offsets = pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * words)
            size = pa.array([len(h) for h in hashes], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(wide)), size], names=["uid", "fp", "size"])

    return sets.select("uid", "shingles").mapInArrow(run, "uid long, fp array<long>, size int")


def merged(known: DataFrame, links: DataFrame) -> DataFrame:
    """The groups (`node`, `component`) after further links: only the groups that these join are followed."""
    for end in "ab":
        found = known.select(F.col("node").alias(end), F.col("component").alias(f"group_{end}"))
        links = links.join(found, end, "left")
    ends = [F.coalesce(f"group_{end}", end).alias(end) for end in "ab"]
    new = materialize(components(links.select(*ends)), "joined-groups")
    moved = new.select(F.col("node").alias("component"), F.col("component").alias("root"))
    older = known.join(moved, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return older.union(new.join(known, "node", "left_anti").select("node", "component"))


class _Settled:
    """What is known while waves of cells bring pairs: groups, pairs that were compared, shingles that were read."""

    def __init__(self, docs: DataFrame, rows: DataFrame, fps: DataFrame, text_col: str, id_col: str, width: int, similarity: float, seed: int):
        spark = docs.sparkSession
        self.find = lambda wanted: shingle_sets(texts_of(docs, rows, fps, wanted, text_col, id_col), width, seed)
        self.similarity = similarity
        self.known = spark.createDataFrame([], "node long, component long")
        self.seen = spark.createDataFrame([], "a long, b long")
        self.sets = spark.createDataFrame([], "uid long, shingles array<long>")

    def read(self, uids: DataFrame) -> None:
        """Have the shingles of these rows."""
        wanted = materialize(uids.distinct().join(self.sets, "uid", "left_anti"), "wanted")
        if not wanted.isEmpty():
            self.sets = self.sets.union(materialize(self.find(wanted).dropDuplicates(["uid"]), "shingles"))
        discard(wanted)

    def fresh(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are neither compared yet nor in one group; staged."""
        return materialize(_apart(pairs, self.known).join(self.seen, ["a", "b"], "left_anti"), "near-fingerprints")

    def settle(self, pairs: DataFrame) -> None:
        """Compare the shingles of these pairs."""
        self.read(pairs.select(F.explode(F.array("a", "b")).alias("uid")))
        self.seen = self.seen.union(pairs.select("a", "b"))
        found = materialize(alike(pairs.select("a", "b"), self.sets, self.similarity), "near-links")
        if not found.isEmpty():
            self.known = materialize(merged(self.known, found), "near-groups")
        discard(found)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files stay until the driver has let go of the plans that wrote them: let it do so now."""
    gc.collect()
    spark._jvm.System.gc()


def near_groups(
    docs: DataFrame, rows: DataFrame, fps: DataFrame, text_col: str, id_col: str, width: int, similarity: float,
    words: int, seed: int, recall: float = RECALL, wave: int = WAVE,
) -> DataFrame:
    """`node`, `component` of the sets of shingles (uids, each with its fingerprint) with a near-copy.

    Every link is settled by the Jaccard similarity of the shingles. The subsets of the
    references come in waves, so that the cells of one wave alone are held at a time. In
    a wave rows are compared with the ends of their cells first: a few pairs of each row are
    settled, then those whose groups are not joined by them, so a large group of copies
    is not spelled out. What is apart still in a cell of more than three rows is compared
    whole; the rows that are near another there once more, by fingerprints of many more
    bits, so that few but true links leave a task also where many texts share a template.

    Fingerprints bring a pair of just the similarity together with a chance only (`recall`). So
    the pairs that still stand in two groups and share one of their rarest shingles come
    last: by `prefixes` no pair of the similarity is without one, and none is left out.
    """
    total = 64 * words
    cuts, wide_cuts = cuts_of(similarity, total), cuts_of(similarity, 64 * WIDE)
    likely = int(total * bit_chance(similarity))
    masks, usual = bit_subsets(fps.count(), words, similarity, recall)
    known = _Settled(docs, rows, fps, text_col, id_col, width, similarity, seed)
    if fps.where(F.col("size") <= SHORT / similarity).isEmpty():
        masks = masks[:usual]
    begin = 0
    while begin < len(masks):
        # Waves end where the rows of many shingles have had enough; the rest is for the few others.
        end = min(begin + wave, usual) if begin < usual else min(begin + 4 * wave, len(masks))
        cells = shared_cells(fps, masks[begin:end], words, similarity, end - begin if begin < usual else 0)
        pairs = known.fresh(end_pairs(cells, fps, words, cuts))
        if not pairs.isEmpty():
            both = pairs.union(pairs.select("b", "a", "differ"))
            drawn = [F.struct(F.xxhash64(F.lit(k), "a", "b").alias("x"), "b") for k in range(PARTNERS)]
            picked = [F.min(F.when(F.col("differ") <= likely, x))["b"] for x in drawn]
            nearest = F.min(F.struct("differ", F.xxhash64("a", "b").alias("x"), "b"))["b"]
            some = both.groupBy("a").agg(F.array(*picked, nearest).alias("some")).select("a", F.explode("some").alias("b"))
            some = some.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            first = materialize(some.distinct(), "first-pairs")
            known.settle(first)
            if first.count() < pairs.count():
                doubtful = known.fresh(pairs)
                if not doubtful.isEmpty():
                    known.settle(doubtful)
        discard(pairs)
        mixed = materialize(mixed_cells(cells, known.known), "mixed-cells")
        crowded = materialize(crowded_rows(mixed, fps, words, cuts), "crowded-cells")
        discard(mixed)
        if not crowded.isEmpty():
            uids = crowded.select("uid")
            known.read(uids)
            wide = materialize(widened(known.sets.join(uids.distinct(), "uid", "left_semi"), WIDE), "wide-fingerprints")
            rest = known.fresh(crowded_pairs(crowded, wide, WIDE, wide_cuts))
            if not rest.isEmpty():
                known.settle(rest)
            discard(wide)
        discard(crowded)
        discard(cells)
        free_shuffles(docs.sparkSession)
        begin = end
    rest = known.fresh(missed_pairs(docs, rows, fps, known.known, text_col, width, similarity, seed))
    if not rest.isEmpty():
        known.settle(rest)
    discard(rest)
    return known.known


def missed_pairs(
    docs: DataFrame, rows: DataFrame, fps: DataFrame, known: DataFrame, text_col: str, width: int, similarity: float, seed: int
) -> DataFrame:
    """Pairs `a`, `b` (uids) of different groups (`node`, `component`): all that may have the similarity."""
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    first = shared_first(texts, lambda t: np.unique(shingle_hashes(t, width, seed)), set_key, total, similarity)
    first = materialize(first, "rare-shingles")
    names = known.select(F.col("node").alias("uid"), "component")
    named = first.join(fps.select("s", "uid"), "s").join(names, "uid", "left")
    named = named.select("uid", F.coalesce("component", "uid").alias("root"), first["size"], "at", "member")
    return possible_pairs(named, similarity)


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    similarity: float = 0.8,
    words: int = 4,
    seed: int = SEED,
) -> DataFrame:
    """The documents without near-copies: of each group one row stays, that with the smallest id.

    Rows link when the Jaccard similarity of their distinct runs of `width` words is at
    least `similarity`; wide fingerprints bring most pairs together, rare shingles all
    others, and the shingles settle each. Of rows with that id the one with the smallest
    text hash stays, and one of rows that repeat both. Rows with a null id stay only
    where a group has nothing else. Texts without words are copies of each other. All
    columns of `docs` are kept; an empty table gives an empty one.
    """
    rows = fingerprints(docs, id_col, text_col, width, seed, words, distinct=True, keyed=True)
    rows = materialize(rows, "fingerprints")
    # Unlike sets may have one fingerprint: each is settled on its own.
    fps = rows.groupBy("fp", "s").agg(F.min("n_shingles").alias("size")).withColumn("uid", F.monotonically_increasing_id())
    fps = materialize(fps, "distinct-fingerprints")
    linked = near_groups(docs, rows, fps, text_col, id_col, width, similarity, words, seed)
    roots = fps.join(linked, fps["uid"] == linked["node"], "left").select("fp", "s", F.coalesce("component", "uid").alias("root"))
    counted = rows.groupBy("fp", "s", id_col, "h1", "h2").agg(F.count("*").alias("n"))
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "h1", "h2", "n")
    first = counted.join(roots, ["fp", "s"]).groupBy("root").agg(F.min(order).alias("first"))
    kept = first.select(*(F.col(f"first.{c}").alias(f"_kept_{c}") for c in ("id", "h1", "h2", "n")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = (
        F.col(id_col).eqNullSafe(F.col("_kept_id"))
        & (F.xxhash64(text) == F.col("_kept_h1"))
        & (F.xxhash64(F.lit(1), text) == F.col("_kept_h2"))
    )
    kept = materialize(kept, "kept-documents")
    discard(rows)
    discard(fps)
    single = docs.join(kept.where("_kept_n = 1"), same, "left_semi")
    again = docs.join(kept.where("_kept_n > 1"), same).dropDuplicates(["_kept_id", "_kept_h1", "_kept_h2"])
    again = again.select(docs.columns)
    return single.union(again)
