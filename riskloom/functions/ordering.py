"""Running totals, carried values and exact hash-order samples without a global window."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.exprs import col
from riskloom.session import bounded_rows, broadcastable, materialize

RANGE_BUCKETS = 512
SINGLE_WINDOW_ROWS = 200_000  # one task may order this many reduced rows
HASH_PREFIX = 3  # hex digits per round: 4096 equal ranges of the md5 order
VALUE_CELLS = 1024  # equal cells per round between the ends of an interval of numbers
MOST_CLASSES = 1_000_000  # class sizes that the driver may hold
GROUP_ROWS = 20_000  # one task may order this many rows of a group


def with_range_bucket(df: DataFrame, key: str, buckets: int = RANGE_BUCKETS) -> DataFrame:
    """Add `_bucket`, a value range of the numeric column `key` (nulls last).

    The boundaries come from a mergeable sketch and are literals, so a recomputed
    task places its rows exactly as the first attempt did.
    """
    steps = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(col(key), steps, 10 * buckets)).first()
    ends = sorted({float(x) for x in row[0] or []})
    splits = [-float("inf"), *ends, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="_key", outputCol="_range", handleInvalid="keep")
    placed = bucketizer.transform(df.withColumn("_key", col(key).cast("double")))
    return placed.withColumn("_bucket", F.col("_range").cast("int")).drop("_key", "_range")


def running_sums(
    df: DataFrame,
    key: str,
    sums: Sequence[str],
    descending: bool = False,
    buckets: int = RANGE_BUCKETS,
    single_rows: int = SINGLE_WINDOW_ROWS,
    staged: bool = False,
) -> DataFrame:
    """Add `cum_<c>`: the sum of `c` over all rows up to and including `key`.

    `df` has one row per `key`, reduced from a larger table, and is staged (unless it
    is already) so that the reduction runs once. Few keys are summed by one window.
    Many are cut into value ranges, each summed by its own task, and the totals of
    the ranges before it (at most `buckets` rows) are added.
    """
    def order(c):
        return F.desc(c) if descending else F.asc(c)

    df = df if staged else materialize(df, "ordered")
    upto = (Window.unboundedPreceding, Window.currentRow)
    if df.count() <= single_rows:
        whole = Window.partitionBy().orderBy(order(key)).rowsBetween(*upto)
        return df.withColumns({f"cum_{c}": F.sum(col(c)).over(whole) for c in sums})
    placed = with_range_bucket(df, key, buckets)
    totals = placed.groupBy("_bucket").agg(*[F.sum(col(c)).alias(f"t_{c}") for c in sums])
    before = Window.partitionBy().orderBy(order("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_bucket",
        *[F.coalesce(F.sum(col(f"t_{c}")).over(before), F.lit(0)).alias(f"s_{c}") for c in sums],
    )
    within = Window.partitionBy("_bucket").orderBy(order(key)).rowsBetween(*upto)
    return (
        placed.join(broadcastable(starts, buckets + 2), "_bucket")
        .withColumns({f"cum_{c}": F.sum(col(c)).over(within) + col(f"s_{c}") for c in sums})
        .drop("_bucket", *[f"s_{c}" for c in sums])
    )


def carry_values(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    buckets: int = RANGE_BUCKETS,
    single_rows: int = SINGLE_WINDOW_ROWS,
) -> DataFrame:
    """Forward fill, then backward fill, `columns` along the numeric `key`.

    `df` has one row per `key` and is staged. With many keys, gaps are filled inside
    each value range first; what stays open at a range's edge takes the nearest value
    of the ranges around it.
    """
    df = materialize(df, "ordered")
    past_rows = (Window.unboundedPreceding, Window.currentRow)
    next_rows = (Window.currentRow, Window.unboundedFollowing)
    if df.count() <= single_rows:
        whole = Window.partitionBy().orderBy(key)
        filled = {
            c: F.coalesce(
                F.last(col(c), True).over(whole.rowsBetween(*past_rows)),
                F.first(col(c), True).over(whole.rowsBetween(*next_rows)),
            )
            for c in columns
        }
        return df.select(*[filled.get(c, col(c)).alias(c) for c in df.columns])
    placed = with_range_bucket(df, key, buckets)
    inside = Window.partitionBy("_bucket").orderBy(key)
    edges = placed.groupBy("_bucket").agg(
        *[F.max_by(col(c), F.when(col(c).isNotNull(), col(key))).alias(f"last_{c}") for c in columns],
        *[F.min_by(col(c), F.when(col(c).isNotNull(), col(key))).alias(f"first_{c}") for c in columns],
    )
    ranges = Window.partitionBy().orderBy("_bucket")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    after = ranges.rowsBetween(1, Window.unboundedFollowing)
    around = edges.select(
        "_bucket",
        *[F.last(col(f"last_{c}"), True).over(before).alias(f"p_{c}") for c in columns],
        *[F.first(col(f"first_{c}"), True).over(after).alias(f"f_{c}") for c in columns],
    )
    joined = placed.join(broadcastable(around, buckets + 2), "_bucket")
    filled = {
        c: F.coalesce(
            F.last(col(c), True).over(inside.rowsBetween(*past_rows)),
            col(f"p_{c}"),
            F.first(col(c), True).over(inside.rowsBetween(*next_rows)),
            col(f"f_{c}"),
        )
        for c in columns
    }
    return joined.select(*[filled.get(c, col(c)).alias(c) for c in df.columns])


def hash_key(seed: int, *keys: Column) -> Column:
    """A reproducible random-looking order over rows with unique keys."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def hash_cuts(
    df: DataFrame,
    hash_col: str,
    ranks: dict,
    by: Column | None = None,
    single_rows: int = SINGLE_WINDOW_ROWS,
) -> dict[tuple, str | None]:
    """The hash at each wanted 1-based rank, per group: {(group, rank): hash}.

    `ranks` maps a group value to its ranks. Counts per leading digits of the hash
    (4096 at a time, combined before the shuffle) find the digits that hold a rank;
    the search goes on below them until few rows are left, and only these are
    ordered. The sample is then the plain filter `hash <= cut`, and the table itself
    is never shuffled.
    """
    group = by if by is not None else F.lit(0)
    rows = df.select(group.alias("g"), F.col(hash_col).alias("h"))
    cuts = {(g, r): None for g, rs in ranks.items() for r in rs}
    wanted = [w for w in cuts if w[1] > 0]
    if not wanted:
        return cuts
    spans = {w: ("", w[1], None) for w in wanted}
    width = 0
    while any(n is None or n > single_rows for _, _, n in spans.values()) and width < 30:
        spans = _narrowed(rows, spans, width)
        width += HASH_PREFIX
    cells = [
        F.when(_held(w[0], spans[w][0]), F.struct(F.lit(i).alias("k"), F.col("h")))
        for i, w in enumerate(wanted)
    ]
    lines = rows.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.k", "c.h")
    ranked = lines.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("h")))
    found = ranked.agg(
        *[
            F.min(F.when((F.col("k") == i) & (F.col("r") == spans[w][1]), F.col("h"))).alias(f"h{i}")
            for i, w in enumerate(wanted)
        ]
    ).first()
    return cuts | {w: found[f"h{i}"] for i, w in enumerate(wanted)}


def _held(group, prefix: str) -> Column:
    return F.col("g").eqNullSafe(F.lit(group)) & F.col("h").startswith(prefix)


def _narrowed(rows: DataFrame, spans: dict, width: int) -> dict:
    """Each span's next digits, the rank left among them, and how many rows they hold."""
    if width:
        places = dict.fromkeys((w[0], prefix) for w, (prefix, _, _) in spans.items())
        rows = rows.where(reduce(lambda a, b: a | b, [_held(g, p) for g, p in places]))
    counts = rows.groupBy("g", F.substring("h", 1, width + HASH_PREFIX).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    parent = F.substring("p", 1, width)
    ladder = counts.withColumn(
        "upto", F.sum("n").over(Window.partitionBy("g", parent).orderBy("p"))
    )
    picks = [
        F.min(
            F.when(
                F.col("g").eqNullSafe(F.lit(w[0])) & (parent == prefix) & (F.col("upto") >= rank),
                F.struct("p", (F.col("upto") - F.col("n")).alias("before"), "n"),
            )
        ).alias(f"c{i}")
        for i, (w, (prefix, rank, _)) in enumerate(spans.items())
    ]
    row = ladder.agg(*picks).first()
    out = {}
    for i, (w, (_, rank, _)) in enumerate(spans.items()):
        if row[f"c{i}"] is None:
            raise ValueError(f"group {w[0]!r} has fewer than {w[1]} rows")
        p, before, n = row[f"c{i}"]
        out[w] = (p, rank - before, n)
    return out


def hash_cell(key: Column, low: Column, high: Column, depth: int) -> Column:
    """The leading digits of an md5, three more each round."""
    return F.substring(key, 1, HASH_PREFIX * depth)


def value_cell(key: Column, low: Column, high: Column, depth: int) -> Column:
    """One of `VALUE_CELLS` equal cells between two numbers; it never falls as the number grows."""
    return F.floor(F.least((key - low) / ((high - low) / VALUE_CELLS), F.lit(VALUE_CELLS - 1.0)))


def values_at_ranks(
    df: DataFrame,
    group: Column,
    key: Column,
    wanted: DataFrame,
    cell: Callable[[Column, Column, Column, int], Column],
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The key at each wanted 1-based rank, for any number of groups: rows `_g`, `_k`, `_at`.

    `wanted` has a group `_g`, a number `_k` of the place and its `_rank`; places beyond
    a group's non-null keys are left out. Rows are counted per cell of their group's
    key range, combined before the shuffle, and only the cell that holds a rank is cut
    on, until its keys are all equal or few. Then the distinct keys of that cell
    are put in order, so neither a group nor a hot value is ever gathered.
    The result is staged; `df` is read several times.
    """
    rows = df.select(group.alias("_g"), key.alias("_v")).where("_v IS NOT NULL")
    ends = rows.groupBy("_g").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("_v").alias("_n"))
    asked = wanted.where("_rank > 0").select(F.col("_g").alias("_of"), "_k", "_rank")
    spans = materialize(
        asked.join(ends, F.col("_of").eqNullSafe(F.col("_g"))).where("_rank <= _n").drop("_of"), "spans"
    )
    found, depth = [spans.where("_lo = _hi").select("_g", "_k", F.col("_lo").alias("_at"))], 0
    while True:
        wide = spans.where((F.col("_lo") < F.col("_hi")) & (F.col("_n") > group_rows))
        if wide.isEmpty():
            break
        depth += 1
        inside = _in_spans(rows, wide)
        ladder = inside.groupBy("_g", "_lo", cell(F.col("_v"), F.col("_lo"), F.col("_hi"), depth).alias("_cell")).agg(
            F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("_v").alias("_in")
        )
        upto = F.sum("_in").over(Window.partitionBy("_g", "_lo").orderBy("_cell"))
        narrowed = _holding(wide, ladder.withColumn("_upto", upto)).select(
            "_g", "_k", (F.col("_rank") - F.col("_upto") + F.col("_in")).alias("_rank"),
            F.col("_low").alias("_lo"), F.col("_high").alias("_hi"), F.col("_in").alias("_n"),
        )
        few = spans.where((F.col("_lo") < F.col("_hi")) & (F.col("_n") <= group_rows))
        spans = materialize(narrowed.unionByName(few.select(*narrowed.columns)), "spans")
        found.append(spans.where("_lo = _hi").select("_g", "_k", F.col("_lo").alias("_at")))
    last = spans.where("_lo < _hi")
    counts = _in_spans(rows, last).groupBy("_g", "_lo", "_v").agg(F.count(F.lit(1)).alias("_in"))
    upto = F.sum("_in").over(Window.partitionBy("_g", "_lo").orderBy("_v"))
    found.append(_holding(last, counts.withColumn("_upto", upto)).select("_g", "_k", F.col("_v").alias("_at")))
    return materialize(reduce(DataFrame.unionByName, found), "cuts")


def _in_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows of each interval; the intervals of one group do not overlap."""
    places = spans.select(F.col("_g").alias("_of"), "_lo", "_hi").distinct()
    within = F.col("_g").eqNullSafe(F.col("_of")) & F.col("_v").between(F.col("_lo"), F.col("_hi"))
    return rows.join(broadcastable(places), within).drop("_of")


def _holding(spans: DataFrame, ladder: DataFrame) -> DataFrame:
    """Each span with the step of its ladder on which its rank falls."""
    steps = ladder.withColumnsRenamed({"_g": "_of", "_lo": "_from"})
    held = (
        F.col("_g").eqNullSafe(F.col("_of")) & (F.col("_lo") == F.col("_from"))
        & F.col("_rank").between(F.col("_upto") - F.col("_in") + 1, F.col("_upto"))
    )
    return spans.join(steps, held)


def attach_cuts(df: DataFrame, by: Column, hash_col: str, cuts: DataFrame) -> DataFrame:
    """Add `_cuts`, the hashes that `values_at_ranks` found for the row's group, in order of `_k`.

    Up to the size of a broadcast the table is not moved. Beyond it rows and cuts meet
    on the group and the first digit of the hash, so a hot group is not one key.
    """
    per_group = cuts.groupBy(F.col("_g").alias("_of")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_k", "_at"))), lambda c: c["_at"]).alias("_cuts")
    )
    bounded = broadcastable(per_group)
    if bounded is not per_group:
        return df.join(bounded, by.eqNullSafe(F.col("_of")), "left").drop("_of")
    digits = F.explode(F.array(*[F.lit(d) for d in "0123456789abcdef"]))
    dealt = per_group.withColumn("_digit", digits)
    meet = by.eqNullSafe(F.col("_of")) & (F.substring(hash_col, 1, 1) == F.col("_digit"))
    return df.join(dealt, meet, "left").drop("_of", "_digit")


def group_sizes(df: DataFrame, by: str, max_groups: int = MOST_CLASSES) -> dict:
    """Rows per class, in class order: one number per class. More than `max_groups` are refused by an error."""
    counts = df.groupBy(col(by).alias("g")).count()
    rows = bounded_rows(counts, max_groups)
    if rows is None:
        raise ValueError(f"'{by}' has more than {max_groups} values: not a class column")
    return dict(sorted(((r["g"], r["count"]) for r in rows), key=lambda t: (t[0] is None, str(t[0]))))

