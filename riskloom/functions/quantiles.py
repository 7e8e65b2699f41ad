"""Exact quantiles of many columns, without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.exprs import col, long_values

# Above this many values a column is narrowed to a short interval before it is ranked.
RANK_LIMIT = 1_000_000
SKETCH_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    exprs: Mapping[str, Column],
    probs: Sequence[float],
    rank_limit: int = RANK_LIMIT,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each expression, nulls skipped.

    Columns of at most `rank_limit` values are answered by one `percentile`
    aggregate, each by its own reducer. For larger ones see `_order_statistics`.
    Only interval ends, counts and the answers reach the driver.
    """
    base = df.select(*[e.cast("double").alias(a) for a, e in exprs.items()])
    sizes = base.agg(*[F.count(col(a)).alias(a) for a in exprs]).first().asDict()
    out: dict[str, list[float | None]] = {a: [None] * len(probs) for a in exprs}
    small = [a for a in exprs if 0 < sizes[a] <= rank_limit]
    if small:
        found = (
            long_values(base, small)
            .where(F.col("value").isNotNull())
            .groupBy("column")
            .agg(F.percentile("value", F.array(*map(F.lit, probs))).alias("at"))
        )
        out.update({r["column"]: list(r["at"]) for r in found.collect()})
    large = [a for a in exprs if sizes[a] > rank_limit]
    if large:
        places = {(a, p): p * (sizes[a] - 1) for a in large for p in probs}
        wanted = {
            (a, r) for (a, _), h in places.items() for r in {math.floor(h), math.ceil(h)}
        }
        values = _order_statistics(base, wanted, sizes, rank_limit, accuracy)
        for a in large:
            out[a] = [_interpolate(values, a, places[a, p]) for p in probs]
    return out


def _interpolate(values, name, place):
    low, high = values[name, math.floor(place)], values[name, math.ceil(place)]
    return low + (place - math.floor(place)) * (high - low)


def _within(v: Column, lo, hi) -> Column:
    """Inside the open interval; None is an open end."""
    inside = v.isNotNull()
    if lo is not None:
        inside &= v > lo
    if hi is not None:
        inside &= v < hi
    return inside


def _order_statistics(base, wanted, sizes, rank_limit, accuracy):
    """The values at the wanted (column, rank) places, exactly.

    Each round asks a mergeable sketch for two values around every open rank and
    counts, in one scan, how many rows lie below, on and between them. A rank that
    falls on one of the two values is answered, however many rows share that value;
    otherwise the search goes on strictly between (or outside) them with a few
    ten-thousandths of the rows, until they are few enough to be ranked.
    """
    found: dict[tuple[str, int], float] = {}
    spans = {k: (None, None, 0, sizes[k[0]]) for k in wanted}
    while True:
        wide = [k for k in spans if k not in found and spans[k][3] > rank_limit]
        if not wide:
            break
        guesses = _sketch(base, wide, spans, accuracy)
        counts = _count(base, wide, guesses, spans)
        for k in wide:
            (a, b), (lo, hi, below, inside) = guesses[k], spans[k]
            under_a, on_a, under_b, on_b = counts[k]
            rank = k[1] - below
            if under_a <= rank < under_a + on_a:
                found[k] = a
            elif under_b <= rank < under_b + on_b:
                found[k] = b
            elif rank < under_a:
                spans[k] = (lo, a, below, under_a)
            elif rank < under_b:
                spans[k] = (a, b, below + under_a + on_a, under_b - under_a - on_a)
            else:
                taken = under_b + on_b
                spans[k] = (b, hi, below + taken, inside - taken)
    rest = [k for k in wanted if k not in found]
    if rest:
        found.update(_rank(base, rest, spans))
    return found


def _sketch(base, keys, spans, accuracy):
    """Two values around each rank; all ranks of a column's interval share one sketch."""
    margin = 3.0 / accuracy
    intervals: dict[tuple, list] = {}
    for k in keys:
        intervals.setdefault((k[0], *spans[k]), []).append(k)
    asks = []
    for i, ((c, lo, hi, below, inside), ranks) in enumerate(intervals.items()):
        v = col(c)
        places = [(k[1] - below) / max(inside - 1, 1) for k in ranks]
        ends = [F.lit(end) for at in places for end in (max(at - margin, 0.0), min(at + margin, 1.0))]
        asks.append(
            F.percentile_approx(F.when(_within(v, lo, hi), v), F.array(*ends), accuracy).alias(f"g{i}")
        )
    row = base.agg(*asks).first()
    return {
        k: (row[f"g{i}"][2 * j], row[f"g{i}"][2 * j + 1])
        for i, ranks in enumerate(intervals.values())
        for j, k in enumerate(ranks)
    }


def _count(base, keys, guesses, spans):
    asks = []
    for i, k in enumerate(keys):
        v, (a, b) = col(k[0]), guesses[k]
        lo, hi = spans[k][:2]
        inside = _within(v, lo, hi)
        asks += [
            F.count_if(inside & (v < a)).alias(f"ua{i}"),
            F.count_if(v == a).alias(f"oa{i}"),
            F.count_if(inside & (v < b)).alias(f"ub{i}"),
            F.count_if(v == b).alias(f"ob{i}"),
        ]
    row = base.agg(*asks).first()
    return {
        k: (row[f"ua{i}"], row[f"oa{i}"], row[f"ub{i}"], row[f"ob{i}"])
        for i, k in enumerate(keys)
    }


def _rank(base, keys, spans):
    """Rank the distinct values left in each span; every span is short by now."""
    cells = []
    for i, k in enumerate(keys):
        v = col(k[0])
        cells.append(F.when(_within(v, *spans[k][:2]), F.struct(F.lit(i).alias("k"), v.alias("v"))))
    upto = F.sum("count").over(Window.partitionBy("k").orderBy("v"))
    seen = (
        base.select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
        .groupBy("c.k", "c.v")
        .count()
        .withColumn("upto", upto)
    )
    picks = [
        F.min(
            F.when((F.col("k") == i) & (F.col("upto") > k[1] - spans[k][2]), F.col("v"))
        ).alias(f"v{i}")
        for i, k in enumerate(keys)
    ]
    row = seen.agg(*picks).first()
    return {k: row[f"v{i}"] for i, k in enumerate(keys)}
