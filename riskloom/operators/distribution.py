"""Distribution reports: descriptions, histograms, box plots, densities, normality."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.exprs import col, kolmogorov_p, long_values, normal_cdf, not_nan, per_column
from riskloom.functions.ordering import value_cell, values_at_ranks
from riskloom.functions.quantiles import exact_quantiles
from riskloom.operators.cleaning import iqr_bounds
from riskloom.session import bounded_rows, broadcastable

KDE_POINTS = 1000
# Up to so many classes are described in one aggregate; more are grouped.
LITERAL_CLASSES = 200
# Curves that one task adds up at a time, and values that meet a grid at a time.
KDE_CURVES, KDE_VALUES = 256, 256
# Cells of a bandwidth that a density works on unless it is asked to be exact.
KDE_CELLS = 64
# Rows that a value range of the normality test aims at, and the most ranges of a column.
KS_RANGE_ROWS, KS_RANGES = 1_000_000, 10_000


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles and max."""
    names = list(columns or S.numeric_columns(df))
    quartiles = exact_quantiles(df, {c: col(c) for c in names}, [0.25, 0.5, 0.75])
    basics = per_column(
        df,
        names,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(c).cast("double"),
            "max": lambda c: F.max(c).cast("double"),
        },
    )
    rows = [(c, *quartiles[c]) for c in names]
    table = df.sparkSession.createDataFrame(rows, "column string, q25 double, q50 double, q75 double")
    return basics.join(F.broadcast(table), "column")


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: count, distinct values, most frequent value and its count."""
    names = list(columns or S.text_columns(df))
    per_value = (
        long_values(df, names)
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = F.min(F.struct((-F.col("n")).alias("minus"), F.col("value")))
    return (
        per_value.groupBy("column")
        .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("top"))
        .select("column", "count", "unique", F.col("top.value").alias("top"),
                (-F.col("top.minus")).alias("freq"))
    )


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over the column's range; the last bin is closed."""
    c = col(column).cast("double")
    ends = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    values = df.select(c.alias("v"), lo.alias("lo"), hi.alias("hi")).where(c.isNotNull())
    width = (F.col("hi") - F.col("lo")) / bins
    bucket = F.when(width > 0, F.floor((F.col("v") - F.col("lo")) / width)).otherwise(F.lit(0))
    return (
        values.select(F.least(bucket, F.lit(bins - 1)).cast("int").alias("bin"), "lo", "hi")
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("left_edge"),
            (F.col("lo") + (F.col("bin") + 1) * width).alias("right_edge"),
            "n",
        )
    )


def boxplot_stats(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 IQR, and outliers, per class."""
    v = col(column).cast("double")
    classes = [None]
    if by:
        present = df.select(col(by).alias("k")).where("k IS NOT NULL").distinct()
        found = bounded_rows(present, LITERAL_CLASSES)
        if found is None:
            return _grouped_boxplots(df, v, by)
        classes = sorted((r["k"] for r in found), key=str)

    def masked(k):
        return F.when(col(by) == k, v) if by else v

    base = df.select(*[masked(k).alias(f"c{i}") for i, k in enumerate(classes)])
    names = [f"c{i}" for i in range(len(classes))]
    quartiles = exact_quantiles(base, {n: col(n) for n in names}, [0.25, 0.5, 0.75])
    filled = [n for n in names if quartiles[n][0] is not None]
    aggregates = []
    for n in filled:
        q1, q2, q3 = quartiles[n]
        lower, upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        c = col(n)
        within = c.between(lower, upper)
        group = str(classes[names.index(n)]) if by else "all"
        aggregates.append(
            F.struct(
                F.lit(group).alias("group"),
                F.lit(q1).alias("q1"),
                F.lit(q2).alias("median"),
                F.lit(q3).alias("q3"),
                F.min(F.when(within, c)).alias("whisker_low"),
                F.max(F.when(within, c)).alias("whisker_high"),
                F.count_if(c.isNotNull() & ~within).alias("n_outliers"),
            ).alias(n)
        )
    if not aggregates:
        return df.sparkSession.createDataFrame(
            [],
            "group string, q1 double, median double, q3 double, whisker_low double, "
            "whisker_high double, n_outliers bigint",
        )
    return base.agg(*aggregates).select(F.inline(F.array(*[col(n) for n in filled])))


def _grouped_boxplots(df: DataFrame, v, by: str) -> DataFrame:
    """Box plots of many classes: the ranks around each quartile are found from counts, then one more pass."""
    rows = df.select(col(by).alias("k"), v.alias("v")).where("k IS NOT NULL AND v IS NOT NULL")
    sizes = rows.groupBy(F.col("k").alias("_g")).agg(F.count("v").alias("n"))
    place = (F.col("n") - 1) * (F.col("_q") + 1) / 4
    places = sizes.withColumn("_q", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn("_place", place)
    low = F.floor("_place")
    wanted = places.select("_g", F.explode(F.array(
        F.struct((2 * F.col("_q")).alias("_k"), (low + 1).alias("_rank")),
        F.struct((2 * F.col("_q") + 1).alias("_k"), (F.ceil("_place") + 1).alias("_rank")),
    )).alias("w")).select("_g", "w.*")
    found = values_at_ranks(rows, F.col("k"), F.col("v"), wanted, value_cell)
    ends = found.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_at"))).alias("at"))
    met = ends.join(sizes, "_g")

    def quartile(i):
        part = (F.col("n") - 1) * (i + 1) / 4
        return F.col("at")[2 * i] + (part - F.floor(part)) * (F.col("at")[2 * i + 1] - F.col("at")[2 * i])

    quartiles = met.select(F.col("_g").alias("k"), F.array(*[quartile(i) for i in range(3)]).alias("q"))
    counts = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    reach = 1.5 * (F.col("q")[2] - F.col("q")[0])
    sized = quartiles.select("k", "q", (F.col("q")[0] - reach).alias("lower"), (F.col("q")[2] + reach).alias("upper"))
    within = F.col("v").between(F.col("lower"), F.col("upper"))
    return (
        counts.join(broadcastable(sized), "k")
        .groupBy("k", "q")
        .agg(
            F.min(F.when(within, F.col("v"))).alias("whisker_low"),
            F.max(F.when(within, F.col("v"))).alias("whisker_high"),
            F.sum(F.when(within, 0).otherwise(F.col("n"))).alias("n_outliers"),
        )
        .select(
            F.col("k").cast("string").alias("group"),
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            "whisker_low",
            "whisker_high",
            "n_outliers",
        )
    )


def kde(
    df: DataFrame,
    column: str,
    by: str | None = None,
    points: int = KDE_POINTS,
    cells: int | None = KDE_CELLS,
) -> DataFrame:
    """Gaussian density per class with Scott's bandwidth h, on a grid of the range ± half.

    The values are first reduced to cells of h / `cells`, each with its count and mean, so
    the cost is cells of the range times `points`, however many distinct values there are.
    Since the means are kept, a density is off by at most 0.05 / (h * cells ** 2): 1.3e-5
    of 1 / h by default. With None it is exact, from the distinct values and their counts. Either
    is added up to one curve per class inside each task, and only `points` sums per
    class and task are exchanged.
    """
    rows = df.select(
        (col(by).cast("string") if by else F.lit("all")).alias("group"),
        col(column).cast("double").alias("v"),
    ).where(F.col("v").isNotNull() & F.col("group").isNotNull())
    shape = rows.groupBy("group").agg(
        F.count("v").alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"),
        F.max("v").alias("hi"),
    )
    sized = shape.where(F.col("sd") > 0).select(
        "group",
        "n",
        "lo",
        (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"),
        (F.col("lo") - (F.col("hi") - F.col("lo")) / 2).alias("start"),
        (2 * (F.col("hi") - F.col("lo")) / (points - 1)).alias("step"),
    )
    if cells:
        spots = rows.join(broadcastable(sized.select("group", "h", F.col("lo").alias("from"))), "group")
        cell = F.floor((F.col("v") - F.col("from")) / (F.col("h") / cells)).alias("cell")
        reduced = spots.groupBy("group", cell).agg(F.avg("v").alias("v"), F.count(F.lit(1)).cast("double").alias("w"))
        weights = reduced.select("group", "v", "w")
    else:
        weights = rows.groupBy("group", "v").agg(F.count(F.lit(1)).cast("double").alias("w"))
    placed = weights.join(sized, "group").select("group", "v", "w", "h", "start", "step")

    def curves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            names = [g for g in held for _ in range(points)]
            point = np.tile(np.arange(points, dtype=np.int32), len(held))
            batch = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(point), pa.array(np.concatenate(list(held.values())))],
                names=["group", "point", "d"],
            )
            held.clear()
            return batch

        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            numbers = [batch.column(i).to_numpy() for i in range(1, 6)]
            for name in np.unique(group):
                v, w, h, start, step = (x[group == name] for x in numbers)
                x = start[0] + np.arange(points) * step[0]
                curve = held.setdefault(str(name), np.zeros(points))
                for at in range(0, len(v), KDE_VALUES):
                    z = (x[:, None] - v[None, at : at + KDE_VALUES]) / h[0]
                    curve += np.exp(-z * z / 2) @ w[at : at + KDE_VALUES]
                if len(held) >= KDE_CURVES:
                    yield flush()
        if held:
            yield flush()

    summed = placed.mapInArrow(curves, "`group` string, point int, d double").groupBy("group", "point")
    scale = F.col("n") * F.col("h") * F.sqrt(2 * F.pi())
    return (
        summed.agg(F.sum("d").alias("d"))
        .join(sized, "group")
        .select("group", "point", (F.col("start") + F.col("point") * F.col("step")).alias("x"), (F.col("d") / scale).alias("density"))
    )


def moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Population skewness and excess kurtosis; columns with fewer than 2 values are left out."""
    names = list(columns or S.numeric_columns(df))
    found = per_column(df, names, {"n": F.count, "skewness": F.skewness, "kurtosis": F.kurtosis})
    return found.where(F.col("n") >= 2).select(
        "column",
        F.round("skewness", 4).alias("skewness"),
        F.round("kurtosis", 4).alias("kurtosis"),
    )


def ks_normality(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    range_rows: int = KS_RANGE_ROWS,
) -> DataFrame:
    """Kolmogorov-Smirnov test of each column against the normal of its mean and std.

    All columns share four passes. A sketch cuts each column into value ranges; the rows
    in and before each are counted. Since both distribution functions only rise, the
    counts at a range's ends bound the distance inside it, and only ranges that may hold
    the largest one are read value by value (exact; of a column that is very nearly
    normal, all of them). The p-value is the limiting series with Vrbik's term for small
    n. Columns without two different values are left out; nulls and NaN are skipped.
    """
    names = list(columns or S.numeric_columns(df))
    empty = df.sparkSession.createDataFrame([], "column string, ks_statistic double, p_value double")
    if not names:
        return empty
    base = df.select(*[not_nan(col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(names)])
    plain = [f"c{i}" for i in range(len(names))]
    shape = {
        r["column"]: r
        for r in per_column(
            base, plain, {"n": F.count, "mean": F.avg, "sd": F.stddev_samp, "lo": F.min, "hi": F.max}
        ).collect()
        if r["n"] >= 2 and r["sd"] and math.isfinite(r["sd"])
    }
    if not shape:
        return empty
    points = _ks_points(base, shape, range_rows)
    splits = [[-math.inf, *points[c], math.inf] for c in shape]
    cut = Bucketizer(
        splitsArray=splits, inputCols=list(shape), outputCols=[f"r_{c}" for c in shape], handleInvalid="keep"
    ).transform(base)
    placed = cut.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"r_{c}").cast("int").alias("range"),
                F.col(c).alias("v"),
                (F.col(c) == F.element_at(F.array(*map(F.lit, splits[i])), F.col(f"r_{c}").cast("int") + 1)).alias("on"),
            )
            for i, c in enumerate(shape)
        ]))
    ).where("v IS NOT NULL")
    counted = placed.groupBy("column", "range").agg(F.count("v").alias("n"), F.count_if("on").alias("on"))
    best, opened = _ks_bounds(counted.collect(), points, shape)
    rows = [
        (c, names[int(c[1:])], r["n"], r["mean"], r["sd"], best[c]) for c, r in shape.items()
    ]
    per = df.sparkSession.createDataFrame(
        rows, "column string, name string, total long, mean double, sd double, best double"
    )
    if opened:
        wanted = df.sparkSession.createDataFrame(opened, "column string, range int, before long")
        values = placed.join(F.broadcast(wanted), ["column", "range"]).groupBy("column", "range", "before", "v")
        upto = F.sum("n").over(Window.partitionBy("column", "range").orderBy("v")) + F.col("before")
        steps = values.agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto).join(F.broadcast(per), "column")
        expected = normal_cdf((F.col("v") - F.col("mean")) / F.col("sd"))
        gap = F.greatest(
            F.abs(F.col("upto") / F.col("total") - expected),
            F.abs((F.col("upto") - F.col("n")) / F.col("total") - expected),
        )
        seen = steps.groupBy("column").agg(F.max(gap).alias("gap"))
        per = per.join(F.broadcast(seen), "column", "left").withColumn("best", F.greatest("best", "gap"))
    return per.select(
        F.col("name").alias("column"),
        F.round("best", 6).alias("ks_statistic"),
        F.round(kolmogorov_p(F.col("best"), F.col("total")), 6).alias("p_value"),
    )


def _ks_points(base: DataFrame, shape: dict, range_rows: int) -> dict[str, list[float]]:
    """The ends of each column's value ranges: its least and largest value and a sketch's quantiles."""
    asks = []
    for c, r in shape.items():
        ranges = min(max(math.ceil(r["n"] / range_rows), 64), KS_RANGES)
        steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
        asks.append(F.percentile_approx(c, steps, 10 * ranges).alias(c))
    row = base.agg(*asks).first()
    return {c: sorted({r["lo"], r["hi"], *row[c]}) for c, r in shape.items()}


def _ks_bounds(counts: list, points: dict, shape: dict) -> tuple[dict[str, float], list[tuple]]:
    """The largest distance at the ends of the ranges, and the ranges that may hold a larger one."""
    held = {(r["column"], r["range"]): r for r in counts}
    best, opened = {}, []
    for c, r in shape.items():
        expected = [0.5 * math.erfc((r["mean"] - p) / r["sd"] / math.sqrt(2)) for p in points[c]]
        seen, top, inner = 0, 0.0, []
        for i, at in enumerate(expected):
            cell = held.get((c, i + 1))
            n, on = (cell["n"], cell["on"]) if cell else (0, 0)
            before, upto = seen, seen + on
            top = max(top, abs(before / r["n"] - at), abs(upto / r["n"] - at))
            seen += n
            if n > on:
                beyond = expected[min(i + 1, len(expected) - 1)]
                inner.append((i + 1, before, max(seen / r["n"] - at, beyond - upto / r["n"])))
        best[c] = top
        opened += [(c, i, before) for i, before, bound in inner if bound > top]
    return best, opened


def iqr_bounds_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or S.numeric_columns(df))
    rows = [(c, *b) for c, b in iqr_bounds(df, names).items()]
    return df.sparkSession.createDataFrame(
        rows, "column string, q1 double, q3 double, lower double, upper double"
    )


def zscore_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add `<c>_zscore` with the population standard deviation; constants get null."""
    names = list(columns or S.numeric_columns(df))
    stats = df.agg(
        *[F.avg(col(c)).alias(f"mean_{c}") for c in names],
        *[F.stddev_pop(col(c)).alias(f"sd_{c}") for c in names],
    ).select(F.struct("*")).scalar()
    scored = df.withColumn("_shape", stats)
    return scored.withColumns(
        {
            f"{c}_zscore": F.try_divide(
                col(c) - F.col("_shape").getField(f"mean_{c}"),
                F.col("_shape").getField(f"sd_{c}"),
            )
            for c in names
        }
    ).drop("_shape")


