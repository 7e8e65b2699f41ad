"""Linear and information scores of columns against each other and against a label."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.exprs import col, long_values, quoted
from riskloom.functions.quantiles import exact_quantiles

HIGH_CORRELATION = 0.8
SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_sums(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(`i`, `j`, sums) of every pair of columns over the rows that have both.

    Pairs grow with the square of the columns: forty columns need several thousand
    sums per row, far past what generated aggregation code is compiled for. Each task
    therefore folds its Arrow batches by four matrix products and passes on one row
    per pair. Values are taken from the column means of a first scan, which keeps the
    sums of squares exact enough for nearly constant columns.
    """
    means = df.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(names)]).first()
    centred = df.select(
        *[
            F.expr(f"cast({quoted(c)} AS double) - {means[i] or 0.0!r}D").alias(f"d{i}")
            for i, c in enumerate(names)
        ]
    )

    def fold(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            x = x.astype(float)
            seen = ~np.isnan(x)
            x = np.where(seen, x, 0.0)
            mask = seen.astype(float)
            part = np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
            total = part if total is None else total + part
        if total is not None:
            n, s, q, p = total
            i, j = np.triu_indices(len(n))
            columns = [i, j, n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], p[i, j]]
            types = [pa.int32()] * 2 + [pa.float64()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"],
            )

    schema = "i int, j int, " + ", ".join(f"{s} double" for s in SUMS)
    folded = centred.mapInArrow(fold, schema)
    return folded.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])


def pearson_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(`column_a`, `column_b`, `r`) of the given pairs; null when a column is constant."""
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    index = {c: i for i, c in enumerate(names)}
    spread_x, spread_y, r = (
        F.expr(e)
        for e in (
            "sxx - try_divide(sx * sx, n)",
            "syy - try_divide(sy * sy, n)",
            "try_divide(sxy - try_divide(sx * sy, n), sqrt(vx) * sqrt(vy))",
        )
    )
    # Rounding can leave a trace of spread in a constant column.
    varies = F.expr("vx > sxx * 1e-14D AND vy > syy * 1e-14D")
    scored = pair_sums(df, names).withColumns({"vx": spread_x, "vy": spread_y}).select(
        "i", "j", F.when(varies, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))).alias("r")
    )
    wanted = df.sparkSession.createDataFrame(
        [(a, b, *sorted((index[a], index[b]))) for a, b in pairs],
        "column_a string, column_b string, i int, j int",
    )
    return scored.join(F.broadcast(wanted), ["i", "j"]).select("column_a", "column_b", "r")


def pearson_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All ordered pairs, from one computation per unordered pair."""
    names = list(columns or S.numeric_columns(df))
    upper = pearson_pairs(df, [*combinations(names, 2), *[(c, c) for c in names]])
    mirrored = F.when(
        F.col("column_a") == F.col("column_b"), F.array(F.struct("column_a", "column_b"))
    ).otherwise(
        F.array(
            F.struct("column_a", "column_b"),
            F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b")),
        )
    )
    return upper.select(F.explode(mirrored).alias("p"), "r").select("p.column_a", "p.column_b", "r")


def high_correlation_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, threshold: float = HIGH_CORRELATION
) -> DataFrame:
    names = list(columns or S.numeric_columns(df))
    pairs = pearson_pairs(df, list(combinations(names, 2)))
    return pairs.where(F.abs("r") >= threshold).select(
        "column_a", "column_b", F.round("r", 4).alias("correlation")
    )


def multicollinearity_risk(high_pairs: DataFrame) -> DataFrame:
    """low below 10 highly correlated pairs, moderate below 30, else high."""
    n = F.col("n_pairs")
    return high_pairs.agg(F.count(F.lit(1)).alias("n_pairs")).select(
        n, F.when(n >= 30, "high").when(n >= 10, "moderate").otherwise("low").alias("risk")
    )


def top_corr_pairs(df: DataFrame, columns: Sequence[str] | None = None, k: int = 15) -> DataFrame:
    names = list(columns or S.numeric_columns(df))
    pairs = pearson_pairs(df, list(combinations(names, 2))).where(F.col("r").isNotNull())
    ranked = pairs.select(
        F.col("column_a").alias("feature_1"),
        F.col("column_b").alias("feature_2"),
        F.abs("r").alias("abs_corr"),
    )
    return ranked.orderBy(F.desc("abs_corr"), "feature_1", "feature_2").limit(k)


def label_correlation(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Absolute correlation of each feature with the label."""
    return pearson_pairs(df, [(c, label) for c in columns]).select(
        F.col("column_a").alias("feature"), F.abs("r").alias("pearson_abs")
    )


def anova_f_scores(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Variance between classes over variance within, per feature.

    The table is folded to one row per class with all features side by side; only
    these few rows are unpivoted and compared.
    """
    wide = df.where(col(label).isNotNull()).groupBy(col(label).alias("label")).agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(col(c)).cast("double").alias("n"),
                F.avg(col(c)).alias("mean"),
                F.coalesce(F.var_pop(col(c)), F.lit(0.0)).alias("var"),
            ).alias(f"f{i}")
            for i, c in enumerate(columns)
        ]
    )
    per_class = wide.select(
        "label", F.inline(F.array(*[F.col(f"f{i}") for i in range(len(columns))]))
    ).where(F.col("n") > 0)
    whole = Window.partitionBy("feature")
    overall = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    parts = per_class.withColumn("gap", F.col("mean") - overall)
    sums = parts.groupBy("feature").agg(
        F.sum(F.col("n") * F.col("gap") * F.col("gap")).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
    )
    f = F.try_divide(
        F.try_divide(F.col("between"), F.col("k") - 1),
        F.try_divide(F.col("within"), F.col("n") - F.col("k")),
    )
    return sums.select("feature", f.alias("f_score"))


def mutual_information(
    df: DataFrame, label: str, columns: Sequence[str], bins: int = 10
) -> DataFrame:
    """Mutual information of each feature, cut at its quantiles, with the label.

    The table is reduced to (feature, bin, label) counts in one pass; the scores
    come from these. A binned estimate: used to rank features, and lower in value
    than an estimate from nearest neighbours.
    """
    steps = [i / bins for i in range(1, bins)]
    known = df.where(col(label).isNotNull())
    edges = exact_quantiles(known, {c: col(c) for c in columns}, steps)

    def bin_of(c: str) -> Column:
        ends = sorted({e for e in edges[c] if e is not None})
        index = F.lit(0)
        for e in ends:
            index = index + (col(c) > e).cast("int")
        return index

    binned = known.select(
        col(label).alias("label"),
        *[bin_of(c).alias(c) for c in columns],
    )
    cells = (
        long_values(binned, list(columns), keep=["label"], as_type="int")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value", "label")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("column"))
    per_bin = F.sum("n").over(Window.partitionBy("column", "value"))
    per_label = F.sum("n").over(Window.partitionBy("column", "label"))
    parts = cells.select(
        "column",
        (F.col("n") / total * F.log(F.col("n") * total / (per_bin * per_label))).alias("part"),
    )
    return parts.groupBy(F.col("column").alias("feature")).agg(F.sum("part").alias("mutual_info"))
