"""Exact, reproducible samples: split, class balancing, folds, fixed-size samples.

Rows are ordered by an md5 of seed and key. A sample is every row up to a hash value
found from counts, so taking it is a filter: the table is not shuffled and the same
seed gives the same rows on every run and after every recomputation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import col
from riskloom.functions.ordering import attach_cuts, group_sizes, hash_cell, hash_cuts, hash_key, values_at_ranks

_HASH = "_hash"
# Up to so many classes are cut by literals; the cuts of more are found and joined as a table.
LITERAL_CLASSES = 200


def _hashed(df: DataFrame, key: Sequence[str] | str, seed: int) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.withColumn(_HASH, hash_key(seed, *[col(k) for k in keys]))


def _up_to(cuts: dict, by: str | None):
    """True for rows whose hash lies within their group's cut."""
    taken = F.lit(False)
    for (g, _), cut in cuts.items():
        if cut is None:
            continue
        mine = col(by).eqNullSafe(F.lit(g)) if by else F.lit(True)
        taken = taken | (mine & (F.col(_HASH) <= cut))
    return taken


def _cut_off(hashed: DataFrame, by: str, ranks: dict) -> DataFrame:
    """Rows with `_cuts`, the hashes at their class's ranks, for many classes."""
    schema = T.StructType(
        [T.StructField("_g", hashed.schema[by].dataType), T.StructField("_k", T.IntegerType()),
         T.StructField("_rank", T.LongType())]
    )
    wanted = [(k, i, r) for k, rs in ranks.items() for i, r in enumerate(rs)]
    table = hashed.sparkSession.createDataFrame(wanted, schema)
    cuts = values_at_ranks(hashed, col(by), F.col(_HASH), table, hash_cell)
    return attach_cuts(hashed, col(by), _HASH, cuts)


def split_quotas(sizes: dict, test_size: float) -> dict:
    """Test rows per class: `ceil(test_size * n)` in all, shares by largest remainder."""
    total = sum(sizes.values())
    n_train = total - math.ceil(test_size * total)
    exact = {k: n_train * n / total for k, n in sizes.items()}
    train = {k: math.floor(v) for k, v in exact.items()}
    by_rest = sorted(sizes, key=lambda k: (-(exact[k] - train[k]), str(k)))
    for k in by_rest[: n_train - sum(train.values())]:
        train[k] += 1
    return {k: sizes[k] - train[k] for k in sizes}


def stratified_split(
    df: DataFrame,
    label: str = "loan_status",
    key: Sequence[str] | str = "id",
    test_size: float = 0.1,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Train and test tables with the label's shares; `key` is unique per row."""
    quotas = split_quotas(group_sizes(df, label), test_size)
    hashed = _hashed(df, key, seed)
    if len(quotas) > LITERAL_CLASSES:
        placed = _cut_off(hashed, label, {k: [q] for k, q in quotas.items()})
        in_test = F.coalesce(F.col(_HASH) <= F.col("_cuts")[0], F.lit(False))
        return tuple(placed.where(part).select(*[col(c) for c in df.columns]) for part in (~in_test, in_test))
    cuts = hash_cuts(hashed, _HASH, {k: [q] for k, q in quotas.items()}, col(label))
    in_test = _up_to(cuts, label)
    return hashed.where(~in_test).drop(_HASH), hashed.where(in_test).drop(_HASH)


def random_undersample(
    df: DataFrame,
    target: str = "loan_status",
    key: Sequence[str] | str = "id",
    ratio: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """All rows of the smaller class and `int(n_min / ratio)` of the larger one."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found")
    if not 0 < ratio <= 1:
        raise ValueError("ratio must be in the range (0, 1]")
    sizes = group_sizes(df, target)
    if len(sizes) < 2:
        raise ValueError("undersampling needs two classes")
    if len(sizes) > 2 and ratio != 1:
        raise ValueError("a ratio below 1 needs exactly two classes")
    n_min = min(sizes.values())
    smallest = min(sizes, key=lambda k: (sizes[k], str(k)))
    wanted = int(n_min / ratio)
    others = {k: n for k, n in sizes.items() if k != smallest}
    if any(wanted > n for n in others.values()):
        raise ValueError(f"ratio {ratio} asks for {wanted} rows, more than the larger class has")
    hashed = _hashed(df, key, seed)
    if len(sizes) > LITERAL_CLASSES:
        placed = _cut_off(hashed, target, {k: [min(n, wanted)] for k, n in sizes.items()})
        return placed.where(F.col(_HASH) <= F.col("_cuts")[0]).select(*[col(c) for c in df.columns])
    reduced = {k: [wanted] for k, n in others.items() if n > wanted}
    cuts = hash_cuts(hashed, _HASH, reduced, col(target))
    whole = F.lit(False)
    for k in sizes:
        if k not in reduced:
            whole = whole | col(target).eqNullSafe(F.lit(k))
    return hashed.where(whole | _up_to(cuts, target)).drop(_HASH)


def with_folds(
    df: DataFrame,
    label: str,
    key: Sequence[str] | str = "id",
    folds: int = 5,
    seed: int = 39,
    out: str = "fold",
) -> DataFrame:
    """Add a shuffled fold number; every class is spread evenly over the folds."""
    sizes = group_sizes(df, label)
    hashed = _hashed(df, key, seed)
    ranks = {k: [n * i // folds for i in range(1, folds)] for k, n in sizes.items()}
    if len(sizes) > LITERAL_CLASSES:
        placed = _cut_off(hashed, label, ranks)
        past = F.size(F.filter(F.col("_cuts"), lambda cut: F.col(_HASH) > cut))
        return placed.withColumn(out, F.when(F.col("_cuts").isNull(), 0).otherwise(past)).drop("_cuts", _HASH)
    cuts = hash_cuts(hashed, _HASH, ranks, col(label))
    fold = F.lit(0)
    for (k, _), cut in cuts.items():
        if cut is not None:
            past = col(label).eqNullSafe(F.lit(k)) & (F.col(_HASH) > cut)
            fold = fold + past.cast("int")
    return hashed.withColumn(out, fold).drop(_HASH)


def exact_sample(
    df: DataFrame, n: int = 5000, key: Sequence[str] | str = "id", seed: int = 42
) -> DataFrame:
    """`n` rows by hash order, or the whole table when it is not larger."""
    hashed = _hashed(df, key, seed)
    if df.count() <= n:
        return df
    cuts = hash_cuts(hashed, _HASH, {0: [n]})
    return hashed.where(_up_to(cuts, None)).drop(_HASH)
