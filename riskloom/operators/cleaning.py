"""Row-local cleaning, gap filling, duplicate removal and outlier clipping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas as S
from riskloom.functions.exprs import (
    amount,
    blanks_only,
    col,
    lenient_timestamp,
    known_text,
    row_digest,
    single_blanks,
    strip,
)
from riskloom.functions.ordering import carry_values
from riskloom.functions.quantiles import exact_quantiles
from riskloom.session import BROADCAST_ROWS, bounded_rows, broadcastable


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def strip_and_standardize_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strip, collapse white space, and turn texts that mean "missing" into null."""
    names = S.text_columns(df) if columns is None else S.present(df, columns)
    # One projection for each part: within one, every part is worked out again wherever the next names it.
    for part in (blanks_only, single_blanks, known_text):
        df = df.withColumns({c: part(col(c)) for c in names})
    return df


def parse_dates(df: DataFrame, columns: Sequence[str] = S.DATE_COLUMNS) -> DataFrame:
    """Text dates to timestamps; what cannot be read becomes null."""
    text = set(S.text_columns(df))
    return df.withColumns(
        {c: lenient_timestamp(col(c)) for c in S.present(df, columns) if c in text}
    )


def parse_issue_month(df: DataFrame, column: str = "issue_d") -> DataFrame:
    """Strict month text such as `Dec-2015`, else null."""
    return df.withColumn(column, F.try_to_timestamp(col(column), F.lit("MMM-yyyy")))


def coerce_numeric_columns(df: DataFrame, columns: Sequence[str] = S.NUMERIC_COLUMNS) -> DataFrame:
    """Amounts and percentages written as text to numbers; numeric columns stay."""
    numeric = set(S.numeric_columns(df))
    return df.withColumns(
        {c: amount(col(c)) for c in S.present(df, columns) if c not in numeric}
    )


def null_if_negative(df: DataFrame, columns: Sequence[str] = S.NON_NEGATIVE_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.when(col(c) >= 0, col(c)) for c in S.present(df, columns)})


def swap_inverted_pair(df: DataFrame, low: str, high: str) -> DataFrame:
    """Exchange the two values where both are present and in the wrong order."""
    if len(S.present(df, [low, high])) < 2:
        return df
    both = col(low).isNotNull() & col(high).isNotNull()
    return df.withColumns(
        {
            low: F.when(both, F.least(col(low), col(high))).otherwise(col(low)),
            high: F.when(both, F.greatest(col(low), col(high))).otherwise(col(high)),
        }
    )


def normalize_flag(df: DataFrame, column: str = "pymnt_plan") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, F.lower(strip(col(column).cast("string"))))


def repair_logical_relationships(df: DataFrame) -> DataFrame:
    """Negative values, inverted score ranges and flag spelling."""
    repaired = null_if_negative(df)
    return normalize_flag(swap_inverted_pair(repaired, *S.FICO_COLUMNS))


def drop_mandatory_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = S.present(df, S.MANDATORY_COLUMNS if columns is None else columns)
    return df.na.drop(subset=names) if names else df


def sort_by_date(df: DataFrame, column: str = "issue_d") -> DataFrame:
    """Rows in date order, for output only; no operator here depends on row order.

    Rows of one date are ordered by a hash of the row, so a busy date is spread over tasks.
    """
    return df.orderBy(col(column), *row_digest(df.columns))


def fill_forward_back(
    df: DataFrame, columns: Sequence[str], order: str, grain: str = "month"
) -> DataFrame:
    """Fill gaps along time from the latest earlier value, else the earliest later one.

    Values are known per `grain` (one macro value per month), so the table is first
    reduced to one row per period, filled there, and joined back. Inside a period
    any present value serves its gaps; rows without a date are left as they are.
    """
    names = S.present(df, columns)
    if not names or order not in df.columns:
        return df
    period = F.unix_micros(F.date_trunc(grain, col(order)))
    dated = df.withColumn("_period", period)
    known = (
        dated.where(F.col("_period").isNotNull())
        .groupBy("_period")
        .agg(*[F.max(col(c)).alias(c) for c in names])
    )
    filled = carry_values(known, "_period", names).select(
        "_period", *[col(c).alias(f"_fill_{c}") for c in names]
    )
    joined = dated.join(broadcastable(filled), "_period", "left")
    out = {c: F.coalesce(col(c), col(f"_fill_{c}")) for c in names}
    return joined.select(*[out.get(c, col(c)).alias(c) for c in df.columns])


def zero_fill(df: DataFrame, columns: Sequence[str] = S.ZERO_FILL_COLUMNS) -> DataFrame:
    return df.na.fill(0, subset=S.present(df, columns))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    quantiles = exact_quantiles(df, {c: col(c) for c in columns}, [0.5])
    return {c: q[0] for c, q in quantiles.items()}


def median_fill(df: DataFrame, columns: Sequence[str] = S.MEDIAN_FILL_COLUMNS) -> DataFrame:
    """Null to the column's exact median; a column without values stays null."""
    names = S.present(df, columns)
    known = {c: m for c, m in medians(df, names).items() if m is not None} if names else {}
    return df.withColumns(
        {c: F.coalesce(col(c).cast("double"), F.lit(m)) for c, m in known.items()}
    )


def unknown_fill(df: DataFrame, columns: Sequence[str] = S.STRING_COLUMNS) -> DataFrame:
    return df.na.fill("Unknown", subset=S.present(df, columns))


def handle_missing_values(
    df: DataFrame,
    mandatory: Sequence[str] | None = None,
    indicators: Sequence[str] = S.INDICATOR_COLUMNS,
) -> DataFrame:
    """Drop rows without key fields, then fill each kind of column its own way."""
    kept = drop_mandatory_nulls(df, mandatory)
    kept = fill_forward_back(kept, indicators, "issue_d")
    return unknown_fill(median_fill(zero_fill(kept)))


def drop_duplicates_keep_first(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str] = (),
    max_repeated: int = BROADCAST_ROWS,
) -> DataFrame:
    """The first row per key in the order of `order`, then of all other columns.

    Only the keys are counted and exchanged at first. When few keys repeat, all other
    rows stay where they are and only the repeated ones are reduced; when many do, all
    rows are.
    """
    repeated = df.groupBy(*[col(k) for k in key]).count().where("count > 1").drop("count")
    rows = bounded_rows(repeated, max_repeated)
    if rows is None:
        return _first_per_key(df, key, order)
    if not rows:
        return df
    keys = df.sparkSession.createDataFrame(rows, repeated.schema)
    keys = keys.toDF(*[f"_key{i}" for i in range(len(key))])
    same = reduce(
        lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(key)]
    )
    single = df.join(F.broadcast(keys), same, "left_anti")
    copies = df.join(F.broadcast(keys), same, "left_semi")
    return single.unionByName(_first_per_key(copies, key, order))


def _first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A minimum over whole rows: copies of a hot key collapse before the shuffle."""
    lead = S.present(df, order)
    rest = [c for c in df.columns if c not in lead and c not in key]
    row = F.struct(*[col(c) for c in [*lead, *rest]])
    return (
        df.groupBy(*[col(k) for k in key])
        .agg(F.min(row).alias("_row"))
        .select(*[col(c) if c in key else F.col("_row").getField(c).alias(c) for c in df.columns])
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def remove_duplicates(df: DataFrame, key: str = "id", order: Sequence[str] = ("issue_d",)):
    """One row per key; without the key column, distinct rows."""
    if key in df.columns:
        return drop_duplicates_keep_first(df, [key], order)
    return distinct_rows(df)


def iqr_bounds(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> dict:
    """{column: (q1, q3, lower, upper)} of the columns with values."""
    quartiles = exact_quantiles(df, {c: col(c) for c in columns}, [0.25, 0.75])
    out = {}
    for c, (q1, q3) in quartiles.items():
        if q1 is not None:
            out[c] = (q1, q3, q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
    return out


def clip_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pull values into the 1.5 IQR range; columns without spread or values stay."""
    names = S.present(df, S.CLIP_COLUMNS if columns is None else columns)
    if not names:
        return df
    bounds = iqr_bounds(df, names)

    def clipped(c: str) -> Column:
        _, _, lower, upper = bounds[c]
        v = col(c).cast("double")
        return F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(upper)), F.lit(lower)))

    spread = [c for c, (q1, q3, _, _) in bounds.items() if q3 != q1]
    return df.withColumns({c: clipped(c) for c in spread})


def finalize_types(df: DataFrame, columns: Sequence[str] = S.WHOLE_NUMBER_COLUMNS) -> DataFrame:
    """Whole-number columns to 64-bit integers, rounding halves to even."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def whole(c: str) -> Column:
        if isinstance(kinds[c], T.IntegralType):
            return col(c).cast("bigint")
        if isinstance(kinds[c], T.StringType):
            rounded = F.bround(col(c).try_cast("double"), 0).cast("bigint")
            return F.coalesce(col(c).try_cast("bigint"), rounded)
        return F.bround(col(c).cast("double"), 0).cast("bigint")

    return df.withColumns({c: whole(c) for c in S.present(df, columns)})
