"""Feature columns: encoders, bands, one-hot columns and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas as S
from riskloom.functions.exprs import attach_scalars, col, lenient_timestamp, long_values
from riskloom.functions.ordering import running_sums
from riskloom.functions.quantiles import exact_quantiles
from riskloom.session import bounded_rows, materialize

# Values of an ordinal column held as literals, and joined by broadcast.
LITERAL_VALUES = 100
JOINED_VALUES = 10_000
# Values of a column that may become columns, unless the caller allows more.
ONE_HOT_VALUES = 10_000


def create_fico_feature(df: DataFrame, drop: Sequence[str] = S.LEAKAGE_COLUMNS) -> DataFrame:
    """Mean of the score range; columns that leak the outcome are dropped."""
    low, high = (col(c) for c in S.FICO_COLUMNS)
    return df.withColumn("fico", (low + high) / 2).drop(*drop)


def equals_flag(c: Column, text: str) -> Column:
    return F.coalesce(c == text, F.lit(False)).cast("int")


def encode_term(df: DataFrame, column: str = "term") -> DataFrame:
    return df.withColumn(column, equals_flag(col(column), "36 months"))


def encode_pymnt_plan(df: DataFrame, column: str = "pymnt_plan") -> DataFrame:
    return df.withColumn(column, equals_flag(col(column), "y"))


def encode_emp_length(df: DataFrame, column: str = "emp_length") -> DataFrame:
    """Years as a number; a text that does not start with a number raises."""
    c = col(column)
    years = (
        F.when(c == "10+ years", 10)
        .when(c == "< 1 year", 0)
        .when(c == "Unknown", -1)
        .otherwise(F.split(c, " ")[0].cast("int"))
    )
    return df.withColumn(column, years)


def emp_years_digits(df: DataFrame, column: str = "emp_length", out: str = "emp_yrs") -> DataFrame:
    """All digits of the text as a number, so that `< 1 year` counts as 1."""
    return df.withColumn(out, F.regexp_replace(col(column), r"\D", "").try_cast("double"))


def emp_years_dashboard(
    df: DataFrame, column: str = "emp_length", out: str = "emp_yrs"
) -> DataFrame:
    """Years with `< 1` as 0 and `10+` as 10; rows without a number are dropped."""
    c = col(column)
    digits = F.regexp_replace(c, r"\D", "").try_cast("int")
    years = (
        F.when(c.contains("< 1"), 0).when(c.contains("10+"), 10).otherwise(F.coalesce(digits, F.lit(-1)))
    )
    label = (
        F.when(F.col(out) == 0, "< 1 yr")
        .when(F.col(out) == 10, "10+ yrs")
        .otherwise(F.concat(F.col(out).cast("string"), F.lit(" yrs")))
    )
    kept = df.where(c.isNotNull()).withColumn(out, years).where(F.col(out) >= 0)
    return kept.withColumn("label", label)


def collapse_rare(
    df: DataFrame,
    column: str = "home_ownership",
    keep: Sequence[str] = S.HOME_OWNERSHIP_KEPT,
    other: str = "OTHER",
) -> DataFrame:
    return df.withColumn(column, F.when(col(column).isin(*keep), col(column)).otherwise(other))


def trim_above_quantile(
    df: DataFrame, column: str, prob: float = 0.99, positive: bool = False
) -> DataFrame:
    """Rows up to the quantile of all rows; `positive` also asks for values above 0."""
    cut = exact_quantiles(df, {column: col(column)}, [prob])[column][0]
    kept = df.where(col(column) <= F.lit(cut).cast("double"))
    return kept.where(col(column) > 0) if positive else kept


def log10_feature(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.withColumn(out, F.log10(F.when(col(column) > 0, col(column))))


def percent_to_double(df: DataFrame, column: str = "int_rate") -> DataFrame:
    if column not in S.text_columns(df):
        return df
    return df.withColumn(column, F.replace(col(column), F.lit("%"), F.lit("")).cast("double"))


def band(df: DataFrame, column: str, edges: Sequence[float] = S.FICO_EDGES, out: str = "band"):
    """Right-closed bands with their text and index; values outside have none."""
    index, text = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, (lo, hi) in reversed(list(enumerate(zip(edges[:-1], edges[1:], strict=True)))):
        inside = (col(column) > lo) & (col(column) <= hi)
        index = F.when(inside, i).otherwise(index)
        text = F.when(inside, f"{lo}-{hi}").otherwise(text)
    return df.withColumns({out: text, f"{out}_index": index})


def year_month(df: DataFrame, column: str, out: str = "ym") -> DataFrame:
    """`yyyy-MM` of a date column; rows without a readable date are dropped."""
    c = col(column)
    if column in S.text_columns(df):
        c = lenient_timestamp(c)
    return df.withColumn(out, F.date_format(c, "yyyy-MM")).where(F.col(out).isNotNull())


def code_to_label(
    df: DataFrame,
    column: str,
    labels: Mapping[int, str] | None = None,
    out: str = "status",
) -> DataFrame:
    """0 / 1 to text, with 1 as the charged-off class."""
    chosen = F.lit(None).cast("string")
    for code, text in (labels or {0: "Fully Paid", 1: "Charge Off"}).items():
        chosen = F.when(col(column) == code, text).otherwise(chosen)
    return df.withColumn(out, chosen)


def margin_to_probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def ordinal_encode_desc(df: DataFrame, column: str = "sub_grade", out: str | None = None):
    """Distinct values in descending order to 0, 1, 2, …

    A short value list is held as a map literal, which is searched value by value. A
    longer one is joined: by broadcast up to `JOINED_VALUES`, beyond that numbered range
    by range and joined back by shuffle.
    """
    values = df.select(col(column).alias("v")).where(col(column).isNotNull()).distinct()
    rows = bounded_rows(values, JOINED_VALUES)
    name = out or column
    if rows is not None:
        ordered = sorted((r["v"] for r in rows), reverse=True)
        if not ordered:
            return df.withColumn(name, F.lit(None).cast("int"))
        if len(ordered) <= LITERAL_VALUES:
            pairs = [x for i, v in enumerate(ordered) for x in (F.lit(v), F.lit(i))]
            return df.withColumn(name, F.try_element_at(F.create_map(*pairs), col(column)))
        schema = T.StructType([T.StructField("_v", values.schema["v"].dataType), T.StructField("_i", T.IntegerType())])
        numbered = [(v, i) for i, v in enumerate(ordered)]
        keyed = F.broadcast(df.sparkSession.createDataFrame(numbered, schema))
    else:
        numbered = number_distinct(values, descending=True)
        keyed = numbered.select(F.col("v").alias("_v"), F.col("index").cast("int").alias("_i"))
    joined = df.join(keyed, col(column) == F.col("_v"), "left")
    kept = [col(c) for c in df.columns if c != name]
    return joined.select(*kept, F.col("_i").alias(name))


def number_distinct(values: DataFrame, descending: bool = False) -> DataFrame:
    """Number the distinct values `v` from 0 in order, for any number of values.

    The values are range partitioned and staged with their partition number, so the
    ranges are fixed; each is numbered by itself and starts after those before it.
    """
    order = F.desc("v") if descending else F.asc("v")
    staged = materialize(
        values.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ordinal"
    )
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    starts = running_sums(sizes, "_part", ["n"]).select(
        F.col("_part"), (F.col("cum_n") - F.col("n")).alias("_start")
    )
    row = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return staged.join(starts, "_part").select("v", (row - 1 + F.col("_start")).alias("index"))


def one_hot_values(
    df: DataFrame, columns: Sequence[str], limit: int = ONE_HOT_VALUES
) -> dict[str, list[str]]:
    """The sorted distinct values per column, in one pass over all columns.

    Each becomes a column of the result and so part of its schema; columns with more
    than `limit` values are refused by an error.
    """
    names = S.present(df, columns)
    if not names:
        return {}
    found = long_values(df, names, as_type="string").where(F.col("value").isNotNull()).distinct()
    rows = bounded_rows(found, limit * len(names))
    per = {c: [] for c in names}
    for r in rows or []:
        per[r["column"]].append(r["value"])
    if rows is None or any(len(v) > limit for v in per.values()):
        raise ValueError(f"more than {limit} values to spread over columns: {names}")
    return {c: sorted(v) for c, v in per.items()}


def one_hot_encode_columns(
    df: DataFrame, columns: Sequence[str], values: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Replace each column by one 0/1 column per value; pass `values` to reuse a training set's."""
    known = one_hot_values(df, columns) if values is None else values
    kept = [col(c) for c in df.columns if c not in known]
    flags = [
        equals_flag(col(c).cast("string"), v).alias(f"{c}_{v}") for c in known for v in known[c]
    ]
    return df.select(*kept, *flags)


def feature_extent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: `min_<c>` and `max_<c>` of every column."""
    return df.agg(
        *[F.min(col(c)).cast("double").alias(f"min_{c}") for c in columns],
        *[F.max(col(c)).cast("double").alias(f"max_{c}") for c in columns],
    )


def min_max_scaled(c: Column, lo: Column, hi: Column) -> Column:
    """(c - lo) / (hi - lo), dividing by 1 where there is no range."""
    width = hi - lo
    return (c - lo) / F.when(width == 0, F.lit(1.0)).otherwise(width)


def normalize_with(df: DataFrame, extent: DataFrame, columns: Sequence[str]) -> DataFrame:
    sized = attach_scalars(df, extent, "_extent")
    scaled = {
        c: min_max_scaled(
            col(c).cast("double"),
            F.col("_extent").getField(f"min_{c}"),
            F.col("_extent").getField(f"max_{c}"),
        )
        for c in columns
    }
    return sized.select(*[scaled.get(c, col(c)).alias(c) for c in df.columns])


def normalize_train_test(
    train: DataFrame,
    test: DataFrame,
    columns: Sequence[str] = S.MINMAX_COLUMNS,
    label: str = "loan_status",
) -> tuple[DataFrame, DataFrame]:
    """Scale both tables by the training table's extent; test values are not clipped."""
    names = [c for c in S.present(train, columns) if c != label]
    if not names:
        return train, test
    extent = feature_extent(train, names)
    return normalize_with(train, extent, names), normalize_with(test, extent, names)

