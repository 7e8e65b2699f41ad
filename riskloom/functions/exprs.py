"""Column expressions shared by the operators; all stay inside code generation."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as Python's `str.strip` knows it, texts that mean
# "missing", and the accepted date layouts.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
MISSING_TEXTS = ["", "nan", "None", "null"]
DATE_LAYOUTS = {
    "MMM-yyyy": r"^[A-Za-z]{3}-\d{4}$",
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
}
MONTH_LAYOUT = "MMM-yyyy"


def quoted(name: str) -> str:
    """A column's exact name for SQL text, also with blanks or dots in it."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def strip(c: Column) -> Column:
    """Strip all white space; plain `trim` takes blanks only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blanks_only(c: Column) -> Column:
    """All white space as blanks, none at the ends."""
    return F.trim(F.translate(c, WHITE_SPACE, " " * len(WHITE_SPACE)))


def single_blanks(c: Column) -> Column:
    """Runs of blanks as one; only the rare text with a double blank meets a regular expression."""
    return F.when(c.contains("  "), F.regexp_replace(c, " +", " ")).otherwise(c)


def known_text(c: Column) -> Column:
    """Texts that mean "missing" as null."""
    return F.when(~c.isin(MISSING_TEXTS), c)


def lenient_timestamp(c: Column) -> Column:
    """The first layout whose shape the text has; parsing is tried only on that one."""
    out = F.lit(None).cast("timestamp")
    for layout, shape in reversed(DATE_LAYOUTS.items()):
        out = F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(layout))).otherwise(out)
    return out


def amount(c: Column) -> Column:
    """Number from text such as `$1,200` or `12.5%`; null when none is left."""
    return F.regexp_replace(c, r"[^0-9eE+\-.]", "").try_cast("double")


def not_nan(c: Column) -> Column:
    """NaN to null, the only form of missing value used here."""
    return F.when(~F.isnan(c), c)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def normal_cdf(z: Column) -> Column:
    """The standard normal distribution function: 1/2 and the density times z + z^3/3 + z^5/15 + ...

    All terms have one sign, so nothing cancels; beyond 8 deviations it is 0 or 1 to double precision.
    """
    square = z * z
    start = F.struct(z.alias("term"), z.alias("total"))

    def add(state, k):
        term = state["term"] * square / (2 * k + 1)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(120)), start, add, lambda s: s["total"])
    near = 0.5 + F.exp(-square / 2) / F.sqrt(2 * F.pi()) * series
    return F.when(z > 8, 1.0).when(z < -8, 0.0).otherwise(near)


def kolmogorov_p(distance: Column, n: Column) -> Column:
    """The chance of a larger Kolmogorov-Smirnov distance of n values: the limit, with Vrbik's term for small n."""
    root = F.sqrt(n.cast("double"))
    x = distance * root + 1 / (6 * root) + (distance * root - 1) / (4 * n)
    small = sum(F.exp(-((2 * k - 1) ** 2) * F.pi() * F.pi() / (8 * x * x)) for k in range(1, 6))
    large = sum((-1) ** (k - 1) * F.exp(-2 * k * k * x * x) for k in range(1, 11))
    below = 1 - F.sqrt(2 * F.pi()) / x * small
    return F.least(F.greatest(F.when(x < 1, below).otherwise(2 * large), F.lit(0.0)), F.lit(1.0))


def digamma(n: Column) -> Column:
    """psi of a positive number: the recurrence up to n + 10, then the asymptotic series."""
    x = n.cast("double") + 10
    square = 1 / (x * x)
    series = square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240 - square / 132))))
    return F.log(x) - 0.5 / x - series - sum(1 / (n + i) for i in range(10))


def row_digest(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes over all values of a row.

    Values count in full (microseconds, all digits), 0.0 and -0.0 are one value, and
    flags tell a null from an absent neighbour.
    """
    cells = [cell for c in columns for cell in (col(c).isNull(), col(c))]
    return F.xxhash64(*cells).alias("_d1"), F.xxhash64(F.lit(1), *cells).alias("_d2")


def null_cells(columns: list[str]) -> Column:
    """Nulls of one row over the given columns."""
    return F.expr(" + ".join(["0", *[f"cast({quoted(c)} IS NULL AS int)" for c in columns]]))


def per_column(
    df: DataFrame,
    columns: list[str],
    metrics: Mapping[str, Callable[[Column], Column]],
    chunk: int = 60,
) -> DataFrame:
    """One row (`column`, metric…) per column from a wide aggregate.

    All columns are folded in the same scan and one output row is exchanged per
    task; only tables wider than `chunk` columns are read once per chunk.
    """
    parts = []
    for start in range(0, len(columns), chunk):
        names = columns[start : start + chunk]
        wide = df.agg(
            *[f(col(c)).alias(f"m{i}_{m}") for i, c in enumerate(names) for m, f in metrics.items()]
        )
        rows = [
            F.struct(F.lit(c).alias("column"), *[F.col(f"m{i}_{m}").alias(m) for m in metrics])
            for i, c in enumerate(names)
        ]
        parts.append(wide.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def long_values(df: DataFrame, columns: list[str], keep: list[str] = (), as_type: str | None = None):
    """Unpivot to (`column`, `value`), keeping the `keep` columns."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (col(c).cast(as_type) if as_type else col(c)).alias("value"),
        )
        for c in columns
    ]
    return df.select(*[col(k) for k in keep], F.inline(F.array(*cells)))


def attach_scalars(df: DataFrame, stats: DataFrame, name: str = "_stats") -> DataFrame:
    """Attach a one-row table to every row as the struct column `name`.

    The row is a scalar subquery: computed once, then a constant in the scan's
    own projection, with no join at all.
    """
    return df.withColumn(name, stats.select(F.struct("*")).scalar())
