"""Loan-shaped tables derived from orders, customers and line items.

The given tables are clean, so the dirt that the operators deal with (gaps, negative
amounts, swapped pairs, padded text, copies) is derived from the row keys. Every
order becomes a loan; a `CASE` on a key only decides how its values look.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import materialize

LINE_COLUMNS = {"installment", "revol_bal", "dti"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan that gives fewer tasks than there are cores, dealt out to all of them.

    Only a table in a few small files is moved; a large one keeps its splits.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _keys(spark: SparkSession, sf_dir: str, with_lines: bool, parallel: bool = False) -> DataFrame:
    """One row per order with its customer and, if asked for, its line totals."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_custkey AS u", "o_orderstatus AS st", "o_totalprice AS price",
        "o_orderdate AS od", "o_orderpriority AS pr",
    )
    if parallel:
        orders = spread(orders)
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS u", "c_acctbal AS bal", "c_mktsegment AS seg"
    )
    rows = orders.join(customer, "u", "left")
    if not with_lines:
        return rows
    lines = (
        table(spark, sf_dir, "lineitem")
        .selectExpr("l_orderkey AS k", "floor(l_extendedprice) AS p", "cast(l_quantity AS bigint) AS q")
        .groupBy("k")
        .agg(F.expr("max(p)").alias("inst"), F.expr("sum(p)").alias("rev"), F.expr("sum(q) % 60").alias("d"))
    )
    return rows.join(lines, "k", "left")


NUMBERS = {
    "loan_amnt": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 29 = 0 THEN -floor(price) ELSE floor(price) END",
    "funded_amnt": "floor(price)",
    "int_rate": "5 + u % 25 + 0.5D",
    "revol_util": "k % 101",
    "annual_inc": "floor(bal * 10)",
    "avg_cur_bal": "floor(bal * 7)",
    "total_pymnt": "floor(price * if(st = 'P', 0.4D, 1.1D))",
    "fico_range_low": "if(k % 17 = 0, 604, 600) + u % 200",
    "fico_range_high": "if(k % 17 = 0, 600, 604) + u % 200",
    "delinq_2yrs": "if(k % 7 = 0, NULL, k % 3)",
    "inq_last_6mths": "u % 6",
    "mths_since_last_delinq": "if(k % 2 = 0, NULL, k % 80)",
    "open_acc": "if(k % 23 = 0, NULL, 1 + u % 20)",
    "pub_rec": "k % 4",
    "total_acc": "5 + u % 40",
    "installment": "inst",
    "revol_bal": "rev",
    "dti": "d",
}
TEXTS = {
    "term": "if(k % 4 < 2, '36 months', '60 months')",
    "sub_grade": "concat(char(65 + u % 7), 1 + k % 5)",
    "emp_length": "CASE k % 13 WHEN 0 THEN '10+ years' WHEN 1 THEN '< 1 year' WHEN 2 THEN NULL "
    "ELSE concat(k % 13 - 2, ' years') END",
    "emp_title": "concat('title ', u % 50)",
    "home_ownership": "CASE seg WHEN 'FURNITURE' THEN 'RENT' WHEN 'MACHINERY' THEN 'MORTGAGE' "
    "WHEN 'BUILDING' THEN 'OWN' WHEN 'AUTOMOBILE' THEN 'ANY' ELSE 'NONE' END",
    "verification_status": "CASE k % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' "
    "ELSE 'Not Verified' END",
    "purpose": "lower(substring(pr, 3))",
    "pymnt_plan": "if(k % 19 = 0, 'y', 'n')",
    "initial_list_status": "if(k % 2 = 0, 'w', 'f')",
    "loan_status": """CASE
      WHEN k % 61 = 0 THEN NULL
      WHEN st = 'O' THEN 'Current'
      WHEN st = 'F' AND u % 25 >= 20 THEN 'Charged Off'
      WHEN st = 'F' THEN CASE k % 5 WHEN 3 THEN 'In Grace Period'
        WHEN 4 THEN 'Does not meet the credit policy. Status:Fully Paid' ELSE 'Fully Paid' END
      WHEN u % 25 < 5 THEN 'Fully Paid'
      ELSE CASE k % 6 WHEN 2 THEN 'Default' WHEN 3 THEN 'Late (31-120 days)' WHEN 4 THEN 'Late (16-30 days)'
        WHEN 5 THEN 'Does not meet the credit policy. Status:Charged Off' ELSE 'Charged Off' END
    END""",
}
# How the landing table writes its columns; numbers not named here are plain digits.
LANDED = {
    "id": "cast(k AS string)",
    "issue_d": "if(k % 97 = 0, NULL, date_format(od, 'MMM-yyyy'))",
    "earliest_cr_line": "CASE k % 3 WHEN 0 THEN date_format(od, 'MMM-yyyy') "
    "WHEN 1 THEN date_format(od, 'yyyy-MM-dd') ELSE 'not-a-date' END",
    "loan_amnt": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 29 = 0 THEN concat('-', floor(price)) "
    "ELSE concat('$', format_number(floor(price), 0)) END",
    "int_rate": "concat(5 + u % 25, '.5%')",
    "revol_util": "concat(k % 101, '%')",
    "dti": "if(k % 53 = 0, 'bad', cast(d AS string))",
    "sub_grade": f"if(k % 6 = 0, concat(' ', {TEXTS['sub_grade']}, '  '), {TEXTS['sub_grade']})",
    "term": "CASE k % 4 WHEN 0 THEN ' 36   months ' WHEN 1 THEN '36 months' WHEN 2 THEN ' 60 months' "
    "ELSE concat('60', char(9), 'months') END",
    "emp_length": f"coalesce({TEXTS['emp_length']}, 'nan')",
    "emp_title": f"CASE WHEN k % 37 = 0 THEN 'None' WHEN k % 31 = 0 THEN '' ELSE {TEXTS['emp_title']} END",
    "home_ownership": f"if(k % 41 = 0, lower({TEXTS['home_ownership']}), {TEXTS['home_ownership']})",
    "pymnt_plan": "if(k % 19 = 0, ' Y ', 'n')",
    "loan_status": f"coalesce({TEXTS['loan_status']}, 'null')",
}
NUMBER_NAMES = list(NUMBERS)
TEXT_NAMES = list(TEXTS)


def loans(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The typed loan table: numbers as doubles, text, dates, nulls; chosen columns or all."""
    names = columns or ("id", "issue_d", *NUMBERS, *TEXTS)
    exprs = {"id": "k", "issue_d": "if(k % 97 = 0, NULL, od)"}
    exprs |= {c: f"cast({e} AS double)" for c, e in NUMBERS.items()} | TEXTS
    rows = _keys(spark, sf_dir, bool(LINE_COLUMNS & set(names)))
    return rows.selectExpr(*[f"{exprs[c]} AS {c}" for c in names])


def raw_loans(spark: SparkSession, sf_dir: str, *columns: str, parallel: bool = False) -> DataFrame:
    """The landing table as text with all its dirt; every fiftieth loan arrives twice."""
    names = columns or ("id", "issue_d", "earliest_cr_line", *NUMBERS, *TEXTS)
    exprs = {c: f"cast(cast({e} AS bigint) AS string)" for c, e in NUMBERS.items()} | TEXTS | LANDED
    rows = _keys(spark, sf_dir, bool(LINE_COLUMNS & set(names)), parallel)
    copies = rows.selectExpr("*", "explode(sequence(1, if(k % 50 = 0, 2, 1))) AS copy")
    return copies.selectExpr(*[f"{exprs[c]} AS {c}" for c in names])


SERIES = {"CPI": "l_quantity", "Unemployment Rate": "l_discount", "Federal Funds Rate": "l_tax"}


def indicators(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three monthly series from one pass over the line items; each misses some months."""
    monthly = (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            "year(l_shipdate) AS Year", "month(l_shipdate) AS Month",
            *[f"cast(round({c} * {1 if c == 'l_quantity' else 100}) AS bigint) AS {c}" for c in SERIES.values()],
        )
        .groupBy("Year", "Month")
        .agg(*[F.expr(f"sum({c}) / count({c})").alias(n) for n, c in SERIES.items()])
    )
    staged = materialize(monthly, "series")
    return [
        staged.where(f"(Year * 12 + Month) % 10 <> {1 + 3 * i}").select("Year", "Month", name)
        for i, name in enumerate(SERIES)
    ]


def labelled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Loans with the analysis label, unresolved loans removed."""
    from riskloom.operators.labels import build_target

    return build_target(loans(spark, sf_dir, *dict.fromkeys([*columns, "loan_status"])))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with a fixed scoring formula in place of a model: label, probability, prediction."""
    from riskloom.operators.labels import filter_loan_status

    rows = filter_loan_status(loans(spark, sf_dir, "id", "int_rate", "revol_util", "loan_status"))
    margin = (F.col("int_rate") - 20) * 0.15 + (F.col("revol_util") - 50) * 0.01
    chance = F.round(1 / (1 + F.exp(-margin)), 3)
    return rows.select(
        "id", F.col("loan_status").alias("label"), chance.alias("probability"),
        (chance > 0.5).cast("int").alias("prediction"),
    )

