"""The same loan tables as DuckDB SQL, placed before every check query."""

from __future__ import annotations

_KEYS = """
loan_lines AS (
  SELECT l_orderkey AS lk,
         max(floor(l_extendedprice))::BIGINT AS inst,
         sum(floor(l_extendedprice)::BIGINT)::BIGINT AS rev,
         (sum(l_quantity::BIGINT) % 60)::BIGINT AS d
  FROM lineitem GROUP BY l_orderkey),
loan_keys AS (
  SELECT o_orderkey AS k, o_custkey AS u, o_orderstatus AS st, o_totalprice AS price,
         o_orderdate AS od, o_orderpriority AS pr, c_acctbal AS bal, c_mktsegment AS seg,
         inst, rev, d, floor(o_totalprice)::BIGINT AS amt
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN loan_lines ON lk = o_orderkey),
loan_parts AS (
  SELECT *,
    CASE WHEN st = 'P' THEN 0.4::DOUBLE ELSE 1.1::DOUBLE END AS factor,
    CASE WHEN seg = 'FURNITURE' THEN 'RENT' WHEN seg = 'MACHINERY' THEN 'MORTGAGE'
         WHEN seg = 'BUILDING' THEN 'OWN' WHEN seg = 'AUTOMOBILE' THEN 'ANY' ELSE 'NONE' END AS home,
    chr((65 + u % 7)::INTEGER) || (1 + k % 5)::VARCHAR AS grade,
    CASE WHEN k % 13 = 0 THEN '10+ years' WHEN k % 13 = 1 THEN '< 1 year'
         WHEN k % 13 = 2 THEN NULL ELSE (k % 13 - 2)::VARCHAR || ' years' END AS emp,
    CASE k % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END AS ver,
    CASE WHEN k % 61 = 0 THEN NULL
         WHEN st = 'O' THEN 'Current'
         WHEN st = 'F' THEN
           CASE WHEN u % 25 >= 20 THEN 'Charged Off' WHEN k % 5 = 3 THEN 'In Grace Period'
                WHEN k % 5 = 4 THEN 'Does not meet the credit policy. Status:Fully Paid'
                ELSE 'Fully Paid' END
         WHEN u % 25 < 5 THEN 'Fully Paid'
         WHEN k % 6 < 2 THEN 'Charged Off' WHEN k % 6 = 2 THEN 'Default'
         WHEN k % 6 = 3 THEN 'Late (31-120 days)' WHEN k % 6 = 4 THEN 'Late (16-30 days)'
         ELSE 'Does not meet the credit policy. Status:Charged Off' END AS status
  FROM loan_keys)"""

_LOANS = """
loans AS (
  SELECT k AS id,
    CASE WHEN k % 97 = 0 THEN NULL ELSE od END AS issue_d,
    (CASE WHEN k % 11 = 0 THEN NULL WHEN k % 29 = 0 THEN -amt ELSE amt END)::DOUBLE AS loan_amnt,
    amt::DOUBLE AS funded_amnt,
    (5 + u % 25)::DOUBLE + 0.5::DOUBLE AS int_rate,
    (k % 101)::DOUBLE AS revol_util,
    floor(bal * 10)::DOUBLE AS annual_inc,
    floor(bal * 7)::DOUBLE AS avg_cur_bal,
    floor(price * factor)::DOUBLE AS total_pymnt,
    (CASE WHEN k % 17 = 0 THEN 604 ELSE 600 END + u % 200)::DOUBLE AS fico_range_low,
    (CASE WHEN k % 17 = 0 THEN 600 ELSE 604 END + u % 200)::DOUBLE AS fico_range_high,
    (CASE WHEN k % 7 = 0 THEN NULL ELSE k % 3 END)::DOUBLE AS delinq_2yrs,
    (u % 6)::DOUBLE AS inq_last_6mths,
    (CASE WHEN k % 2 = 0 THEN NULL ELSE k % 80 END)::DOUBLE AS mths_since_last_delinq,
    (CASE WHEN k % 23 = 0 THEN NULL ELSE 1 + u % 20 END)::DOUBLE AS open_acc,
    (k % 4)::DOUBLE AS pub_rec,
    (5 + u % 40)::DOUBLE AS total_acc,
    inst::DOUBLE AS installment, rev::DOUBLE AS revol_bal, d::DOUBLE AS dti,
    CASE WHEN k % 4 < 2 THEN '36 months' ELSE '60 months' END AS term,
    grade AS sub_grade, emp AS emp_length,
    'title ' || (u % 50)::VARCHAR AS emp_title,
    home AS home_ownership, ver AS verification_status,
    lower(substr(pr, 3)) AS purpose,
    CASE WHEN k % 19 = 0 THEN 'y' ELSE 'n' END AS pymnt_plan,
    CASE WHEN k % 2 = 0 THEN 'w' ELSE 'f' END AS initial_list_status,
    status AS loan_status
  FROM loan_parts)"""

_RAW = """
raw_loans AS (
  SELECT k::VARCHAR AS id,
    CASE WHEN k % 97 = 0 THEN NULL ELSE strftime(od, '%b-%Y') END AS issue_d,
    CASE k % 3 WHEN 0 THEN strftime(od, '%b-%Y') WHEN 1 THEN strftime(od, '%Y-%m-%d')
               ELSE 'not-a-date' END AS earliest_cr_line,
    CASE WHEN k % 11 = 0 THEN NULL WHEN k % 29 = 0 THEN '-' || amt::VARCHAR
         ELSE '$' || format('{:,}', amt) END AS loan_amnt,
    amt::VARCHAR AS funded_amnt,
    (5 + u % 25)::VARCHAR || '.5%' AS int_rate,
    (k % 101)::VARCHAR || '%' AS revol_util,
    floor(bal * 10)::BIGINT::VARCHAR AS annual_inc,
    floor(bal * 7)::BIGINT::VARCHAR AS avg_cur_bal,
    floor(price * factor)::BIGINT::VARCHAR AS total_pymnt,
    (CASE WHEN k % 17 = 0 THEN 604 ELSE 600 END + u % 200)::VARCHAR AS fico_range_low,
    (CASE WHEN k % 17 = 0 THEN 600 ELSE 604 END + u % 200)::VARCHAR AS fico_range_high,
    (CASE WHEN k % 7 = 0 THEN NULL ELSE k % 3 END)::VARCHAR AS delinq_2yrs,
    (u % 6)::VARCHAR AS inq_last_6mths,
    (CASE WHEN k % 2 = 0 THEN NULL ELSE k % 80 END)::VARCHAR AS mths_since_last_delinq,
    (CASE WHEN k % 23 = 0 THEN NULL ELSE 1 + u % 20 END)::VARCHAR AS open_acc,
    (k % 4)::VARCHAR AS pub_rec,
    (5 + u % 40)::VARCHAR AS total_acc,
    inst::VARCHAR AS installment, rev::VARCHAR AS revol_bal,
    CASE WHEN k % 53 = 0 THEN 'bad' ELSE d::VARCHAR END AS dti,
    CASE k % 4 WHEN 0 THEN ' 36   months ' WHEN 1 THEN '36 months' WHEN 2 THEN ' 60 months'
               ELSE '60' || chr(9) || 'months' END AS term,
    CASE WHEN k % 6 = 0 THEN ' ' || grade || '  ' ELSE grade END AS sub_grade,
    coalesce(emp, 'nan') AS emp_length,
    CASE WHEN k % 37 = 0 THEN 'None' WHEN k % 31 = 0 THEN ''
         ELSE 'title ' || (u % 50)::VARCHAR END AS emp_title,
    CASE WHEN k % 41 = 0 THEN lower(home) ELSE home END AS home_ownership,
    ver AS verification_status,
    lower(substr(pr, 3)) AS purpose,
    CASE WHEN k % 19 = 0 THEN ' Y ' ELSE 'n' END AS pymnt_plan,
    CASE WHEN k % 2 = 0 THEN 'w' ELSE 'f' END AS initial_list_status,
    coalesce(status, 'null') AS loan_status
  FROM loan_parts, unnest(CASE WHEN k % 50 = 0 THEN [1, 2] ELSE [1] END) AS t(copy))"""

_LABELLED = """
labelled AS (
  SELECT *, CASE
      WHEN lower(trim(loan_status)) IN ('charged off', 'default', 'late (31-120 days)',
        'late (16-30 days)', 'does not meet the credit policy. status:charged off') THEN 1
      WHEN lower(trim(loan_status)) IN ('fully paid',
        'does not meet the credit policy. status:fully paid') THEN 0 END AS target_default
  FROM loans WHERE lower(trim(loan_status)) IS DISTINCT FROM 'current'),
modelled AS (
  SELECT * REPLACE (CASE WHEN loan_status IN ('Fully Paid', 'In Grace Period',
      'Does not meet the credit policy. Status:Fully Paid') THEN 0 ELSE 1 END AS loan_status)
  FROM loans WHERE coalesce(loan_status, '') NOT IN ('Current', 'Default')),
scored AS (
  SELECT id, loan_status AS label, p AS probability, (p > 0.5)::INTEGER AS prediction
  FROM (SELECT *, round(1 / (1 + exp(-((int_rate - 20) * 0.15::DOUBLE
          + (revol_util - 50) * 0.01::DOUBLE))), 3) AS p FROM modelled))"""


def _series(name: str, value: str, left_out: int) -> str:
    return f"""(
  SELECT "Year", "Month", sum(v)::DOUBLE / count(*)::DOUBLE AS "{name}"
  FROM (SELECT year(l_shipdate)::INTEGER AS "Year", month(l_shipdate)::INTEGER AS "Month",
               ({value})::BIGINT AS v FROM lineitem)
  WHERE ("Year" * 12 + "Month") % 10 <> {left_out} GROUP BY "Year", "Month")"""


_INDICATORS = f"""
cpi AS {_series("CPI", "round(l_quantity)", 1)},
unemployment AS {_series("Unemployment Rate", "round(l_discount * 100)", 4)},
fed_funds AS {_series("Federal Funds Rate", "round(l_tax * 100)", 7)},
indicators AS (
  SELECT * FROM cpi FULL JOIN unemployment USING ("Year", "Month")
  FULL JOIN fed_funds USING ("Year", "Month"))"""


def query(body: str, *more: str) -> str:
    """`body` after the loan tables and any further CTEs."""
    ctes = [_KEYS, _LOANS, _RAW, _LABELLED, _INDICATORS, *more]
    return "WITH " + ",".join(ctes) + "\n" + body


def columns(pattern: str, names) -> str:
    """The pattern once per column, `{c}` being the quoted name and `{n}` the text."""
    return ",\n  ".join(pattern.format(c=f'"{c}"', n=c) for c in names)


def stacked(pattern: str, names) -> str:
    return "\nUNION ALL\n".join(pattern.format(c=f'"{c}"', n=c) for c in names)
