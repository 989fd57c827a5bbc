"""Shared pieces of the registered queries and of their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The junction view and the reference day, as DuckDB SQL.
JOB_SKILLS_SQL = """
WITH jsv AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS job_id, CAST(o_orderdate AS DATE) AS posted_date, n_name AS country,
         l_extendedprice AS salary_mid_usd, p_brand AS skill,
         CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
ref AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders)
"""

#: Weekly rows per skill, and per skill and country.
WEEKLY_SQL = JOB_SKILLS_SQL + """,
wk AS (
  SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, CAST(count(*) AS BIGINT) AS job_count,
         avg(salary_mid_usd) AS avg_salary
  FROM jsv GROUP BY ALL
),
wkc AS (
  SELECT skill, CAST(date_trunc('week', posted_date) AS DATE) AS week, country, CAST(count(*) AS BIGINT) AS job_count,
         avg(salary_mid_usd) AS avg_salary
  FROM jsv GROUP BY ALL
)
"""


#: Brands grouped so that the category lookups of the generated data hit several branches.
BRAND_GROUPS = {
    "Languages": ("Brand#1", "Brand#2", "Brand#3", "Brand#4"),
    "Databases": ("Brand#5", "Brand#6", "Brand#7"),
    "Cloud & Infra": ("Brand#10", "Brand#11", "Brand#12", "Brand#13", "Brand#14"),
}


def category_sql(column: str, groups: dict[str, tuple[str, ...]] | None = None, default: str = "Other") -> str:
    cases = " ".join(
        f"WHEN {column} IN ({', '.join(repr(m) for m in members)}) THEN '{name}'"
        for name, members in (groups or BRAND_GROUPS).items()
    )
    return f"CASE {cases} ELSE '{default}' END"


def _digits(name: str) -> int:
    """Amounts of money are sums of cents over counts, compared to six digits; ratios to nine."""
    return 6 if "salary" in name and "growth" not in name else 9


def _nudge(name: str) -> float:
    """Added before rounding: means over 2, 4, 8, ... rows lie exactly between two steps, and this decides them alike."""
    return float(f"3e-{_digits(name) + 2}")


def rounded(df: DataFrame) -> DataFrame:
    """Round doubles so that two engines that add in another order agree; -0.0 becomes 0.0."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column + F.lit(_nudge(field.name)), _digits(field.name)) + F.lit(0.0)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def r(expression: str, alias: str | None = None) -> str:
    """The SQL counterpart of :func:`rounded` for one column."""
    name = alias or expression
    return f"round(({expression}) + {_nudge(name)!r}, {_digits(name)}) + 0.0 AS {name}"
