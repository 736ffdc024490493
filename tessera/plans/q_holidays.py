"""Holidays from a table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import holidays as hol
from tessera.plans.q_panel import _HOL_SQL
from tessera.plans.registry import query
from tessera.sources import tables

# FIXED VALUES: a table of two regions and all others, with spans that overlap
REGIONAL = [
    hol.yearly("year end", 12, 27, -0.10, priority=5, days=6),
    hol.yearly("new year", 1, 1, -0.15, priority=1),
    hol.yearly("summer", 7, 20, -0.12, priority=3, days=21, region="EUROPE"),
    hol.nth_weekday("late monday", 8, 0, -1, -0.20, priority=2, region="EUROPE"),
    hol.span("festival", dt.date(1996, 2, 17), dt.date(1996, 3, 3), -0.30, priority=2, region="ASIA"),
    hol.span("jubilee", dt.date(1996, 2, 28), dt.date(1996, 2, 29), -0.40, priority=2),
]


@query("holiday_table", _HOL_SQL)
def holiday_table(spark, sf_dir):
    """Order days that the default holiday table covers: the same as the constant rules give."""
    days = tables.read_table(spark, sf_dir, "orders", ["o_orderdate"]).select(F.to_date("o_orderdate").alias(S.DT)).dropna().distinct()
    found = hol.with_holidays(days, hol.table(spark)).where("is_holiday = 1")
    return found.select(S.DT, "holiday_effect", "is_holiday")


@query("regional_holidays", """WITH days AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt, r_name AS region FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderdate IS NOT NULL),
y AS (SELECT CAST(unnest(range(1990, 2005)) AS INTEGER) AS y),
spans AS (
  SELECT 'year end' AS name, NULL AS where_, make_date(y, 12, 27) AS a, make_date(y, 12, 27) + 5 AS b, -0.10 AS effect, 5 AS priority FROM y
  UNION ALL SELECT 'new year', NULL, make_date(y, 1, 1), make_date(y, 1, 1), -0.15, 1 FROM y
  UNION ALL SELECT 'summer', 'EUROPE', make_date(y, 7, 20), make_date(y, 7, 20) + 20, -0.12, 3 FROM y
  UNION ALL SELECT 'late monday', 'EUROPE', d, d, -0.20, 2 FROM (SELECT max(d) AS d FROM (
      SELECT y, make_date(y, 8, CAST(k AS INTEGER)) AS d FROM y, range(1, 32) AS t(k)) WHERE isodow(d) = 1 GROUP BY y)
  UNION ALL SELECT 'festival', 'ASIA', DATE '1996-02-17', DATE '1996-03-03', -0.30, 2
  UNION ALL SELECT 'jubilee', NULL, DATE '1996-02-28', DATE '1996-02-29', -0.40, 2)
SELECT dt, region, name AS holiday, CAST(effect AS DOUBLE) AS holiday_effect
FROM days JOIN spans ON dt BETWEEN a AND b AND (where_ IS NULL OR where_ = region)
QUALIFY row_number() OVER (PARTITION BY dt, region ORDER BY priority, where_ IS NULL, name) = 1""")
def regional_holidays(spark, sf_dir):
    """Order days of the customers' regions that a table with regions, spans and priorities covers."""
    days = tables.region_observations(spark, sf_dir).select(S.DT, F.col(S.SERIES).alias("region"))
    return hol.of_days(days, hol.table(spark, REGIONAL), "region")
