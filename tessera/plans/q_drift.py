"""Drift of the panel's values and change points."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import drift
from tessera.plans import sql as Q
from tessera.plans.common import orders_panel
from tessera.plans.registry import query, round_doubles
from tessera.session import shared_path
from tessera.tables import reliable


@query("input_drift", f"""WITH {Q.panel_ctes()},
r AS (SELECT series_id, CAST(y AS DOUBLE) AS y, CAST(date_trunc('month', dt) AS DATE) AS own FROM panel),
sent AS (SELECT m.series_id, m.month, r.y, CAST(r.own = m.month AS INTEGER) AS now, CAST(r.own < m.month AS INTEGER) AS ref
         FROM (SELECT DISTINCT series_id, own AS month FROM r) m
         JOIN r ON r.series_id = m.series_id AND r.own BETWEEN m.month - INTERVAL 12 MONTH AND m.month),
c AS (SELECT *, sum(now) OVER g AS n, sum(ref) OVER g AS ref_n, sum(now) OVER o AS below, sum(ref) OVER o AS ref_below,
             sum(ref) OVER (PARTITION BY series_id, month, y) AS ref_here
      FROM sent WINDOW g AS (PARTITION BY series_id, month), o AS (PARTITION BY series_id, month ORDER BY y)),
ks AS (SELECT series_id, month, n, ref_n, max(abs(below / n - ref_below / ref_n)) AS ks FROM c WHERE ref_n > 0 GROUP BY ALL),
t AS (SELECT series_id, month, least(floor((ref_below - ref_here) * 10 / ref_n), 9) AS tenth,
             greatest(sum(now) / any_value(n), 1e-4) AS p, greatest(sum(ref) / any_value(ref_n), 1e-4) AS q
      FROM c WHERE ref_n > 0 GROUP BY ALL),
psi AS (SELECT series_id, month, sum((p - q) * ln(p / q)) AS psi FROM t GROUP BY ALL)
SELECT series_id, month, CAST(a.n AS BIGINT) AS n, CAST(a.ref_n AS BIGINT) AS ref_n, round(psi, 8) AS psi, round(ks, 8) AS ks,
       CASE WHEN a.ref_n > 0 THEN round(1.358 * sqrt((a.n + a.ref_n) / (a.n * a.ref_n)), 8) END AS ks_limit
FROM (SELECT DISTINCT series_id, month, n, ref_n FROM c) a LEFT JOIN ks USING (series_id, month) LEFT JOIN psi USING (series_id, month)""")
def input_drift(spark, sf_dir):
    """Every month of a series against the twelve before it: stability index over tenths and Kolmogorov–Smirnov distance."""
    return round_doubles(drift.monthly_drift(orders_panel(spark, sf_dir)), 8)


@query("input_drift_sketch")
def input_drift_sketch(spark, sf_dir):
    """The same from quantile sketches per series and month, written to a table and merged from there."""
    path = shared_path(spark, f"sketches-{uuid.uuid4().hex}")
    drift.month_sketches(orders_panel(spark, sf_dir)).write.parquet(path)
    return drift.sketch_drift(spark.read.parquet(path))


@query("sketch_ranges", f"""WITH {Q.panel_ctes()}
SELECT series_id, count(*) AS n, CAST(min(y) AS DOUBLE) AS least, CAST(max(y) AS DOUBLE) AS most FROM panel
WHERE dt BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY series_id""")
def sketch_ranges(spark, sf_dir):
    """Two years of every series answered from the month sketches (their exact parts)."""
    sketches = reliable(drift.month_sketches(orders_panel(spark, sf_dir)))
    return drift.range_quantiles(sketches, "1996-01-01", "1997-12-01").select(S.SERIES, "n", "least", "most")


@query("change_points", f"""WITH RECURSIVE {Q.panel_ctes()},
r AS (SELECT series_id, dt, CAST(y AS DOUBLE) AS y, row_number() OVER (PARTITION BY series_id ORDER BY dt) AS j FROM panel),
walk AS (
  SELECT DISTINCT series_id, CAST(0 AS BIGINT) AS i, 0 AS n, CAST(0 AS DOUBLE) AS mean, CAST(0 AS DOUBLE) AS m2, CAST(0 AS DOUBLE) AS hi,
         CAST(0 AS DOUBLE) AS lo, CAST(NULL AS DATE) AS hi_dt, CAST(NULL AS DATE) AS lo_dt, CAST(NULL AS DATE) AS change_dt,
         CAST(NULL AS DATE) AS alarm_dt, CAST(NULL AS VARCHAR) AS direction, CAST(NULL AS DOUBLE) AS baseline, CAST(NULL AS DOUBLE) AS deviation
  FROM r
  UNION ALL
  SELECT series_id, j, CASE WHEN learn THEN n + 1 WHEN alarm THEN 0 ELSE n END,
         CASE WHEN learn THEN new_mean WHEN alarm THEN 0 ELSE mean END,
         CASE WHEN learn THEN m2 + (y - mean) * (y - new_mean) WHEN alarm THEN 0 ELSE m2 END,
         CASE WHEN learn OR alarm THEN 0 ELSE hi1 END, CASE WHEN learn OR alarm THEN 0 ELSE lo1 END,
         CASE WHEN NOT learn AND NOT alarm THEN hi_on END, CASE WHEN NOT learn AND NOT alarm THEN lo_on END,
         CASE WHEN alarm THEN CASE WHEN hi1 > 8 THEN hi_on ELSE lo_on END END, CASE WHEN alarm THEN dt END,
         CASE WHEN alarm THEN CASE WHEN hi1 > 8 THEN 'up' ELSE 'down' END END, CASE WHEN alarm THEN mean END, CASE WHEN alarm THEN dev END
  FROM (SELECT *, NOT learn AND (hi1 > 8 OR lo1 > 8) AS alarm, CASE WHEN hi1 > 0 THEN CASE WHEN hi > 0 THEN hi_dt ELSE dt END END AS hi_on,
               CASE WHEN lo1 > 0 THEN CASE WHEN lo > 0 THEN lo_dt ELSE dt END END AS lo_on
        FROM (SELECT *, greatest(hi + z - 0.5, 0) AS hi1, greatest(lo - z - 0.5, 0) AS lo1
              FROM (SELECT *, CASE WHEN learn THEN 0 WHEN dev > 0 THEN (y - mean) / dev ELSE sign(y - mean) * 9.5 END AS z
                    FROM (SELECT w.series_id, w.n, w.mean, w.m2, w.hi, w.lo, w.hi_dt, w.lo_dt, r.j, r.dt, r.y, w.n < 60 AS learn,
                                 w.mean + (r.y - w.mean) / (w.n + 1) AS new_mean, sqrt(w.m2 / greatest(w.n - 1, 1)) AS dev
                          FROM walk w JOIN r ON r.series_id = w.series_id AND r.j = w.i + 1)))))
SELECT series_id, change_dt, alarm_dt, direction, round(baseline, 4) AS baseline, round(deviation, 4) AS deviation
FROM walk WHERE alarm_dt IS NOT NULL""")
def change_points(spark, sf_dir):
    """Days on which a series' level changed: a two-sided CUSUM per series, with a new baseline after each alarm."""
    return round_doubles(drift.change_points(orders_panel(spark, sf_dir)), 4)
