"""Profiling and chart-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import panel as pnl
from tessera.operators import profile as prof
from tessera.plans import sql as Q
from tessera.plans.common import orders_features, orders_panel, orders_processed
from tessera.plans.registry import query, round_doubles, round_sig_cols
from tessera.sources import tables

_P = f"WITH {Q.panel_ctes()}"


@query("data_summary", f"""{_P}
SELECT count(*) AS n_rows, strftime(min(dt), '%Y-%m-%d') AS first_dt, strftime(max(dt), '%Y-%m-%d') AS last_dt,
  count(DISTINCT series_id) AS n_series,
  {Q.rsig('avg(y)')} AS y_mean, {Q.rsig('stddev_samp(y)')} AS y_std, CAST(min(y) AS DOUBLE) AS y_min,
  CAST(max(y) AS DOUBLE) AS y_max, {Q.rsig('median(CAST(y AS DOUBLE))')} AS y_median
FROM panel""")
def data_summary(spark, sf_dir):
    """Rows, date range, series count, mean / std / min / max / exact median of y."""
    return round_sig_cols(prof.data_summary(orders_panel(spark, sf_dir)), ["y_mean", "y_std", "y_median"])


_NULL_SQL = f"""WITH {Q.panel_ctes()},
{Q.features_cte(digits_cyclic=None, digits_roll=None)}
SELECT column_name, CAST(position AS INTEGER) AS position, null_count FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS column_name, {i} AS position, count(*) - count({c}) AS null_count FROM feat"
                      for i, c in enumerate(['series_id', 'series_name', 'dt', 'y'] + S.FEATURE_NAMES))})"""


@query("null_counts", _NULL_SQL)
def null_counts(spark, sf_dir):
    """Missing values per column of the undropped feature panel (one pass)."""
    return prof.null_counts(orders_features(spark, sf_dir))


@query("kpi_slice", f"""{_P}
SELECT {Q.rsig('avg(y)')} AS y_mean, CAST(max(y) AS DOUBLE) AS y_max, CAST(min(y) AS DOUBLE) AS y_min,
  {Q.rsig('stddev_samp(y)')} AS y_std, count(*) AS n_rows
FROM panel WHERE series_id = '3-MEDIUM' AND dt BETWEEN DATE '1997-01-01' AND DATE '1999-06-30'""")
def kpi_slice(spark, sf_dir):
    """KPIs of a selected series and date range."""
    sl = pnl.filter_series_range(orders_panel(spark, sf_dir), "3-MEDIUM", "1997-01-01", "1999-06-30")
    return round_sig_cols(prof.kpis(sl), ["y_mean", "y_std"])


@query("monthly_profile", f"{_P} SELECT CAST(month(dt) AS INTEGER) AS month, {Q.rsig('avg(y)')} AS y_mean, count(*) AS n_rows FROM panel GROUP BY 1")
def monthly_profile(spark, sf_dir):
    return round_sig_cols(prof.monthly_profile(orders_panel(spark, sf_dir)), ["y_mean"])


@query("weekday_profile", f"{_P} SELECT CAST(isodow(dt) - 1 AS INTEGER) AS day_of_week, {Q.rsig('avg(y)')} AS y_mean, count(*) AS n_rows FROM panel GROUP BY 1")
def weekday_profile(spark, sf_dir):
    return round_sig_cols(prof.weekday_profile(orders_panel(spark, sf_dir)), ["y_mean"])


@query("year_month_trend", f"""{_P}
SELECT CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month, {Q.rsig('avg(y)')} AS y_mean,
  make_date(CAST(year(dt) AS INTEGER), CAST(month(dt) AS INTEGER), 1) AS month_start
FROM panel GROUP BY 1, 2""")
def year_month_trend(spark, sf_dir):
    return round_sig_cols(prof.year_month_trend(orders_panel(spark, sf_dir)), ["y_mean"])


@query("trend_grouping_sets", f"""{_P},
b AS (SELECT series_id, CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month, y FROM panel)
SELECT series_id, year, month, {Q.rsig('avg(y)')} AS y_mean, CAST(grouping(series_id) AS INTEGER) AS is_overall,
  make_date(year, month, 1) AS month_start
FROM b GROUP BY GROUPING SETS ((year, month), (series_id, year, month))""")
def trend_grouping_sets(spark, sf_dir):
    """Year-month means overall and per series in one GROUPING SETS aggregation."""
    return round_sig_cols(prof.trend_grouping_sets(orders_panel(spark, sf_dir)), ["y_mean"])


@query("series_profile", f"""{_P}
SELECT series_id, series_name, CAST(round_even(avg(y), 0) AS DOUBLE) AS mean_y,
  CAST(round_even(stddev_samp(y), 0) AS DOUBLE) AS std_y, min(y) AS min_y, max(y) AS max_y
FROM panel GROUP BY 1, 2""")
def series_profile(spark, sf_dir):
    """Per-series mean / std / min / max, half-even rounded."""
    return prof.series_profile(orders_panel(spark, sf_dir))


_CORR_COLS = [S.Y] + S.FEATURE_NAMES


def _corr_sql(lower_only: bool) -> str:
    cols = _CORR_COLS
    aggs = [f"stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            aggs.append(f"covar_pop(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) AS c{i}_{j}")
    rows = []
    for i in range(len(cols)):
        if not lower_only:
            rows.append(f"SELECT '{cols[i]}' AS col_a, {i} AS pos_a, '{cols[i]}' AS col_b, {i} AS pos_b, "
                        f"CASE WHEN s{i} = 0 THEN NULL ELSE 1.0 END AS corr FROM m")
        for j in range(i + 1, len(cols)):
            r = f"CASE WHEN s{i} * s{j} = 0 THEN NULL ELSE c{i}_{j} / (s{i} * s{j}) END"
            rows.append(f"SELECT '{cols[j]}' AS col_a, {j} AS pos_a, '{cols[i]}' AS col_b, {i} AS pos_b, {r} AS corr FROM m")
            if not lower_only:
                rows.append(f"SELECT '{cols[i]}', {i}, '{cols[j]}', {j}, {r} FROM m")
    return f"""WITH {Q.panel_ctes()},
{Q.features_cte(digits_cyclic=None, digits_roll=None)},
proc AS (SELECT * FROM feat WHERE {Q.not_null_all(S.FEATURE_NAMES)}),
m AS (SELECT {', '.join(aggs)} FROM proc),
u AS ({' UNION ALL '.join(rows)})
SELECT col_a, CAST(pos_a AS INTEGER) AS pos_a, col_b, CAST(pos_b AS INTEGER) AS pos_b, round(corr, 6) AS corr FROM u"""


@query("corr_matrix", _corr_sql(False))
def corr_matrix(spark, sf_dir):
    """Pearson correlation matrix of y and the 29 features (long form, 900 cells)."""
    return round_doubles(prof.corr_matrix(orders_processed(spark, sf_dir), _CORR_COLS), 6)


def _corr_nullable_sql() -> str:
    cols, rows = _CORR_COLS, []
    aggs = [f"stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(cols)]
    for i, a in enumerate(cols):
        rows.append(f"SELECT '{a}' AS col_a, {i} AS pos_a, '{a}' AS col_b, {i} AS pos_b, "
                    f"CASE WHEN s{i} = 0 THEN NULL ELSE 1.0 END AS corr FROM m")
        for j in range(i + 1, len(cols)):
            aggs.append(f"corr(CAST({a} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) AS c{i}_{j}")
            r = f"CASE WHEN isnan(c{i}_{j}) THEN NULL ELSE c{i}_{j} END"
            rows.append(f"SELECT '{cols[j]}', {j}, '{a}', {i}, {r} FROM m")
            rows.append(f"SELECT '{a}', {i}, '{cols[j]}', {j}, {r} FROM m")
    return f"""WITH {Q.panel_ctes()},
{Q.features_cte(digits_cyclic=None, digits_roll=None)},
m AS (SELECT {', '.join(aggs)} FROM feat),
u AS ({' UNION ALL '.join(rows)})
SELECT col_a, CAST(pos_a AS INTEGER) AS pos_a, col_b, CAST(pos_b AS INTEGER) AS pos_b, round(corr, 6) AS corr FROM u"""


@query("corr_matrix_nullable", _corr_nullable_sql())
def corr_matrix_nullable(spark, sf_dir):
    """Correlations of the panel before incomplete rows are dropped: every pair over the rows
    that have both values."""
    return round_doubles(prof.corr_matrix(orders_features(spark, sf_dir), _CORR_COLS), 6)


@query("corr_lower_triangle", _corr_sql(True))
def corr_lower_triangle(spark, sf_dir):
    """Heat-map cells below the diagonal (upper triangle and diagonal masked)."""
    return round_doubles(prof.lower_triangle(prof.corr_matrix(orders_processed(spark, sf_dir), _CORR_COLS)), 6)


@query("recent_rows_global", f"{_P} SELECT * FROM panel ORDER BY dt DESC, series_id LIMIT 30")
def recent_rows_global(spark, sf_dir):
    """Last 30 rows of the whole panel by date (ties by series id) - top-k, the limit is the feature."""
    return prof.recent_rows_global(orders_panel(spark, sf_dir), 30)


@query("recent_rows_series", f"{_P} SELECT * FROM panel WHERE series_id = '5-LOW' ORDER BY dt DESC LIMIT 30")
def recent_rows_series(spark, sf_dir):
    """Last 30 rows of one series."""
    return prof.recent_rows_series(orders_panel(spark, sf_dir), "5-LOW", 30)


_PARAMS_SQL = f"""{Q.panel_ctes()},
yr AS (SELECT series_id, year(dt) AS year, avg(y) AS ym FROM panel GROUP BY 1, 2),
fl AS (SELECT series_id, min(year) AS y0, max(year) AS y1, arg_min(ym, year) AS base_level, arg_max(ym, year) AS last_level FROM yr GROUP BY 1),
mo AS (SELECT series_id, month(dt) AS month, avg(y) AS mm FROM panel GROUP BY 1, 2),
ov AS (SELECT series_id, series_name, avg(y) AS overall FROM panel GROUP BY 1, 2),
se AS (SELECT mo.series_id, ov.series_name, stddev_pop(mm / overall) * sqrt(2.0) AS seasonal_factor FROM mo JOIN ov ON mo.series_id = ov.series_id GROUP BY 1, 2),
params AS (SELECT fl.series_id, se.series_name, CAST(y0 AS INTEGER) AS start_year, base_level,
  CASE WHEN y1 > y0 THEN pow(last_level / base_level, 1.0 / (y1 - y0)) - 1 ELSE 0.0 END AS growth_rate, seasonal_factor
  FROM fl JOIN se ON fl.series_id = se.series_id)"""


@query("series_dim", f"""WITH {_PARAMS_SQL}
SELECT series_id, series_name, start_year, {Q.rsig('base_level')} AS base_level, {Q.rsig('growth_rate')} AS growth_rate,
  {Q.rsig('seasonal_factor')} AS seasonal_factor FROM params""")
def series_dim(spark, sf_dir):
    """Series dimension estimated from the data: start year, base level, growth, seasonality."""
    p = prof.series_parameters(orders_panel(spark, sf_dir))
    return round_sig_cols(p.withColumn("start_year", F.col("start_year").cast("int")),
                          ["base_level", "growth_rate", "seasonal_factor"])


_EXP = (f"base_level * pow(1 + growth_rate, year(p.dt) - start_year) * (1 + sin(2 * pi() * dayofyear(p.dt) / 365.25) * seasonal_factor"
        f" + CASE WHEN isodow(p.dt) >= 6 THEN 0.05 ELSE 0.0 END + {Q.holiday_effect_sql('p.dt')})")


@query("expected_volume", f"""WITH {_PARAMS_SQL}
SELECT p.series_id, p.dt, p.y, round({_EXP}, 2) AS expected_y, round(p.y / ({_EXP}), 6) AS ratio
FROM panel p JOIN params q ON p.series_id = q.series_id""")
def expected_volume(spark, sf_dir):
    """Noise-free expected level per row (growth x season x weekend x holiday) vs observed."""
    panel = orders_panel(spark, sf_dir)
    out = prof.expected_volume(panel, prof.series_parameters(panel))
    return out.withColumns({"expected_y": F.round("expected_y", 2), "ratio": F.round("ratio", 6)})


@query("quality_checks", """WITH o AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS dt, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderdate IS NOT NULL),
k AS (SELECT series_id, dt, count(*) AS k, sum(CASE WHEN amount IS NULL THEN 1 ELSE 0 END) AS nulls,
  sum(CASE WHEN amount < 0 THEN 1 ELSE 0 END) AS low FROM o GROUP BY 1, 2)
SELECT series_id, CAST(sum(k) AS BIGINT) AS n_rows, CAST(sum(nulls) AS BIGINT) AS null_values,
  CAST(sum(low) AS BIGINT) AS below_range, CAST(0 AS BIGINT) AS above_range,
  CAST(sum(k - 1) AS BIGINT) AS duplicate_rows,
  CAST(date_diff('day', min(dt), max(dt)) + 1 - count(*) AS BIGINT) AS missing_days
FROM k GROUP BY 1""")
def quality_checks(spark, sf_dir):
    """Data-quality counts per series on the raw order observations (missing values,
    negatives, rows sharing a day, days without orders)."""
    obs = tables.orders_observations(spark, sf_dir)
    return prof.quality_checks(obs.where(F.col(S.SERIES).isNotNull() & F.col(S.DT).isNotNull()))


@query("region_panel", f"""WITH {Q.panel_ctes(table="(SELECT r_name, o_orderdate, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)", series="r_name")}
SELECT series_id, dt, y FROM panel""")
def region_panel(spark, sf_dir):
    """Daily order value per customer region (orders -> customer -> nation -> region), gap-filled."""
    p = pnl.build_panel(tables.region_observations(spark, sf_dir), materialise_daily=True)
    return p.select(S.SERIES, S.DT, S.Y)
