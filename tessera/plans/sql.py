"""SQL building blocks for the DuckDB oracle texts.

These texts are an independent statement of each query for the correctness
check; they are not used to run anything on Spark.
"""

from __future__ import annotations

from tessera import schema as S

SERIES_NAME_SQL = "lower(regexp_replace({s}, '^[0-9]+-', ''))"


def panel_ctes(table: str = "orders", series: str = "o_orderpriority",
               ts: str = "o_orderdate", value: str = "o_totalprice",
               start: str | None = None, end: str | None = None) -> str:
    """CTEs daily, bounds, spine, panel(series_id, series_name, dt, y)."""
    where = [f"{series} IS NOT NULL", f"{ts} IS NOT NULL"]
    if start:
        where.append(f"CAST({ts} AS DATE) >= DATE '{start}'")
    if end:
        where.append(f"CAST({ts} AS DATE) <= DATE '{end}'")
    lo = f"DATE '{start}'" if start else "MIN(dt)"
    hi = f"DATE '{end}'" if end else "MAX(dt)"
    name = SERIES_NAME_SQL.format(s="sp.series_id")
    return f"""daily AS (
  SELECT {series} AS series_id, CAST({ts} AS DATE) AS dt,
         SUM(CAST({value} AS DECIMAL(18,2))) AS y_raw
  FROM {table} WHERE {' AND '.join(where)} GROUP BY 1, 2),
bounds AS (SELECT {lo} AS lo, {hi} AS hi FROM daily),
spine AS (
  SELECT s.series_id, CAST(unnest(generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dt
  FROM (SELECT DISTINCT series_id FROM daily) s CROSS JOIN bounds b),
panel AS (
  SELECT sp.series_id, {name} AS series_name, sp.dt,
         CAST(floor(greatest(coalesce(d.y_raw, 0), {S.Y_FLOOR})) AS BIGINT) AS y
  FROM spine sp LEFT JOIN daily d ON d.series_id = sp.series_id AND d.dt = sp.dt)"""


def holiday_effect_sql(dt: str = "dt") -> str:
    fixed = " OR ".join(f"(month({dt}) = {m} AND day({dt}) = {d})" for m, d in S.FIXED_HOLIDAYS)
    return (f"(CASE WHEN {fixed} THEN {S.FIXED_HOLIDAY_EFFECT} "
            f"WHEN month({dt}) = 11 AND isodow({dt}) = 4 AND floor((day({dt}) - 1) / 7) + 1 = 4 "
            f"THEN {S.THANKSGIVING_EFFECT} ELSE 0.0 END)")


def calendar_sql(dt: str = "dt") -> dict[str, str]:
    return {
        "year": f"CAST(year({dt}) AS INTEGER)",
        "month": f"CAST(month({dt}) AS INTEGER)",
        "day_of_year": f"CAST(dayofyear({dt}) AS INTEGER)",
        "day_of_week": f"CAST(isodow({dt}) - 1 AS INTEGER)",
        "is_weekend": f"CAST(CASE WHEN isodow({dt}) >= 6 THEN 1 ELSE 0 END AS INTEGER)",
        "is_holiday": f"CAST(CASE WHEN {holiday_effect_sql(dt)} < 0 THEN 1 ELSE 0 END AS INTEGER)",
        "quarter": f"CAST(quarter({dt}) AS INTEGER)",
        "week_of_year": f"CAST(weekofyear({dt}) AS INTEGER)",
    }


def cyclic_sql(digits: int | None = None, dt: str = "dt") -> dict[str, str]:
    cal = calendar_sql(dt)
    out = {}
    for name, period in S.CYCLIC_PERIODS:
        for fn in ("sin", "cos"):
            e = f"{fn}(2 * pi() * {cal[name]} / {period})"
            out[f"{name}_{fn}"] = f"round({e}, {digits})" if digits is not None else e
    return out


def window_sql(y: str = "y", digits: int | None = 4, leak_free: bool = False) -> dict[str, str]:
    """Lag and rolling columns over PARTITION BY series_id ORDER BY dt."""
    part = "PARTITION BY series_id ORDER BY dt"
    r = (lambda e: f"round({e}, {digits})") if digits is not None else (lambda e: e)
    out = {}
    for k in S.LAGS + [S.YEAR_LAG]:
        out[f"y_lag_{k}"] = f"CAST(lag({y}, {k}) OVER ({part}) AS DOUBLE)"
    hi = 1 if leak_free else 0
    end = "1 PRECEDING" if leak_free else "CURRENT ROW"
    for n in S.ROLLING_WINDOWS:
        frame = f"({part} ROWS BETWEEN {n - 1 + hi} PRECEDING AND {end})"
        out[f"y_rolling_mean_{n}"] = r(f"avg({y}) OVER {frame}")
        out[f"y_rolling_std_{n}"] = r(f"stddev_samp({y}) OVER {frame}")
    n = S.MINMAX_WINDOW
    frame = f"({part} ROWS BETWEEN {n - 1 + hi} PRECEDING AND {end})"
    out[f"y_rolling_min_{n}"] = f"CAST(min({y}) OVER {frame} AS DOUBLE)"
    out[f"y_rolling_max_{n}"] = f"CAST(max({y}) OVER {frame} AS DOUBLE)"
    return out


def features_cte(source: str = "panel", digits_cyclic: int = 6, digits_roll: int = 4) -> str:
    """CTE ``feat``: panel keys + 29 features in model order."""
    cols = {}
    cols.update(calendar_sql())
    cols.update(cyclic_sql(digits_cyclic))
    cols.update(window_sql(digits=digits_roll))
    sel = ",\n    ".join(f"{cols[n]} AS {n}" for n in S.FEATURE_NAMES)
    return f"""feat AS (
  SELECT series_id, series_name, dt, y,
    {sel}
  FROM {source})"""


def not_null_all(cols: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def rsig(e: str, digits: int = 10) -> str:
    """SQL twin of registry.round_sig."""
    return (f"(CASE WHEN ({e}) IS NULL OR ({e}) = 0 OR isnan({e}) OR isinf({e}) THEN ({e}) "
            f"ELSE round(({e}) / pow(10.0, floor(log10(abs({e})))), {digits - 1}) "
            f"* pow(10.0, floor(log10(abs({e})))) END)")


NAIVE_MODELS = {"naive_lag_1": "y_lag_1", "naive_lag_7": "y_lag_7",
                "naive_lag_365": "y_lag_365", "smoother_mean_7": "y_rolling_mean_7"}


def preds_ctes(processed: bool = True) -> str:
    """panel, feat, proc and the long naive-forecast table ``preds``."""
    where = f"WHERE {not_null_all(S.FEATURE_NAMES)}" if processed else ""
    union = "\n  UNION ALL ".join(
        f"SELECT '{m}' AS model, series_id, dt, CAST(y AS DOUBLE) AS y, CAST({c} AS DOUBLE) AS yhat FROM proc"
        for m, c in NAIVE_MODELS.items())
    return f"""{panel_ctes()},
{features_cte(digits_cyclic=None, digits_roll=None)},
proc AS (SELECT * FROM feat {where}),
preds AS ({union})"""


def metrics_ctes() -> str:
    """pm (point metrics), da (directional accuracy, concatenated order), met (both)."""
    return """pm AS (
  SELECT model, count(*) AS n,
    avg((y - yhat) * (y - yhat)) AS MSE,
    avg(abs(y - yhat)) AS MAE,
    avg(abs((y - yhat) / y)) * 100 AS MAPE,
    median(abs((y - yhat) / y)) * 100 AS MAPE_Median,
    sum((y - yhat) * (y - yhat)) AS sse,
    var_pop(y) * count(y) AS sst,
    sum(y * y) AS syy
  FROM preds GROUP BY model),
dl AS (
  SELECT model, y, yhat,
    lag(y) OVER (PARTITION BY model ORDER BY series_id, dt) AS py,
    lag(yhat) OVER (PARTITION BY model ORDER BY series_id, dt) AS pyhat
  FROM preds),
da AS (
  SELECT model,
    CASE WHEN count(py) > 0 THEN
      CAST(sum(CASE WHEN py IS NOT NULL AND ((y - py > 0) = (yhat - pyhat > 0)) THEN 1 ELSE 0 END) AS DOUBLE) / count(py)
    ELSE 0.0 END AS Directional_Accuracy
  FROM dl GROUP BY model),
met AS (
  SELECT pm.model, pm.n, MSE, sqrt(MSE) AS RMSE, MAE, MAPE, MAPE_Median,
    CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 - sse / sst END AS R2,
    da.Directional_Accuracy,
    CASE WHEN syy = 0 THEN CAST('inf' AS DOUBLE) ELSE sqrt(sse) / sqrt(syy) END AS Theil_U
  FROM pm LEFT JOIN da ON pm.model = da.model)"""
