"""Panel and feature queries (sources, windows, calendar, cleaning)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.functions import calendar as cal
from tessera.operators import clean, features as feat, panel as pnl
from tessera.plans import sql as Q
from tessera.plans.common import orders_features, orders_panel, orders_processed
from tessera.plans.registry import query, round_doubles
from tessera.session import shared_path
from tessera.sources import io, tables

_CYC6 = {c: 6 for c in S.CYCLIC_COLS}

_PROCESSED_SQL = f"""WITH {Q.panel_ctes()},
{Q.features_cte()}
SELECT * FROM feat WHERE {Q.not_null_all(S.FEATURE_NAMES)}"""


@query("processed_panel", _PROCESSED_SQL)
def processed_panel(spark, sf_dir):
    """Flagship: dense panel + 29 features, warm-up rows dropped."""
    return round_doubles(orders_processed(spark, sf_dir), 4, _CYC6)


@query("panel_dense", f"WITH {Q.panel_ctes()} SELECT * FROM panel")
def panel_dense(spark, sf_dir):
    return orders_panel(spark, sf_dir)


# --- windows -----------------------------------------------------------------

_KEYS = [S.SERIES, S.DT, S.Y]
_W = Q.window_sql()


def _sel(cols):
    return ", ".join(f"{_W[c]} AS {c}" for c in cols)


@query("lag_features", f"WITH {Q.panel_ctes()} SELECT series_id, dt, y, {_sel(S.LAG_COLS)} FROM panel")
def lag_features(spark, sf_dir):
    """Lags 1, 7, 14, 30 and 365 rows per series."""
    return orders_panel(spark, sf_dir).select(*_KEYS, *feat.lag_columns().values()) \
        .toDF(*_KEYS, *S.LAG_COLS)


_MEANS = [f"y_rolling_mean_{n}" for n in S.ROLLING_WINDOWS]
_STDS = [f"y_rolling_std_{n}" for n in S.ROLLING_WINDOWS]
_MINMAX = ["y_rolling_min_30", "y_rolling_max_30"]


def _rolling(spark, sf_dir, names):
    cols = feat.rolling_columns()
    return round_doubles(orders_panel(spark, sf_dir).select(*_KEYS, *[cols[n].alias(n) for n in names]))


@query("rolling_mean", f"WITH {Q.panel_ctes()} SELECT series_id, dt, y, {_sel(_MEANS)} FROM panel")
def rolling_mean(spark, sf_dir):
    """Rolling means over 7/14/30/90 rows, current row included, >= 1 value."""
    return _rolling(spark, sf_dir, _MEANS)


@query("rolling_std", f"WITH {Q.panel_ctes()} SELECT series_id, dt, y, {_sel(_STDS)} FROM panel")
def rolling_std(spark, sf_dir):
    """Rolling sample std; null while the frame holds a single value."""
    return _rolling(spark, sf_dir, _STDS)


@query("rolling_minmax", f"WITH {Q.panel_ctes()} SELECT series_id, dt, y, {_sel(_MINMAX)} FROM panel")
def rolling_minmax(spark, sf_dir):
    return _rolling(spark, sf_dir, _MINMAX)


def _full_sql(n: int, bands: bool) -> str:
    """Full-window rolling mean / std over ``n`` rows (null until n values), optional bands."""
    frame = f"(PARTITION BY series_id ORDER BY dt ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    cols = [f"round(CASE WHEN n >= {n} THEN m END, 4) AS rolling_mean_{n}",
            f"round(CASE WHEN n >= {n} THEN s END, 4) AS rolling_std_{n}"]
    if bands:
        cols += [f"round(CASE WHEN n >= {n} THEN m + s END, 4) AS upper_band",
                 f"round(CASE WHEN n >= {n} THEN m - s END, 4) AS lower_band"]
    return f"""WITH {Q.panel_ctes()},
r AS (SELECT series_id, dt, y, count(y) OVER {frame} AS n, avg(y) OVER {frame} AS m,
  stddev_samp(y) OVER {frame} AS s FROM panel)
SELECT series_id, dt, y, {', '.join(cols)} FROM r"""


@query("rolling_bands", _full_sql(30, bands=True))
def rolling_bands(spark, sf_dir):
    """Full-window rolling mean/std (30 rows) and the mean +/- std band."""
    df = feat.rolling_bands(orders_panel(spark, sf_dir), 30)
    return round_doubles(df.select(*_KEYS, "rolling_mean_30", "rolling_std_30",
                                   "upper_band", "lower_band"))


@query("rolling_full_window", _full_sql(7, bands=False))
def rolling_full_window(spark, sf_dir):
    """pandas-default rolling (min_periods = window): null until 7 values exist."""
    cols = feat.rolling_full_window(S.Y, 7)
    return round_doubles(orders_panel(spark, sf_dir).select(*_KEYS, *[v.alias(k) for k, v in cols.items()]))


# --- calendar ----------------------------------------------------------------
_CAL = Q.calendar_sql()
_CAL6 = ["year", "month", "day_of_year", "day_of_week", "quarter", "week_of_year"]


@query("calendar_features", f"WITH {Q.panel_ctes()} SELECT series_id, dt, {', '.join(f'{_CAL[c]} AS {c}' for c in _CAL6)} FROM panel")
def calendar_features(spark, sf_dir):
    """Date parts: year, month, day of year, weekday (Mon=0), quarter, ISO week."""
    c = cal.calendar_columns()
    return orders_panel(spark, sf_dir).select(S.SERIES, S.DT, *[c[n].alias(n) for n in _CAL6])


_CYC = Q.cyclic_sql(6)


@query("cyclic_features", f"WITH {Q.panel_ctes()} SELECT series_id, dt, {', '.join(f'{v} AS {k}' for k, v in _CYC.items())} FROM panel")
def cyclic_features(spark, sf_dir):
    """sin / cos encodings of month, day of year and weekday."""
    c = cal.cyclic_columns(cal.calendar_columns())
    return round_doubles(orders_panel(spark, sf_dir).select(S.SERIES, S.DT, *[v.alias(k) for k, v in c.items()]), 6)


@query("calendar_flags", f"WITH {Q.panel_ctes()} SELECT series_id, dt, {_CAL['is_weekend']} AS is_weekend, {_CAL['is_holiday']} AS is_holiday FROM panel")
def calendar_flags(spark, sf_dir):
    return orders_panel(spark, sf_dir).select(S.SERIES, S.DT, cal.is_weekend().alias("is_weekend"),
                                              cal.is_holiday().alias("is_holiday"))


_HOL_SQL = f"""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt FROM orders WHERE o_orderdate IS NOT NULL)
SELECT dt, CAST({Q.holiday_effect_sql()} AS DOUBLE) AS holiday_effect, {_CAL['is_holiday']} AS is_holiday
FROM d WHERE {Q.holiday_effect_sql()} < 0"""


@query("holiday_flags", _HOL_SQL)
def holiday_flags(spark, sf_dir):
    """Order days that are holidays, with their effect (fixed dates, then Thanksgiving)."""
    d = tables.read_table(spark, sf_dir, "orders", ["o_orderdate"]) \
        .where(F.col("o_orderdate").isNotNull()) \
        .select(F.to_date("o_orderdate").alias(S.DT)).distinct()
    return d.select(S.DT, cal.holiday_effect().alias("holiday_effect"),
                    cal.is_holiday().alias("is_holiday")).where(F.col("holiday_effect") < 0)


# --- panel-level -------------------------------------------------------------
@query("drop_incomplete", f"""WITH {Q.panel_ctes()},
{Q.features_cte()}
SELECT series_id, count(*) AS n_rows, min(dt) AS first_dt, max(dt) AS last_dt
FROM feat WHERE {Q.not_null_all(S.FEATURE_NAMES)} GROUP BY series_id""")
def drop_incomplete(spark, sf_dir):
    """Rows left per series after dropping incomplete rows (warm-up of the year lag)."""
    df = feat.drop_incomplete(orders_features(spark, sf_dir))
    return df.groupBy(S.SERIES).agg(F.count(F.lit(1)).alias("n_rows"), F.min(S.DT).alias("first_dt"),
                                    F.max(S.DT).alias("last_dt"))


@query("date_spine", """WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)
SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dt FROM b""")
def date_spine(spark, sf_dir):
    """All days between the first and last order date."""
    o = tables.read_table(spark, sf_dir, "orders", ["o_orderdate"])
    b = o.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return b.select(F.explode(pnl.date_spine(F.col("lo"), F.col("hi"))).alias(S.DT))


@query("series_names", f"""WITH {Q.panel_ctes()}
SELECT series_id, arg_min(series_name, dt) AS series_name, count(*) AS n_days FROM panel GROUP BY series_id""")
def series_names(spark, sf_dir):
    """Distinct series with their (first) display name."""
    p = orders_panel(spark, sf_dir)
    return p.groupBy(S.SERIES).agg(F.min_by(S.SERIES_NAME, S.DT).alias(S.SERIES_NAME),
                                   F.count(F.lit(1)).alias("n_days"))


@query("distinct_series", f"WITH {Q.panel_ctes()} SELECT count(DISTINCT series_id) AS n_series, count(*) AS n_rows FROM panel")
def distinct_series(spark, sf_dir):
    p = orders_panel(spark, sf_dir)
    return p.agg(F.count_distinct(S.SERIES).alias("n_series"), F.count(F.lit(1)).alias("n_rows"))


@query("filter_series", f"WITH {Q.panel_ctes()} SELECT * FROM panel WHERE series_id = '1-URGENT'")
def filter_series(spark, sf_dir):
    return pnl.filter_series(orders_panel(spark, sf_dir), "1-URGENT")


@query("filter_series_range", f"WITH {Q.panel_ctes()} SELECT * FROM panel WHERE series_id = '2-HIGH' AND dt BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
def filter_series_range(spark, sf_dir):
    return pnl.filter_series_range(orders_panel(spark, sf_dir), "2-HIGH", "1998-01-01", "1998-12-31")


@query("latest_row", f"""WITH {Q.panel_ctes()},
{Q.features_cte()}
SELECT * FROM feat QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY dt DESC) = 1""")
def latest_row(spark, sf_dir):
    """Last row (all 29 features) of every series."""
    return round_doubles(pnl.latest_rows(orders_features(spark, sf_dir)), 4, _CYC6)


@query("numeric_columns", f"""WITH {Q.panel_ctes()},
{Q.features_cte()}
SELECT y, {', '.join(S.FEATURE_NAMES)} FROM feat WHERE {Q.not_null_all(S.FEATURE_NAMES)}""")
def numeric_columns(spark, sf_dir):
    """Projection of the processed panel to its numeric columns (selected by type)."""
    from pyspark.sql.types import NumericType
    df = orders_processed(spark, sf_dir)
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return round_doubles(df.select(*cols), 4, _CYC6)


_FM_SQL = f"""WITH {Q.panel_ctes()},
{Q.features_cte()}
SELECT series_id, dt, CAST(y AS DOUBLE) AS label, {', '.join(S.FEATURE_NAMES)} FROM feat WHERE {Q.not_null_all(S.FEATURE_NAMES)}"""


@query("feature_matrix", _FM_SQL)
def feature_matrix(spark, sf_dir):
    """Keys + label + the 29 features (by exclusion of keys and target), model order."""
    from tessera.operators.models import feature_frame
    return round_doubles(feature_frame(orders_processed(spark, sf_dir)), 4, _CYC6)


_FILL_SQL = f"""WITH {Q.panel_ctes()},
{Q.features_cte(digits_roll=None)},
f AS (SELECT series_id, dt,
  {', '.join(f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS {c}" for c in S.LAG_COLS)},
  {', '.join(f"round(coalesce({c}, avg({c}) OVER ()), 4) AS {c}" for c in _STDS)}
  FROM feat)
SELECT * FROM f"""


@query("fill_rules", _FILL_SQL)
def fill_rules(spark, sf_dir):
    """Fill rules on the undropped feature panel: lags forward-filled per series
    (leading gaps -> 0), rolling columns -> column mean, others -> 0."""
    df = orders_features(spark, sf_dir)
    filled = clean.fill_rules(df, S.FEATURE_NAMES)
    return round_doubles(filled.select(S.SERIES, S.DT, *S.LAG_COLS, *_STDS))


@query("label_encode", f"""WITH {Q.panel_ctes()}
SELECT series_id, dt, CAST(dense_rank() OVER (ORDER BY series_id) - 1 AS INTEGER) AS series_code FROM panel""")
def label_encode(spark, sf_dir):
    """Sorted distinct series ids -> 0..k-1 codes on every panel row."""
    out, _ = clean.label_encode(orders_panel(spark, sf_dir), S.SERIES, "series_code")
    return out.select(S.SERIES, S.DT, "series_code")


@query("scan_table", """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice
FROM orders WHERE o_orderstatus = 'F'""")
def scan_table(spark, sf_dir):
    """Suffix-dispatched load with date coercion; filter and projection reach the scan."""
    df = io.load_table(spark, tables.table_path(sf_dir, "orders"), date_col="o_orderdate")
    return df.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query("roundtrip_table", f"WITH {Q.panel_ctes()} SELECT series_id, series_name, dt, y FROM panel")
def roundtrip_table(spark, sf_dir):
    """Write the panel partitioned by series to the shared folder and read it back."""
    import uuid
    path = shared_path(spark, f"roundtrip-{uuid.uuid4().hex}.parquet")
    io.save_table(orders_panel(spark, sf_dir), path, partition_by=[S.SERIES])
    return io.load_table(spark, path).select(S.SERIES, S.SERIES_NAME, S.DT, S.Y)
