"""Window features over a dense panel, all sharing one window specification.

Every lag and rolling column uses ``partitionBy(series_id).orderBy(dt)`` with
row frames, so Catalyst evaluates them in a single Window operator after one
sort, and the exchange (if any) is on series_id only.  Frames are row counts,
equal to day ranges on a dense panel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.functions import calendar as cal


def series_window(series: str = S.SERIES, dt: str = S.DT):
    return Window.partitionBy(series).orderBy(dt)


def lag_columns(y: str = S.Y, lags=None, prefix: str | None = None) -> dict[str, Column]:
    w = series_window()
    prefix = prefix or y
    lags = lags or (S.LAGS + [S.YEAR_LAG])
    return {f"{prefix}_lag_{k}": F.lag(y, k).over(w).cast("double") for k in lags}


def rolling_columns(y: str = S.Y, windows=None, minmax_window: int = S.MINMAX_WINDOW,
                    prefix: str | None = None, leak_free: bool = False) -> dict[str, Column]:
    """Rolling mean and sample std (>=1 value; std null below 2) and min/max.

    ``leak_free`` ends every frame at the previous row instead of the current.
    """
    w = series_window()
    prefix = prefix or y
    windows = windows or S.ROLLING_WINDOWS
    hi = -1 if leak_free else 0
    out = {}
    for n in windows:
        f = w.rowsBetween(-(n - 1) + hi, hi)
        out[f"{prefix}_rolling_mean_{n}"] = F.avg(y).over(f)
        out[f"{prefix}_rolling_std_{n}"] = F.stddev_samp(y).over(f)
    f = w.rowsBetween(-(minmax_window - 1) + hi, hi)
    out[f"{prefix}_rolling_min_{minmax_window}"] = F.min(y).over(f).cast("double")
    out[f"{prefix}_rolling_max_{minmax_window}"] = F.max(y).over(f).cast("double")
    return out


def add_features(panel: DataFrame, y: str = S.Y, leak_free: bool = False) -> DataFrame:
    """Panel + the 29 model features in model order (calendar, cyclic, lags, rolling)."""
    df = cal.with_calendar(panel)
    df = df.withColumns(lag_columns(y))
    df = df.withColumns(rolling_columns(y, leak_free=leak_free))
    keys = [c for c in panel.columns]
    return df.select(*keys, *S.FEATURE_NAMES)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with any missing value (the warm-up rows of the year lag)."""
    return df.na.drop("any")


def processed_panel(panel: DataFrame) -> DataFrame:
    """Calendar + cyclic + lags + rolling, then drop incomplete rows."""
    return drop_incomplete(add_features(panel))


def rolling_full_window(y: str = S.Y, n: int = 30) -> dict[str, Column]:
    """Rolling mean / std that require a full window of ``n`` values (else null)."""
    f = series_window().rowsBetween(-(n - 1), 0)
    full = F.count(y).over(f) >= n
    return {
        f"rolling_mean_{n}": F.when(full, F.avg(y).over(f)),
        f"rolling_std_{n}": F.when(full, F.stddev_samp(y).over(f)),
    }


def rolling_bands(panel: DataFrame, n: int = 30, y: str = S.Y) -> DataFrame:
    """Rolling mean, std and the mean +/- std band (full windows only)."""
    cols = rolling_full_window(y, n)
    df = panel.withColumns(cols)
    m, s = F.col(f"rolling_mean_{n}"), F.col(f"rolling_std_{n}")
    return df.withColumns({"upper_band": m + s, "lower_band": m - s})


def sequence_windows(df: DataFrame, value_cols: list[str], length: int = S.SEQUENCE_LENGTH,
                     target: str = S.Y) -> DataFrame:
    """Inputs = the ``length`` preceding rows (arrays of the value columns), target = y.

    The first ``length`` rows of a series have an incomplete history and are dropped.
    """
    f = series_window().rowsBetween(-length, -1)
    row = F.array(*[F.col(c).cast("double") for c in value_cols])
    out = df.select(S.SERIES, S.DT, F.col(target).cast("double").alias("target"),
                    F.collect_list(row).over(f).alias("window"))
    return out.where(F.size("window") == length)


def last_sequence(df: DataFrame, value_cols: list[str], length: int = S.SEQUENCE_LENGTH) -> DataFrame:
    """Last ``length`` rows of every series as one ordered array; shorter series are skipped.

    Uses a per-series top-k (row_number <= length, planned as WindowGroupLimit)
    so only ``length`` rows per series reach the collect.
    """
    w = Window.partitionBy(S.SERIES).orderBy(F.col(S.DT).desc())
    top = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= length)
    row = F.struct(F.col(S.DT), F.array(*[F.col(c).cast("double") for c in value_cols]).alias("v"))
    agg = top.groupBy(S.SERIES).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    return (agg.where(F.size("_rows") == length)
            .select(S.SERIES, F.col("_rows")[length - 1][S.DT].alias("last_dt"),
                    F.transform("_rows", lambda r: r["v"]).alias("window")))
