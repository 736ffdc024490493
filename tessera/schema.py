"""Schemas and fixed values.

Everything under "FIXED VALUES" must equal the values of the original
forecasting pipeline for results to agree; they are stated plainly here.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Panel key / target names used throughout the engine.
SERIES = "series_id"
SERIES_NAME = "series_name"
DT = "dt"
Y = "y"
KEYS = [SERIES, DT]

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline)
# ---------------------------------------------------------------------------
# Lag offsets in rows (days on a dense panel).
LAGS = [1, 7, 14, 30]
YEAR_LAG = 365
# Rolling windows for mean and sample standard deviation.
ROLLING_WINDOWS = [7, 14, 30, 90]
# Window for rolling min / max.
MINMAX_WINDOW = 30
# Periods of the cyclic encodings: month / 12, day of year / 365.25, weekday / 7.
CYCLIC_PERIODS = [("month", 12.0), ("day_of_year", 365.25), ("day_of_week", 7.0)]
# Fixed-date holidays (month, day), effect -0.15; checked before the rule below.
FIXED_HOLIDAYS = [(1, 1), (7, 4), (11, 11), (12, 25), (12, 31)]
FIXED_HOLIDAY_EFFECT = -0.15
# Rule holiday: fourth Thursday of November, effect -0.20.
THANKSGIVING_EFFECT = -0.20
# Weekend uplift used by the expected-volume formula.
WEEKEND_UPLIFT = 0.05
# Seasonal sine period in days.
SEASON_DAYS = 365.25
# Lower clamp of the target.
Y_FLOOR = 1000
# Sequence length of the sequence model and default forecast horizon.
SEQUENCE_LENGTH = 30
FORECAST_DAYS = 30
# Top-k of univariate feature selection, number of CV folds.
SELECT_K = 20
CV_FOLDS = 5
# Model hyper-parameters.
RF_PARAMS = dict(numTrees=100, maxDepth=10, minInstancesPerNode=2, seed=42)
GBT_PARAMS = dict(maxIter=100, stepSize=0.1, maxDepth=6, minInstancesPerNode=2, seed=42)
# Feature names in model order (target prefix "aadt" renamed to "y").
FEATURE_NAMES = [
    "year", "month", "day_of_year", "day_of_week", "is_weekend", "is_holiday",
    "quarter", "week_of_year",
    "month_sin", "month_cos", "day_of_year_sin", "day_of_year_cos",
    "day_of_week_sin", "day_of_week_cos",
    "y_lag_1", "y_lag_7", "y_lag_14", "y_lag_30", "y_lag_365",
    "y_rolling_mean_7", "y_rolling_std_7", "y_rolling_mean_14", "y_rolling_std_14",
    "y_rolling_mean_30", "y_rolling_std_30", "y_rolling_mean_90", "y_rolling_std_90",
    "y_rolling_min_30", "y_rolling_max_30",
]
# ---------------------------------------------------------------------------

CALENDAR_INT_COLS = FEATURE_NAMES[:8]
CYCLIC_COLS = FEATURE_NAMES[8:14]
LAG_COLS = FEATURE_NAMES[14:19]
ROLLING_COLS = FEATURE_NAMES[19:29]

RAW_PANEL = T.StructType([
    T.StructField(DT, T.DateType(), False),
    T.StructField(SERIES, T.StringType(), False),
    T.StructField(SERIES_NAME, T.StringType(), True),
    T.StructField(Y, T.LongType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day_of_year", T.IntegerType(), True),
    T.StructField("day_of_week", T.IntegerType(), True),
    T.StructField("is_weekend", T.IntegerType(), True),
    T.StructField("is_holiday", T.IntegerType(), True),
])

PREDICTIONS_LONG = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField(SERIES, T.StringType(), False),
    T.StructField(DT, T.DateType(), False),
    T.StructField(Y, T.DoubleType(), True),
    T.StructField("yhat", T.DoubleType(), True),
])

METRIC_COLS = ["MSE", "RMSE", "MAE", "MAPE", "MAPE_Median", "R2",
               "Directional_Accuracy", "Theil_U"]


def feature_names(prefix: str = Y) -> list[str]:
    """Feature list with the target prefix of lag/rolling columns swapped."""
    return [f.replace("y_", f"{prefix}_", 1) if f.startswith("y_") else f
            for f in FEATURE_NAMES]
