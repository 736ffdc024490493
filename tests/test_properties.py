import datetime as dt
import math
from decimal import Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import features as feat, panel as pnl

D0 = dt.date(2024, 1, 1)
obs_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40),
                              st.integers(0, 5000)), min_size=1, max_size=40)


def brute_force(rows):
    """pandas reference: daily sums, global date range, fill 0, clamp, lags, rolling."""
    df = pd.DataFrame(rows, columns=["s", "d", "v"])
    daily = df.groupby(["s", "d"])["v"].sum()
    days = range(df["d"].min(), df["d"].max() + 1)
    out = {}
    for s in sorted(df["s"].unique()):
        y = pd.Series([max(int(daily.get((s, d), 0)), 1000) for d in days], dtype="float64")
        lag = {k: y.shift(k) for k in (1, 7, 14, 30)}
        m7 = y.rolling(7, min_periods=1).mean()
        s7 = y.rolling(7, min_periods=1).std()
        mn = y.rolling(30, min_periods=1).min()
        for i, d in enumerate(days):
            out[(s, d)] = (y[i], lag[1][i], lag[7][i], lag[30][i], m7[i], s7[i], mn[i])
    return out


def _eq(a, b):
    if b is None or (isinstance(b, float) and math.isnan(b)):
        return a is None
    return a is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(obs_rows)
def test_panel_and_windows_match_pandas(spark, rows):
    data = [(s, D0 + dt.timedelta(days=d), Decimal(v)) for s, d, v in rows]
    obs = spark.createDataFrame(data, "series_id string, dt date, amount decimal(18,2)")
    f = feat.add_features(pnl.build_panel(obs))
    got = {(r.series_id, (r.dt - D0).days): (float(r.y), r.y_lag_1, r.y_lag_7, r.y_lag_30,
                                              r.y_rolling_mean_7, r.y_rolling_std_7, r.y_rolling_min_30)
           for r in f.collect()}
    exp = brute_force(rows)
    assert set(got) == set(exp)
    for k, e in exp.items():
        assert all(_eq(a, b) for a, b in zip(got[k], e)), (k, got[k], e)


values = st.lists(st.tuples(st.sampled_from(["m1", "m2"]), st.integers(0, 30)), min_size=1, max_size=300)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values)
def test_exact_median_matches_statistics(spark, rows):
    import statistics

    from tessera.operators.quantiles import exact_median
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g string, x double")
    got = {r.g: r.median for r in exact_median(df, ["g"], "x", grid=10, accuracy=100,
                                                max_bracket=5).collect()}
    exp = {g: statistics.median([float(v) for k, v in rows if k == g]) for g in {k for k, _ in rows}}
    assert got == exp


series_vals = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 9), st.integers(-5, 5)),
                       min_size=2, max_size=30, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series_vals)
def test_directional_accuracy_matches_numpy_concatenation(spark, rows):
    import numpy as np

    from tessera.operators import evaluate as ev
    data = [("m", s, D0 + dt.timedelta(days=d), float(y), float(y + (d % 3) - 1)) for s, d, y in rows]
    long = spark.createDataFrame(data, "model string, series_id string, dt date, y double, yhat double")
    got = ev.directional_accuracy(long).first().Directional_Accuracy
    ordered = sorted(data, key=lambda r: (r[1], r[2]))
    y = np.array([r[3] for r in ordered])
    p = np.array([r[4] for r in ordered])
    exp = float(np.mean((np.diff(y) > 0) == (np.diff(p) > 0))) if len(y) > 1 else 0.0
    assert math.isclose(got, exp, rel_tol=1e-12)
