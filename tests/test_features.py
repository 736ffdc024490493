import datetime as dt
import math

from tessera import schema as S
from tessera.functions import calendar as cal
from tessera.operators import features as feat
from tests.conftest import panel_from_rows


def _days(start, n):
    d0 = dt.date.fromisoformat(start)
    return [(d0 + dt.timedelta(days=i)).isoformat() for i in range(n)]


def test_iso_week_53_and_weekday(spark):
    rows = [("a", d, 1) for d in _days("2020-12-28", 8)]
    df = cal.with_calendar(panel_from_rows(spark, rows)).orderBy("dt").collect()
    assert [r.week_of_year for r in df] == [53, 53, 53, 53, 53, 53, 53, 1]
    assert [r.day_of_week for r in df] == [0, 1, 2, 3, 4, 5, 6, 0]
    assert [r.is_weekend for r in df] == [0, 0, 0, 0, 0, 1, 1, 0]
    # 2020-12-31 and 2021-01-01 are fixed holidays
    assert [r.is_holiday for r in df] == [0, 0, 0, 1, 1, 0, 0, 0]


def test_thanksgiving_and_weekend_holiday(spark):
    rows = [("a", d, 1) for d in _days("2023-11-20", 7)] + [("a", "2022-12-25", 1)]
    df = panel_from_rows(spark, rows).select("dt", cal.holiday_effect().alias("e")).collect()
    eff = {r.dt.isoformat(): r.e for r in df}
    assert eff["2023-11-23"] == -0.20
    assert all(v == 0.0 for k, v in eff.items() if k not in ("2023-11-23", "2022-12-25"))
    assert eff["2022-12-25"] == -0.15  # a Sunday: fixed dates do not care


def test_cyclic_values(spark):
    df = cal.with_calendar(panel_from_rows(spark, [("a", "2024-03-15", 1)])).first()
    assert math.isclose(df.month_sin, math.sin(2 * math.pi * 3 / 12))
    assert math.isclose(df.day_of_year_cos, math.cos(2 * math.pi * 75 / 365.25))


def test_lags_and_rolling_by_hand(spark):
    ys = [10, 20, 30, 40, 50, 60, 70, 80]
    rows = [("a", d, y) for d, y in zip(_days("2024-01-01", 8), ys)] + [("b", "2024-01-01", 999)]
    f = feat.add_features(panel_from_rows(spark, rows))
    a = f.where("series_id = 'a'").orderBy("dt").collect()
    assert [r.y_lag_1 for r in a] == [None] + [float(v) for v in ys[:-1]]
    assert [r.y_lag_7 for r in a] == [None] * 7 + [10.0]
    assert a[0].y_rolling_std_7 is None  # one value
    assert a[2].y_rolling_mean_7 == 20.0
    assert math.isclose(a[7].y_rolling_mean_7, sum(ys[1:8]) / 7)
    assert math.isclose(a[7].y_rolling_std_7, 21.602468994692867)
    assert a[7].y_rolling_min_30 == 10.0 and a[7].y_rolling_max_30 == 80.0
    b = f.where("series_id = 'b'").first()
    assert b.y_lag_1 is None and b.y_rolling_mean_90 == 999.0  # no leak across series


def test_feature_order_and_drop(spark):
    rows = [("a", d, i) for i, d in enumerate(_days("2023-01-01", 400))]
    f = feat.add_features(panel_from_rows(spark, rows))
    assert f.columns[4:] == S.FEATURE_NAMES
    assert feat.drop_incomplete(f).count() == 400 - 365
    assert S.feature_names("aadt")[14] == "aadt_lag_1" and len(S.FEATURE_NAMES) == 29


def test_full_window_and_bands(spark):
    rows = [("a", d, y) for d, y in zip(_days("2024-01-01", 9), [1, 2, 3, 4, 5, 6, 7, 8, 9])]
    b = feat.rolling_bands(panel_from_rows(spark, rows), 7).orderBy("dt").collect()
    assert [r.rolling_mean_7 for r in b][:6] == [None] * 6
    assert b[6].rolling_mean_7 == 4.0
    assert math.isclose(b[6].upper_band - b[6].lower_band, 2 * b[6].rolling_std_7)


def test_sequences(spark):
    rows = [("a", d, i) for i, d in enumerate(_days("2024-01-01", 35))] + \
           [("short", d, 1) for d in _days("2024-01-01", 10)]
    p = panel_from_rows(spark, rows)
    w = feat.sequence_windows(p, ["y"], 30)
    assert w.where("series_id = 'short'").count() == 0
    first = w.where("series_id = 'a'").orderBy("dt").first()
    assert first.target == 30.0 and [v[0] for v in first.window] == [float(i) for i in range(30)]
    last = {r.series_id: r for r in feat.last_sequence(p, ["y"], 30).collect()}
    assert set(last) == {"a"} and [v[0] for v in last["a"].window] == [float(i) for i in range(5, 35)]


def test_one_window_sort_no_single_partition(spark):
    rows = [("a", d, i) for i, d in enumerate(_days("2024-01-01", 40))]
    plan = feat.processed_panel(panel_from_rows(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert plan.count("Sort [") <= 2  # one sort for the shared window spec (plus none else)
    assert "Window" in plan
