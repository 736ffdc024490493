import datetime as dt
import math

import numpy as np

from tessera.operators import profile as prof
from tests.conftest import panel_from_rows


def test_corr_matrix_matches_numpy_and_constant_is_null(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=200)
    b = 0.5 * a + rng.normal(size=200)
    c = np.full(200, 7.0)
    rows = [(float(x), float(y), float(z)) for x, y, z in zip(a * 1e6 + 3e7, b, c)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in prof.corr_matrix(df, ["a", "b", "c"]).collect()}
    exp = np.corrcoef(a, b)[0, 1]
    assert math.isclose(got[("a", "b")], exp, rel_tol=1e-9) and got[("b", "a")] == got[("a", "b")]
    assert got[("a", "a")] == 1.0
    assert got[("c", "c")] is None and got[("a", "c")] is None
    low = prof.lower_triangle(prof.corr_matrix(df, ["a", "b", "c"])).collect()
    assert {(r.pos_a, r.pos_b) for r in low} == {(1, 0), (2, 0), (2, 1)}


def test_summary_nulls_profiles(spark):
    rows = [("a", f"2024-01-{d:02d}", v) for d, v in [(1, 10), (2, 20), (3, 30), (4, 40)]]
    rows += [("b", "2024-02-01", 5)]
    p = panel_from_rows(spark, rows)
    s = prof.data_summary(p).first()
    assert (s.n_rows, s.n_series, s.first_dt, s.last_dt) == (5, 2, "2024-01-01", "2024-02-01")
    assert s.y_median == 20.0 and s.y_min == 5.0 and s.y_max == 40.0
    nc = {r.column_name: r.null_count for r in prof.null_counts(p.withColumn("z", p.y * None)).collect()}
    assert nc == {"series_id": 0, "series_name": 0, "dt": 0, "y": 0, "z": 5}
    sp = {r.series_id: r for r in prof.series_profile(p).collect()}
    assert sp["a"].mean_y == 25.0 and sp["a"].std_y == 13.0  # 12.9099 rounds to 13
    ts = prof.trend_grouping_sets(p).collect()
    overall = {(r.year, r.month): r.y_mean for r in ts if r.is_overall == 1}
    assert overall == {(2024, 1): 25.0, (2024, 2): 5.0}
    assert {r.month_start for r in ts} == {dt.date(2024, 1, 1), dt.date(2024, 2, 1)}


def test_half_even_rounding(spark):
    rows = [("a", "2024-01-01", 2), ("a", "2024-01-02", 3)]  # mean 2.5 -> 2 (half-even)
    sp = prof.series_profile(panel_from_rows(spark, rows)).first()
    assert sp.mean_y == 2.0


def test_approximate_options(spark):
    from tessera.operators import evaluate as ev
    rows = [("a", f"2024-01-{d:02d}", d * 10) for d in range(1, 22)]
    p = panel_from_rows(spark, rows)
    s = prof.data_summary(p, approx=True).first()
    assert s.n_series == 1 and s.y_median == 110.0
    long = p.selectExpr("'m' AS model", "series_id", "dt", "CAST(y AS DOUBLE) AS y",
                        "CAST(y + 1 AS DOUBLE) AS yhat")
    exact = ev.metrics(long).first()
    approx = ev.metrics(long, median="approx").first()
    assert math.isclose(approx.MAPE_Median, exact.MAPE_Median, rel_tol=0.1)
    assert approx.RMSE == exact.RMSE
