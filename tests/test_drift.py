import datetime as dt
import random

import numpy as np
import pytest

from tessera import schema as S
from tessera.operators import drift
from tests.conftest import panel_from_rows

D0 = dt.date(2020, 1, 1)


def rows_of(series, values):
    return [(series, (D0 + dt.timedelta(days=i)).isoformat(), int(v)) for i, v in enumerate(values)]


def by_hand(values, reference):
    """Month -> (n, ref_n, psi, ks) by plain sorting."""
    months = {}
    for i, v in enumerate(values):
        d = D0 + dt.timedelta(days=i)
        months.setdefault(d.year * 12 + d.month - 1, []).append(v)
    out = {}
    for m, now in months.items():
        ref = [v for k in range(m - reference, m) for v in months.get(k, [])]
        key = dt.date(m // 12, m % 12 + 1, 1)
        if not ref:
            out[key] = (len(now), 0, None, None)
            continue
        ks = max(abs(sum(x <= v for x in now) / len(now) - sum(x <= v for x in ref) / len(ref)) for v in now + ref)
        shares = []
        for side in (now, ref):
            t = [min(9, sum(x < v for x in ref) * 10 // len(ref)) for v in side]
            shares.append([max(1e-4, t.count(k) / len(side)) for k in range(10)])
        out[key] = (len(now), len(ref), sum((p - q) * np.log(p / q) for p, q in zip(*shares)), ks)
    return out


def test_monthly_drift_by_hand(spark):
    rng = random.Random(2)
    a = [rng.gauss(1000, 50) // 10 * 10 for _ in range(300)] + [rng.gauss(1100, 50) for _ in range(100)]
    b = [500] * 70
    got = drift.monthly_drift(panel_from_rows(spark, rows_of("a", a) + rows_of("b", b)), reference=4).collect()
    for series, values in (("a", [int(v) for v in a]), ("b", b)):
        want = by_hand(values, 4)
        rows = {r.month: r for r in got if r.series_id == series}
        assert rows.keys() == want.keys()
        for m, (n, ref_n, psi, ks) in want.items():
            r = rows[m]
            assert (r.n, r.ref_n) == (n, ref_n)
            assert r.psi == (None if psi is None else pytest.approx(psi, abs=1e-12)) and r.ks == (None if ks is None else pytest.approx(ks))
    shifted = {r.month: r for r in got if r.series_id == "a"}[dt.date(2020, 11, 1)]
    assert shifted.psi > 0.2 and shifted.ks > shifted.ks_limit


def big_panel(spark, n=60_000):
    """Many values a day, so that sketches have to compress."""
    rng = np.random.default_rng(5)
    day = rng.integers(0, 120, n)
    y = rng.normal(1000, 100, n) + np.where(day >= 91, 30, 0)
    return spark.createDataFrame([("a", D0 + dt.timedelta(days=int(d)), float(v)) for d, v in zip(day, y)], "series_id string, dt date, y double")


def test_sketches_stay_within_their_error(spark):
    panel = big_panel(spark)
    sketches = drift.month_sketches(panel)
    exact = {r.month: r for r in drift.monthly_drift(panel, reference=3).collect()}
    rough = {r.month: r for r in drift.sketch_drift(sketches, reference=3).collect()}
    assert rough.keys() == exact.keys()
    error = drift.expected_rank_error(200)
    for m, e in exact.items():
        r = rough[m]
        assert (r.n, r.ref_n) == (e.n, e.ref_n)
        if e.ref_n:
            assert abs(r.ks - e.ks) < 2 * error + 0.01 and abs(r.psi - e.psi) < 0.05
    last = max(exact)
    assert exact[last].ks > exact[last].ks_limit and rough[last].ks > rough[last].ks_limit


def test_merged_sketches_equal_one_built_at_once(spark):
    panel = big_panel(spark)
    values = np.sort([r.y for r in panel.collect()])
    sketches = drift.month_sketches(panel)
    r = drift.range_quantiles(sketches, "2020-01-01", "2020-12-01", (0.1, 0.5, 0.9)).first()
    assert (r.n, r.least, r.most) == (len(values), values[0], values[-1])
    for q, v in zip((0.1, 0.5, 0.9), r.quantiles):
        assert abs(np.searchsorted(values, v) / len(values) - q) < drift.expected_rank_error(200)
    assert abs(r.n_different / len(set(values)) - 1) < 0.05
    assert drift.range_quantiles(sketches, "2020-02-01", "2020-02-01").first().n == sum(
        1 for x in panel.collect() if x.dt.month == 2)


def test_planted_shifts_are_found(spark):
    rng = random.Random(7)
    shift = [rng.gauss(1000, 20) for _ in range(200)] + [rng.gauss(1060, 20) for _ in range(200)] + [rng.gauss(950, 20) for _ in range(150)]
    calm = [rng.gauss(1000, 20) for _ in range(400)]
    flat = [700] * 100 + [701] * 100
    short = [1, 2, 3]
    panel = panel_from_rows(spark, rows_of("shift", shift) + rows_of("calm", calm) + rows_of("flat", flat) + rows_of("short", short))
    got = {}
    for r in drift.change_points(panel).collect():
        got.setdefault(r.series_id, []).append(((r.change_dt - D0).days, (r.alarm_dt - D0).days, r.direction))
    assert set(got) == {"shift", "flat"}
    (a, alarm_a, up), (b, alarm_b, down) = sorted(got["shift"])
    # noise may lift the sum off zero some days before the shift that it then runs into
    assert (up, down) == ("up", "down") and 180 <= a <= 203 <= alarm_a + 3 and 380 <= b <= 403 <= alarm_b + 3
    assert 200 <= alarm_a <= 210 and 400 <= alarm_b <= 410
    assert got["flat"] == [(100, 100, "up")]


def test_empty_panel(spark):
    none = spark.createDataFrame([], "series_id string, dt date, y long")
    assert drift.monthly_drift(none).count() == 0 and drift.change_points(none).count() == 0
    assert drift.sketch_drift(drift.month_sketches(none)).count() == 0 and S.SERIES in drift.change_points(none).columns
