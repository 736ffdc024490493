import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import features as feat, panel as pnl
from tessera.streaming import live_features as live

D0 = dt.date(2021, 1, 1)


def post(spark, folder, rows):
    spark.createDataFrame(rows, live.OBSERVATIONS).coalesce(1).write.mode("append").parquet(folder)


def observations(seed=3, days=800):
    """(series, day, amount): gaps, several a day, and a series that starts late."""
    rng = random.Random(seed)
    rows = []
    for s, begin in (("1-A", 0), ("2-B", 0), ("3-C", 90)):
        for d in range(begin, days):
            rows += [(s, d, Decimal(rng.randrange(-50_000, 900_000)) / 100) for _ in range(rng.choice([0, 1, 1, 2]))]
    return rows


def as_rows(rows):
    return [(s, D0 + dt.timedelta(days=d), a) for s, d, a in rows]


def expected(spark, rows):
    return feat.processed_panel(pnl.build_panel(spark.createDataFrame(as_rows(rows), live.OBSERVATIONS), drop_from_name="^[0-9]-"))


def assert_same(got, want):
    order = [S.SERIES, S.SERIES_NAME, S.DT, S.Y, *S.FEATURE_NAMES]
    a = {(r.series_id, r.dt): r for r in got.select(order).dropna().collect()}
    b = {(r.series_id, r.dt): r for r in want.select(order).collect()}
    assert a.keys() == b.keys() and b
    for k, row in b.items():
        for c in order:
            assert a[k][c] == (pytest.approx(row[c], rel=1e-9, abs=1e-6) if isinstance(row[c], float) else row[c]), (k, c)


def test_equals_the_batch_panel_with_late_files_and_restarts(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("src", "sink", "ckpt"))
    rows = observations()
    ends = [(s, d, Decimal(0)) for s in ("1-A", "2-B", "3-C") for d in (0, 799)]
    rng = random.Random(8)
    part = [min(3, r[1] // 200 + (rng.random() < 0.1)) for r in rows]  # a tenth comes one part later
    for k in range(4):
        post(spark, src, as_rows([r for r, p in zip(rows, part) if p == k] + [e for e in ends if (e[1] > 0) * 3 == k]))
        live.run_available(live.observation_stream(spark, src), sink, ckpt, 3, "^[0-9]-")  # every part is a restart
    assert live.too_late(spark, sink).count() == 0
    assert_same(live.current(spark, sink), expected(spark, rows + ends))


def test_bounded_state_reopened_and_too_late_days(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("src", "sink", "ckpt"))
    rows = [("a", d, Decimal(2000 + d)) for d in range(1200)]
    post(spark, src, as_rows(rows))
    live.run_available(live.observation_stream(spark, src), sink, ckpt, 1)
    late = [("a", 1199 - 365, Decimal(5000)), ("a", 1150, Decimal(7))]
    lost = [("a", 1199 - 366, Decimal(11)), ("a", 3, Decimal("1.25"))]
    post(spark, src, as_rows(late + lost) + [("b", None, Decimal(1)), (None, D0, Decimal(1)), ("c", D0, None)])
    live.run_available(live.observation_stream(spark, src), sink, ckpt, 1)
    assert sorted((r.dt, r.amount) for r in live.too_late(spark, sink).collect()) == \
        sorted((D0 + dt.timedelta(days=d), a) for _, d, a in lost)
    got = live.current(spark, sink).where(F.col(S.SERIES) == "a").select(S.DT, S.Y, "y_lag_365", "y_rolling_min_30").collect()
    y = {d: 2000 + d for d in range(1200)}
    y[1199 - 365] += 5000
    y[1150] += 7
    by = {(r.dt - D0).days: r for r in got}
    assert {d: r.y for d, r in by.items()} == y
    assert all(by[d].y_lag_365 == y[d - 365] for d in range(365, 1200))
    assert all(by[d].y_rolling_min_30 == min(y[e] for e in range(d - 29, d + 1)) for d in range(30, 1200))
    assert live.current(spark, sink).where(F.col(S.SERIES) == "c").first().y == S.Y_FLOOR
    # no state holds more than the days that late rows may need
    state = spark.read.format("statestore").load(ckpt)
    assert state.selectExpr("max(size(value.groupState.cents))").first()[0] <= 731


def test_before_the_first_batch(spark, tmp_path):
    assert live.current(spark, str(tmp_path / "none")).count() == 0
    assert live.too_late(spark, str(tmp_path / "none")).count() == 0
