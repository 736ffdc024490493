import datetime as dt

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import panel as pnl
from tests.conftest import panel_from_rows


def _obs(spark, rows):
    from decimal import Decimal
    data = [(s, dt.date.fromisoformat(d), Decimal(v)) for s, d, v in rows]
    return spark.createDataFrame(data, "series_id string, dt date, amount decimal(18,2)")


def test_gap_filled_and_clamped(spark):
    obs = _obs(spark, [("a", "2024-01-01", 5000), ("a", "2024-01-01", 2500), ("a", "2024-01-04", 10),
                       ("b", "2024-01-03", 7000)])
    p = pnl.build_panel(obs).orderBy("series_id", "dt").collect()
    got = [(r.series_id, r.dt.isoformat(), r.y) for r in p]
    assert got == [
        ("a", "2024-01-01", 7500), ("a", "2024-01-02", 1000), ("a", "2024-01-03", 1000),
        ("a", "2024-01-04", 1000),
        ("b", "2024-01-01", 1000), ("b", "2024-01-02", 1000), ("b", "2024-01-03", 7000),
        ("b", "2024-01-04", 1000)]


def test_explicit_bounds_filter_and_pad(spark):
    obs = _obs(spark, [("a", "2023-12-31", 9000), ("a", "2024-01-02", 3000)])
    p = pnl.build_panel(obs, start="2024-01-01", end="2024-01-03").orderBy("dt").collect()
    assert [(r.dt.isoformat(), r.y) for r in p] == [("2024-01-01", 1000), ("2024-01-02", 3000),
                                                    ("2024-01-03", 1000)]


def test_single_row_series(spark):
    obs = _obs(spark, [("solo", "2024-02-10", 4321)])
    p = pnl.build_panel(obs).collect()
    assert len(p) == 1 and p[0].y == 4321


def test_global_index_matches_sorted_position(spark):
    rows = [(s, f"2024-01-{d:02d}", d) for s in ("b", "a", "c") for d in range(1, 8)]
    p = panel_from_rows(spark, rows)
    got = {(r.series_id, r.dt.day): r.global_idx for r in pnl.with_global_index(p).collect()}
    expected = {(s, d): i for i, (s, d) in enumerate(sorted((s, d) for s in "abc" for d in range(1, 8)))}
    assert got == expected


def test_latest_rows_and_filters(spark):
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-05", 5), ("b", "2024-01-02", 2)]
    p = panel_from_rows(spark, rows)
    last = {r.series_id: r.y for r in pnl.latest_rows(p).collect()}
    assert last == {"a": 5, "b": 2}
    assert pnl.filter_series_range(p, "a", "2024-01-01", "2024-01-03").count() == 1
    assert pnl.filter_series_range(p, "a", "2024-01-01", None).count() == 2  # half range ignored


def test_lookback_rewrite_is_exact(spark):
    from tessera.operators import features as feat
    rows = [("a", (dt.date(2023, 1, 1) + dt.timedelta(days=i)).isoformat(), (i * 37) % 101)
            for i in range(500)]
    p = panel_from_rows(spark, rows)
    full = feat.add_features(p).where(F.col(S.DT).between("2024-03-01", "2024-04-30"))
    padded, keep = pnl.with_lookback(p, "2024-03-01", "2024-04-30")
    fast = feat.add_features(padded).where(keep)
    assert sorted(full.collect()) == sorted(fast.collect())


def test_exclusive_prefix_sum_groups_and_hot_key(spark):
    import random

    from tessera.operators.positions import exclusive_prefix_sum
    rnd = random.Random(5)
    rows = [("hot", i, rnd.randint(1, 9)) for i in range(300)]
    rows += [(g, i, rnd.randint(1, 9)) for g in ("a", "b") for i in range(20)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    out = exclusive_prefix_sum(df, ["k"], "v", "before", group_cols=["g"], num_partitions=7).collect()
    got = {(r.g, r.k): r.before for r in out}
    exp, run = {}, {}
    for g, k, v in sorted(rows):
        exp[(g, k)] = run.get(g, 0)
        run[g] = run.get(g, 0) + v
    assert got == exp
    flat = exclusive_prefix_sum(df.where("g = 'hot'"), ["k"], "v", "before", num_partitions=5).collect()
    assert {r.k: r.before for r in flat} == {k: b for (g, k), b in exp.items() if g == "hot"}
