import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives as hn


def rows_of(seed=1, n=400):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-300, 300, (8, 10))
    rows = [(i, int(rng.integers(0, 4)), (centres[i % 8] + rng.integers(-60, 60, 10)).tolist()) for i in range(n)]
    rows += [(1000 + i, i % 2, rows[0][2]) for i in range(120)]  # a third holds one vector
    rows += [(20, 3, rows[20][2][:4]), (20, 3, rows[20][2][:4]), (40, 0, rows[40][2]), (3, 1, []), (100, 2, [0] * 10)]
    return rows


def wanted(rows, anchor, n_pos=5, n_neg=5, low=80, high=100):
    rows = sorted({(i, lab, tuple(v)) for i, lab, v in rows})
    out = []
    for i, lab, v in rows:
        if not anchor(i):
            continue
        rest = sorted((-sum(a * b for a, b in zip(v, u)), j, other == lab) for j, other, u in rows if j != i)
        for s, p, _ in [r for r in rest if r[2]][:n_pos]:
            fits = [r for r in rest if not r[2] and low * -s <= 100 * -r[0] <= high * -s][:n_neg]
            out += [(i, p, k, j, -s, -t) for k, (t, j, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"cell_rows": 8, "block_rows": 16, "most_sampled": 100}, {"cell_rows": 1, "most_codes": 5}])
def test_equals_every_anchor_against_every_row(spark, sizes):
    rows = rows_of()
    table = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "id long, label long, vector array<long>, w int, rank double").repartition(4)
    got = hn.mined(table, F.col("id") % 20 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = wanted(rows, lambda i: i % 20 == 0)
    assert len(want) > 200 and sorted(map(tuple, got.collect())) == want


def test_other_windows_and_large_scores(spark):
    rows = [(i, lab, [x * 1_500_000 for x in v]) for i, lab, v in rows_of(2, 150)]
    table = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(2)
    got = hn.mined(table, F.col("id") < 12, 3, 7, 37, 111, cell_rows=8)
    assert sorted(map(tuple, got.collect())) == wanted(rows, lambda i: i < 12, 3, 7, 37, 111)
    with pytest.raises(ValueError, match="2\\^62"):
        hn.mined(spark.createDataFrame([(1, 1, [1 << 40])], table.schema), F.col("id") == 1)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(None, 1, [1.0]), (5, None, [1.0]), (6, 1, None), (7, 1, [1.0, None]), (8, 1, [nan]), (9, 1, [-inf])]
    rows = [(1, 1, [2.0]), (2, 1, [1.0]), (3, 2, [0.9]), (4, 2, [])]
    table = spark.createDataFrame(bad + rows, "v long, l int, e array<float>")
    assert sorted(r.id for r in hn.usable(table, "v", "l", "e").collect()) == [1, 2, 3, 4]


def test_empty_table_and_lone_labels(spark):
    empty = spark.createDataFrame([], "id long, label long, vector array<long>")
    assert hn.mined(empty, F.col("id") % 2 == 0).count() == 0
    lone = spark.createDataFrame([(0, 1, [1, 2]), (1, 2, [3, 4]), (2, 3, [])], empty.schema)
    assert hn.mined(lone, F.col("id") % 2 == 0).count() == 0
    blank = spark.createDataFrame([(0, 1, []), (1, 1, []), (2, 3, [])], empty.schema)
    assert [tuple(r) for r in hn.mined(blank, F.col("id") == 0).collect()] == [(0, 1, 1, 2, 0, 0)]


def index_of(points, codes):
    half = points.shape[1] // 2
    books = [hn.codebook(points[:, :half].astype(float), codes), hn.codebook(points[:, half:].astype(float), codes)]
    (a, r1), (b, r2) = (hn.nearest(p.astype(float), c) for p, c in zip((points[:, :half], points[:, half:]), books))
    cells = np.unique(a * codes + b)
    radii = np.array([[r[a * codes + b == c].max() for r in (r1, r2)] for c in cells])
    return hn.Index(books, half, "<i8", "<f8", cells, np.ones(len(cells), int), radii), a * codes + b


def test_heap_gives_falling_bounds_that_hold_and_stops():
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, (6, 12))
    points = centres[rng.integers(0, 6, 500)] + rng.integers(-20, 20, (500, 12))
    index, cell = index_of(points, 6)
    everywhere = [{"w": 0, "lo": -hn.FAR, "hi": hn.FAR, "least": None}]
    for q in points[:20]:
        scores, seen, done, before = points @ q, set(), 0, np.inf
        while True:
            found, done, bound = index.visits(q, everywhere, done, 2)
            assert not seen & set(found)
            seen |= set(found)
            if bound is None:
                break
            assert bound <= before
            rest = ~np.isin(cell, index.cells[sorted(seen)])
            assert scores[rest].max(initial=-hn.FAR) <= bound
            before = bound
        assert seen == set(range(len(index.cells)))
        fifth = int(np.sort(scores)[-5])
        found, places, bound = index.visits(q, [{"w": 0, "lo": -hn.FAR, "hi": hn.FAR, "least": fifth}], 0, 10 ** 6)
        assert bound is not None and bound < fifth and places < 36  # certified before all cells are visited
        assert set(index.cells[found]) >= set(cell[scores >= fifth])


def test_codebooks_are_fitted_outside_the_driver(spark, monkeypatch):
    driver, plain = os.getpid(), hn.codebook

    def elsewhere(points, codes, rounds=8):
        assert os.getpid() != driver
        return plain(points, codes, rounds)
    monkeypatch.setattr(hn, "codebook", elsewhere)
    rows = rows_of()
    table = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(3)
    index, filed, _ = hn.indexed(table, cell_rows=8, most_sampled=100)
    distinct = table.distinct().select("*", F.xxhash64("id", "label", "vector").alias("h")).orderBy("h", "id").limit(100).collect()
    points = np.array([list(r.vector) + [0] * (10 - len(r.vector)) for r in distinct], float)
    for book, part in zip(index.books, (points[:, :5], points[:, 5:])):
        assert np.allclose(book, plain(part, len(book)))
    assert filed.count() == table.distinct().count()


def test_sample_holds_the_least_hashes_and_leaves_the_others_where_they_are(spark):
    table = spark.range(20_000).selectExpr("id", "id % 3 as label", "array(id, id * id) as vector")
    key = F.xxhash64("id", "label", "vector")
    want = [r.vector for r in table.orderBy(key, "id").limit(100).collect()]
    sample = hn.sampled(table, 20_000, 100)
    assert [r.vector for r in sample.collect()] == want and sample.rdd.getNumPartitions() == 1
    assert "Filter" in sample._jdf.queryExecution().executedPlan().toString()
    assert hn.sampled(table.limit(50), 50, 100).count() == 50


def test_visits_of_an_anchor_are_dealt_to_short_rows():
    rng = np.random.default_rng(4)
    points = rng.integers(-400, 400, (900, 8))
    index, _ = index_of(points, 30)
    index.parts = rng.integers(1, 4, len(index.cells))
    window = [{"w": 0, "lo": -hn.FAR, "hi": hn.FAR, "least": None}]
    batch = pa.record_batch({"anchor": [7, 9], "own": [1, 2], "label": [0, 1], "vec": [p.astype("<i8").tobytes() for p in points[:2]],
                             "windows": [window, window], "done": [0, len(index.cells) ** 2]})
    got = hn._planned(index, batch, 10 ** 6).to_pylist()
    assert max(len(r["visits"]) for r in got) == hn.VISITS and sum(r["head"] for r in got) == 2
    assert [r["head"] for r in got if r["anchor"] == 9] == [True] and not got[-1]["visits"] and got[-1]["next"] is None
    seen = [(v["at"], v["part"]) for r in got if r["anchor"] == 7 for v in r["visits"]]
    assert len(seen) > 2 * hn.VISITS and sorted(seen) == [(at, p) for at, n in enumerate(index.parts) for p in range(n)]


def test_visits_are_never_broadcast(spark, monkeypatch):
    rows = rows_of(5, 300)
    table = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(3)
    index, filed, blocks = hn.indexed(table, cell_rows=4, block_rows=8)
    plans, plain = [], hn.reliable

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)
    monkeypatch.setattr(hn, "reliable", noted)
    window = F.expr(f"array(struct(0 as w, -{hn.FAR}L as lo, {hn.FAR}L as hi, cast(null as bigint) as least))")
    anchors = filed.where("id % 5 = 0").selectExpr("id as anchor", "xxhash64(label, vec) as own", "label", "vec").withColumn("windows", window)
    found = hn.best_in_windows(anchors, index, blocks, True, 3, first=2)
    assert found.count() > 150
    assert sum("SortMergeJoin" in p for p in plans) > 2 and not any("BroadcastHashJoin" in p for p in plans)
