import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import clean, features as feat, forecast as fc, models as mdl, tree_roll
from tests.conftest import panel_from_rows

D0 = dt.date(2023, 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(s, (D0 + dt.timedelta(days=i)).isoformat(), int(1000 + 300 * math.sin(i / (5 if s == "a" else 9)) + (i * 37) % 101))
            for s in ("a", "b", "c") for i in range(430 if s != "c" else 40)]
    return mdl.reliable(panel_from_rows(spark, rows))


@pytest.fixture(scope="module")
def train(panel):
    return mdl.reliable(mdl.feature_frame(feat.processed_panel(panel)))


def step_loop(model, panel, horizon):
    """Day by day with the model's own transform: the brute force."""
    hist = {r.series_id: [] for r in panel.select(S.SERIES).distinct().collect()}
    last = {}
    for r in sorted(panel.collect(), key=lambda r: r.dt):
        hist[r.series_id].append(float(r.y))
        last[r.series_id] = r.dt
    out = {}
    spark = panel.sparkSession
    for step in range(1, horizon + 1):
        rows = [(s, last[s] + dt.timedelta(days=step), h[-365:]) for s, h in hist.items()]
        df = spark.createDataFrame(rows, "series_id string, d date, s array<double>")
        f = fc.step_features(F.col("s"), F.col("d"))
        df = df.select(S.SERIES, "d", *[F.coalesce(f[c].cast("double"), F.lit(0.0)).alias(c) for c in S.FEATURE_NAMES])
        for r in model.transform(df).select(S.SERIES, "d", "prediction").collect():
            hist[r.series_id].append(r.prediction)
            out[r.series_id, r.d, step] = r.prediction
    return out


@pytest.mark.parametrize("name,params", [("random_forest", {"numTrees": 5, "maxDepth": 6}), ("gradient_boosting", {"maxIter": 6, "maxDepth": 4})])
def test_equals_the_step_loop(panel, train, name, params):
    model = mdl.fit(name, train, S.FEATURE_NAMES, params)
    got = tree_roll.roll_forward(panel, tree_roll.trees_of(model), tree_roll.depth_of(model), S.FEATURE_NAMES, 6)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    want = step_loop(model, panel, 6)
    rows = {(r.series_id, r.dt, r.step): r.yhat for r in got.collect()}
    assert rows.keys() == want.keys() and len({round(v, 3) for v in want.values()}) > 6
    for k, v in want.items():
        assert rows[k] == pytest.approx(v, rel=1e-9)


def test_single_leaf_trees(panel, spark):
    flat = spark.createDataFrame([(float(i), 7.0) for i in range(20)], "x double, label double")
    model = mdl.fit("random_forest", flat, ["x"], {"numTrees": 2, "maxDepth": 3})
    assert tree_roll.depth_of(model) == 0
    got = tree_roll.roll_forward(panel, tree_roll.trees_of(model), 0, ["y_lag_1"], 2).collect()
    assert len(got) == 6 and all(r.yhat == 7.0 for r in got)


def test_sequence_equals_the_step_loop(panel):
    filled = clean.fill_rules(feat.add_features(panel), S.FEATURE_NAMES)
    model = fc.fitted_sequence(filled, [S.Y] + S.FEATURE_NAMES, length=5, max_iter=4)
    got = {(r.series_id, r.dt, r.step): r.yhat for r in tree_roll.sequence_roll_forward(model, panel, 5).collect()}
    want = {(r.series_id, r.dt, r.step): r.yhat for r in fc.sequence_forecast(model, panel, model.columns, 5).collect()}
    assert got.keys() == want.keys() and len(want) == 15
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


def test_empty_panel(panel, train):
    model = mdl.fit("random_forest", train, S.FEATURE_NAMES, {"numTrees": 1, "maxDepth": 2})
    assert tree_roll.roll_forward(panel.where("false"), tree_roll.trees_of(model), 2, S.FEATURE_NAMES, 3).count() == 0
