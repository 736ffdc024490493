import json

import pytest

from tessera import schema as S
from tessera.operators import features as feat, models as mdl, panel as pnl, tuning
from tessera.sources import tables
from tests.conftest import SF001


@pytest.fixture(scope="module")
def folds(spark):
    df = mdl.feature_frame(feat.processed_panel(pnl.build_panel(tables.orders_observations(spark, SF001))))
    return tuning.fold_table(df, S.FEATURE_NAMES, n_splits=4)


CANDIDATES = {
    "linear_regression": tuning.grid(select_k=[2, 10, 29], regParam=[0.0, 1e6]),
    "random_forest": tuning.grid(numTrees=[3], maxDepth=[2, 5]),
    "gradient_boosting": tuning.grid(maxIter=[3], maxDepth=[2], stepSize=[0.1, 0.9]),
}


def test_folds_follow_time_and_share_one_table(folds):
    n = folds.rows.count()
    assert folds.size == n // 5 and folds.start(0) == n - 4 * folds.size
    for f in range(4):
        assert folds.train(f).count() == folds.start(f) and folds.test(f).count() == folds.size


def test_scores_equal_fits_of_the_plain_pipelines(folds):
    """The pre-assembled fits give the figures of pipelines that assemble their own columns."""
    small = {"random_forest": {"numTrees": 3, "maxDepth": 3}, "gradient_boosting": {"maxIter": 3, "maxDepth": 2}}
    scores = {(r.model, r.fold): r for r in tuning.cross_validate(mdl.MODEL_NAMES, folds, small).collect()}
    assert len(scores) == 12
    from pyspark.sql import functions as F
    for name in mdl.MODEL_NAMES:
        model = mdl.fit(name, folds.train(2), folds.columns, small.get(name))
        pred = model.transform(folds.test(2))
        rmse = pred.agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0] ** 0.5
        assert scores[name, 2].rmse == pytest.approx(rmse, rel=1e-9)
        assert (scores[name, 2].train_rows, scores[name, 2].test_rows) == (folds.start(2), folds.size)


def test_race_against_exhaustive_search(folds):
    every = tuning.race(CANDIDATES, folds, keep=1).collect()
    assert len(every) == 10 and all(r.folds == 4 and r.rung == 0 for r in every)
    mean = {(r.model, r.params): r.rmse_mean for r in every}
    for (name, params), m in list(mean.items())[:3]:
        own = [tuning.fold_rmse(name, folds, f, json.loads(params)) for f in range(4)]
        assert (m, tuning.mean_and_deviation(own)[0]) == (pytest.approx(sum(own) / 4), pytest.approx(m))
    raced = tuning.race(CANDIDATES, folds, keep=0.5).collect()
    for name, own in CANDIDATES.items():
        best = [r for r in raced if r.model == name and r.best]
        assert len(best) == 1 and best[0].folds == 4
        assert best[0].rmse_mean == pytest.approx(mean[name, best[0].params])
        assert best[0].params == min((m, p) for (n, p), m in mean.items() if n == name)[1]
        first = [r for r in raced if r.model == name and r.rung == 0]
        assert len(first) == len(own) and sum(r.kept for r in first) == -(-len(own) // 2)
        assert max(r.rmse_mean for r in first if r.kept) <= min(r.rmse_mean for r in first if not r.kept)


def test_rungs():
    assert tuning.rungs(5, 8, 0.5) == [1, 2, 4, 5] and tuning.rungs(5, 1, 0.5) == [5] and tuning.rungs(5, 8, 1) == [5]
    assert tuning.rungs(1, 8, 0.5) == [1] and tuning.rungs(5, 2, 0.5) == [1, 5]


def test_too_few_rows(spark):
    none = spark.createDataFrame([], "series_id string, dt date, label double, x double")
    with pytest.raises(ValueError, match="too few"):
        tuning.fold_table(none, ["x"])
