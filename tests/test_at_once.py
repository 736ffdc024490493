"""Fits that do not depend on each other are submitted together, and the orders are read once for all of them."""

import threading

import pytest

from tessera import schema as S
from tessera.operators import features as feat, models as mdl, panel as pnl, tuning
from tessera.plans import common, q_forecast, q_models
from tessera.sources import tables
from tests.conftest import SF001


@pytest.fixture(scope="module")
def train(spark):
    return mdl.reliable(mdl.feature_frame(feat.processed_panel(pnl.build_panel(tables.orders_observations(spark, SF001)))))


def met(parties, value):
    """A call that returns only after ``parties`` of its kind run at the same time."""
    gate = threading.Barrier(parties)

    def call(*_, **__):
        gate.wait(60)
        return value
    return call


def test_final_fits_run_at_once(spark, train, monkeypatch):
    monkeypatch.setattr(mdl, "fit", met(3, "model"))
    monkeypatch.setattr(mdl, "fitted_values", lambda models, df: df.selectExpr("'m' model", "series_id", "dt", "label y", "label yhat"))
    models, _, cv = mdl.train_models(train, S.FEATURE_NAMES, cv=False)
    assert list(models) == mdl.MODEL_NAMES and cv is None


def test_folds_use_the_cores(spark, train, monkeypatch):
    cores = min(15, spark.sparkContext.defaultParallelism)
    if cores < 5:
        pytest.skip("needs more than four cores")
    gate = threading.Semaphore(0)
    monkeypatch.setattr(tuning, "fold_rmse", lambda name, folds, fold, params=None: (gate.release(), waited(gate, cores), float(fold))[2])
    folds = tuning.fold_table(train, S.FEATURE_NAMES)
    scores = tuning.cross_validate(mdl.MODEL_NAMES, folds).collect()
    assert [(r.model, r.fold, r.rmse) for r in scores] == sorted((n, f, float(f)) for n in mdl.MODEL_NAMES for f in range(5))


def waited(gate, count, seconds=60):
    """Wait until ``gate`` was released ``count`` times in all (nobody takes from it)."""
    import time
    end = time.time() + seconds
    while gate._value < count:
        assert time.time() < end, f"{gate._value} of {count} calls at the same time"
        time.sleep(0.01)


def test_boosting_without_kept_node_ids_grows_the_same_trees(train):
    small = dict(maxIter=4, maxDepth=4)
    plain = mdl.fit("gradient_boosting", train, S.FEATURE_NAMES, small).stages[-1]
    kept = mdl.fit("gradient_boosting", train, S.FEATURE_NAMES, small | {"cacheNodeIds": True}).stages[-1]
    assert plain.toDebugString.split("\n")[1:] == kept.toDebugString.split("\n")[1:]
    assert not plain.getCacheNodeIds() and kept.getCacheNodeIds()


def test_train_metrics_scores_and_fits_together_on_one_table(spark, monkeypatch):
    seen, gate = [], threading.Barrier(2)
    one_score = spark.createDataFrame([("m", 0, 1, 1, 2.0)], tuning.SCORES)
    one_metric = spark.createDataFrame([("m", 1.0)], "model string, RMSE double")

    def scores(spark, sf_dir, frame):
        gate.wait(60)
        seen.append(frame())
        return one_score

    def fits(df, cols, cv):
        gate.wait(60)
        seen.append(df)
        return {}, one_metric, None
    monkeypatch.setattr(q_models, "stored_scores", scores)
    monkeypatch.setattr(mdl, "train_models", fits)
    monkeypatch.setattr(q_models.ev, "ranking", lambda df: df)
    assert q_models.train_metrics(spark, SF001).first().cv_rmse_mean == 2.0
    assert seen[0] is seen[1] and not any("orders" in f for f in seen[0].inputFiles())


def test_written_panel_equals_the_panel(spark):
    assert sorted(common.written_panel(spark, SF001).collect()) == sorted(common.orders_panel(spark, SF001).collect())


def test_model_summary_scores_and_fits_together_on_one_table(spark, train, monkeypatch):
    seen, gate = [], threading.Barrier(2)
    model = mdl.fit("linear_regression", train, S.FEATURE_NAMES)

    def given(value):
        def call(spark, sf_dir, frame):
            gate.wait(60)
            seen.append(frame())
            return value
        return call
    monkeypatch.setattr(q_models, "stored_scores", given(spark.createDataFrame([("linear_regression", 0, 1, 1, 2.0)], tuning.SCORES)))
    monkeypatch.setattr(q_models, "stored_models", given({"linear_regression": model}))
    row = q_models.model_summary(spark, SF001).first()
    assert row.cv_rmse_mean == 2.0 and row.n == train.count()
    assert seen[0] is seen[1] and not any("orders" in f for f in seen[0].inputFiles())


def test_missing_models_are_fitted_together(spark, train, monkeypatch):
    import uuid

    from tessera.operators import model_store
    asked, tag = [], uuid.uuid4().hex  # the store may outlive the session
    small = {n: mdl.fit("linear_regression", train, S.FEATURE_NAMES) for n in ("linear_regression", "random_forest")}
    monkeypatch.setattr(mdl, "fit_all", lambda names, df, cols: asked.append(list(names)) or {n: small[n] for n in names})
    got = model_store.get_models(spark, SF001, list(small), lambda: train, S.FEATURE_NAMES, tag=tag)
    again = model_store.get_models(spark, SF001, list(small), lambda: train, S.FEATURE_NAMES, tag=tag)
    assert asked == [list(small)] and got == small == again


class _Stop(Exception):
    pass


def _frame_of(query, spark, monkeypatch):
    """The files that the training frame of a forecast query is read from."""
    def models(spark, sf_dir, names=None, frame=None):
        raise _Stop(frame().inputFiles())
    monkeypatch.setattr(q_forecast, "stored_models", models)
    with pytest.raises(_Stop) as stop:
        query(spark, SF001)
    return stop.value.args[0]


def test_roll_forward_trees_reads_orders_once(spark, monkeypatch):
    files = _frame_of(q_forecast.roll_forward_trees, spark, monkeypatch)
    assert files and not any("orders" in f for f in files)


def test_predict_future_reads_orders_once(spark, monkeypatch):
    files = _frame_of(q_forecast.predict_future, spark, monkeypatch)
    assert files and not any("orders" in f for f in files)
