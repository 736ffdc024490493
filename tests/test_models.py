import math

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import features as feat, models as mdl, panel as pnl
from tessera.sources import tables
from tests.conftest import SF001


def test_features_invariant_to_input_partitioning(spark):
    obs = tables.orders_observations(spark, SF001)
    a = feat.processed_panel(pnl.build_panel(obs))
    b = feat.processed_panel(pnl.build_panel(obs.repartition(7, "amount").sortWithinPartitions(F.rand(1))))
    assert sorted(a.collect()) == sorted(b.collect())


def _train(spark):
    df = mdl.feature_frame(feat.processed_panel(pnl.build_panel(tables.orders_observations(spark, SF001))))
    return mdl.reliable(df)


def test_forest_seed_repeatable_importance_sums_to_one(spark):
    df = _train(spark)
    small = {"numTrees": 4, "maxDepth": 3}
    m1 = mdl.fit("random_forest", df, S.FEATURE_NAMES, small)
    m2 = mdl.fit("random_forest", df, S.FEATURE_NAMES, small)
    p1 = m1.transform(df).select(S.SERIES, S.DT, "prediction")
    p2 = m2.transform(df).select(S.SERIES, S.DT, "prediction")
    assert sorted(p1.collect()) == sorted(p2.collect())
    assert p1.count() == df.select(S.SERIES, S.DT).distinct().count()  # one prediction per key
    imp = mdl.feature_importance(m1, S.FEATURE_NAMES).collect()
    assert math.isclose(sum(r.importance for r in imp), 1.0, rel_tol=1e-9)
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)


def test_linear_pipeline_uses_top20_and_metrics_consistent(spark):
    df = _train(spark)
    models, metrics, _ = mdl.train_models(df, S.FEATURE_NAMES, names=["linear_regression"], cv=False)
    m = models["linear_regression"]
    assert len(m.stages[0].getInputCols()) == 20
    assert mdl.feature_importance(m).count() == 0  # linear models have no importances
    r = metrics.first()
    assert math.isclose(r.RMSE ** 2, r.MSE, rel_tol=1e-12)
    assert r.n == df.count()


def test_sequence_forecast_shape_and_determinism(spark):
    import datetime as dt

    from tessera.operators import clean, forecast as fc
    from tests.conftest import panel_from_rows
    d0 = dt.date(2024, 1, 1)
    rows = [(s, (d0 + dt.timedelta(days=i)).isoformat(), 1000 + (i * (7 if s == "a" else 3)) % 50)
            for s in ("a", "b") for i in range(60)]
    panel = panel_from_rows(spark, rows)
    train = clean.fill_rules(feat.add_features(panel), S.FEATURE_NAMES)
    cols = [S.Y] + S.FEATURE_NAMES
    model, pred, hist = fc.sequence_regression(train, cols, length=5, max_iter=3)
    assert hist.count() >= 1 and pred.count() == 2 * (60 - 5)
    out1 = fc.sequence_forecast(model, panel, cols, horizon=4, length=5).collect()
    out2 = fc.sequence_forecast(model, panel, cols, horizon=4, length=5).collect()
    assert sorted(out1) == sorted(out2)
    assert sorted((r.series_id, r.step, r.dt.isoformat()) for r in out1) == sorted(
        (s, k, (d0 + dt.timedelta(days=59 + k)).isoformat()) for s in ("a", "b") for k in range(1, 5))
    assert all(r.yhat is not None for r in out1)
