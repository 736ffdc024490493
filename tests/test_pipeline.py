import datetime as dt
import math

from pyspark.sql import functions as F

from tessera.operators import clean, forecast as fc, models as mdl
from tests.conftest import SF001, panel_from_rows


def _days(start, n):
    d0 = dt.date.fromisoformat(start)
    return [(d0 + dt.timedelta(days=i)).isoformat() for i in range(n)]


def test_fill_rules_forward_fill_per_series_and_last30(spark):
    rows = [("a", d, 0) for d in _days("2024-01-01", 5)]
    df = panel_from_rows(spark, rows).withColumns({
        "x_lag_1": F.when(F.col("dt") == "2024-01-02", F.lit(7.0)),
        "x_rolling_mean_7": F.when(F.col("dt") <= "2024-01-03", F.dayofmonth("dt").cast("double"))})
    out = clean.fill_rules(df, ["x_lag_1", "x_rolling_mean_7"]).orderBy("dt").collect()
    assert [r.x_lag_1 for r in out] == [0.0, 7.0, 7.0, 7.0, 7.0]
    assert [r.x_rolling_mean_7 for r in out] == [1.0, 2.0, 3.0, 2.0, 2.0]
    out30 = clean.fill_rules(df, ["x_rolling_mean_7"], rolling_fill="last30").orderBy("dt").collect()
    assert [r.x_rolling_mean_7 for r in out30] == [1.0, 2.0, 3.0, 2.0, 2.0]


def test_minmax_constant_column_maps_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "c double, d double")
    rng = clean.minmax_fit(df, ["c", "d"])
    out = clean.minmax_scale(df, rng).collect()
    assert [r.c for r in out] == [0.0, 0.0] and sorted(r.d for r in out) == [0.0, 1.0]
    back = clean.minmax_inverse(clean.minmax_scale(df, rng), {"d": rng["d"]}).collect()
    assert sorted(r.d for r in back) == [1.0, 3.0]


def test_future_frame_and_roll_forward(spark):
    ys = list(range(1, 15))
    p = panel_from_rows(spark, [("a", d, y) for d, y in zip(_days("2024-01-01", 14), ys)])
    fut = fc.future_frame(p, 3).orderBy("dt").collect()
    assert [r.dt.isoformat() for r in fut] == ["2024-01-15", "2024-01-16", "2024-01-17"]
    assert all(r.y is None for r in fut)
    rf = fc.roll_forward(p, 0.0, {"y_lag_7": 1.0}, 10).orderBy("step").collect()
    assert [r.yhat for r in rf] == [8.0, 9, 10, 11, 12, 13, 14, 8, 9, 10]
    rf1 = fc.roll_forward(p, 1.0, {"y_lag_1": 1.0}, 3).orderBy("step").collect()
    assert [r.yhat for r in rf1] == [15.0, 16.0, 17.0]


def test_linear_terms_recover_raw_coefficients(spark):
    rows = [(float(x), float(2 * x + 3 + (x % 3) * 0.5), float(x % 3)) for x in range(40)]
    df = spark.createDataFrame(rows, "a double, label double, b double")
    m = mdl.make_pipeline("linear_regression", ["a", "b"]).fit(df)
    b0, coef = fc.linear_terms(m)
    assert math.isclose(coef["a"], 2.0, rel_tol=1e-6) and math.isclose(coef["b"], 0.5, rel_tol=1e-6)
    assert math.isclose(b0, 3.0, rel_tol=1e-6)


def test_cv_folds_match_expanding_window(spark):
    rows = [(s, d, i) for s in ("a", "b") for i, d in enumerate(_days("2024-01-01", 30))]
    folded, total, t = mdl.ts_folds(panel_from_rows(spark, rows), 5)
    assert (total, t) == (60, 10)
    got = {r.global_idx: r.test_fold for r in folded.collect()}
    assert [got[i] for i in range(60)] == [None] * 10 + [f for f in range(5) for _ in range(10)]


def test_load_or_compute_and_model_persistence(spark, tmp_path):
    from tessera.sources import io
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)
    p = str(tmp_path / "t.parquet")
    assert io.load_or_compute(spark, p, compute).count() == 3
    assert io.load_or_compute(spark, p, compute).count() == 3
    assert len(calls) == 1
    df = spark.createDataFrame([(float(x), float(x)) for x in range(10)], "a double, label double")
    models = {"linear_regression": mdl.make_pipeline("linear_regression", ["a"]).fit(df)}
    mdl.save_models(models, str(tmp_path / "m"))
    back = mdl.load_models(str(tmp_path / "m"), ["linear_regression"])
    assert back["linear_regression"].transform(df).count() == 10


def test_complete_pipeline_small_models(spark):
    from tessera.plans.pipeline import run_complete_pipeline
    params = {"random_forest": {"numTrees": 5, "maxDepth": 3}, "gradient_boosting": {"maxIter": 3, "maxDepth": 2}}
    out = run_complete_pipeline(spark, SF001, forecast_days=5, model_params=params, cv=False,
                                sequence_params={"max_iter": 3, "length": 5})
    comp = out["comparison"].collect()
    assert {r.model for r in comp} == set(mdl.MODEL_NAMES) | {"sequence_model"}
    assert "sequence_prediction" in out["forecasts"].columns
    for r in comp:
        assert math.isclose(r.RMSE ** 2, r.MSE, rel_tol=1e-9)
    fc_rows = out["forecasts"].collect()
    assert len(fc_rows) == 5 * 5 and all(r.ensemble_prediction is not None for r in fc_rows)
    imp = out["charts"]["feature_importance"].collect()
    assert len(imp) <= 15 and all(r.importance >= 0 for r in imp)
    assert out["report"].count() > 20


def test_forecast_csv_roundtrip(spark, tmp_path):
    from tessera.sources import io
    rows = [(dt.date(2024, 1, d), "s1", "one", float(d), float(2 * d)) for d in range(1, 4)]
    df = spark.createDataFrame(rows, "dt date, series_id string, series_name string, "
                                     "a_prediction double, b_prediction double")
    p = str(tmp_path / "forecasts.csv")
    io.save_table(df.coalesce(1), p)
    back = io.load_forecasts(spark, p, ["a_prediction", "b_prediction"])
    assert sorted(back.collect()) == sorted(df.collect())
    assert io.load_forecasts(spark, str(tmp_path / "missing.csv"), ["a_prediction"]) is None


def test_date_ordered_folds_never_test_before_train(spark):
    rows = [(s, d, i) for s in ("a", "b", "c") for i, d in enumerate(_days("2024-01-01", 12))]
    folded, total, t = mdl.ts_folds(panel_from_rows(spark, rows), 5, by="date")
    assert (total, t) == (36, 6)
    got = folded.collect()
    for f in range(5):
        test_days = [r.dt for r in got if r.test_fold == f]
        start = min(r.global_idx for r in got if r.test_fold == f)
        train_days = [r.dt for r in got if r.global_idx < start]
        assert max(train_days) <= min(test_days)


def test_label_encode_both_methods_agree(spark):
    df = spark.createDataFrame([(s,) for s in ["b", "a", "c", "a", "b"]], "s string")
    d, _ = clean.label_encode(df, "s", "code")
    i, _ = clean.label_encode(df, "s", "code", method="indexer")
    assert sorted(d.collect()) == sorted(i.collect())
    assert {r.s: r.code for r in d.collect()} == {"a": 0, "b": 1, "c": 2}


def test_future_features_flags_recomputed_or_copied(spark):
    # history ends on Friday 2024-12-20; the future covers the weekend and Christmas
    rows = [("a", d, 1000 + i) for i, d in enumerate(_days("2024-11-01", 50))]
    p = panel_from_rows(spark, rows)
    fresh = {r.dt.isoformat(): (r.is_weekend, r.is_holiday)
             for r in fc.future_features(p, 6).collect()}
    assert fresh["2024-12-21"] == (1, 0) and fresh["2024-12-25"] == (0, 1)
    copied = {r.dt.isoformat(): (r.is_weekend, r.is_holiday)
              for r in fc.future_features(p, 6, parity_flags=True).collect()}
    assert set(copied.values()) == {(0, 0)}  # Friday's flags carried forward
    assert len(fresh) == 6


def test_cached_load(spark, tmp_path):
    from tessera.sources import io
    p = str(tmp_path / "c.parquet")
    io.save_table(spark.range(5).withColumnRenamed("id", "v"), p)
    df = io.load_table(spark, p, cache=True)
    assert df.is_cached and df.count() == 5
    df.unpersist()
