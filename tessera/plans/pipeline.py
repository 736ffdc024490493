"""End-to-end run: data step, training, evaluation, forecasting, chart tables.

Every step is a Spark job over the same materialised feature frame; the
result bundle holds DataFrames (nothing is collected) plus the completion time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import evaluate as ev, features as feat, forecast as fc
from tessera.operators import models as mdl, panel as pnl, profile as prof
from tessera.sources import io, tables
from tessera.session import shared_path


def run_data_processing(spark: SparkSession, sf_dir: str, start=None, end=None,
                        source: str = "orders", materialise_to: str | None = None):
    """Panel + processed panel (materialised, reused when present), summary, null counts."""
    obs = tables.OBSERVATION_SOURCES[source](spark, sf_dir)
    raw = pnl.build_panel(obs, start, end)
    import hashlib
    digest = hashlib.sha1(f"{sf_dir.rstrip('/')}|{tables.fingerprint(spark, sf_dir)}|{source}|{start}|{end}".encode()).hexdigest()[:16]
    path = materialise_to or shared_path(spark, f"processed-{digest}.parquet")
    processed = io.load_or_compute(spark, path, lambda: feat.processed_panel(raw))
    return {"panel": raw, "processed": processed, "summary": prof.data_summary(processed),
            "null_counts": prof.null_counts(processed)}


def run_complete_pipeline(spark: SparkSession, sf_dir: str, forecast_days: int = S.FORECAST_DAYS,
                          model_params: dict | None = None, cv: bool = True, source: str = "orders",
                          model_dir: str | None = None, sequence: bool = True,
                          sequence_params: dict | None = None) -> dict:
    data = run_data_processing(spark, sf_dir, source=source)
    train = mdl.feature_frame(data["processed"])
    models, train_metrics, cv_scores = mdl.train_models(train, S.FEATURE_NAMES, cv=cv, params=model_params)
    mdl.save_models(models, model_dir or shared_path(spark, "pipeline-models"))
    # sequence model on the 30 preceding rows of every numeric column
    seq_cols = [S.Y] + S.FEATURE_NAMES
    seq_model = seq_pred = seq_hist = None
    if sequence:
        seq_model, seq_pred, seq_hist = fc.sequence_regression(data["processed"], seq_cols,
                                                               **(sequence_params or {}))
    # evaluation: score every model on the panel it was fitted on, key-aligned
    wide = fc.score(models, train, keys=(S.SERIES, S.DT, "label"))
    long = ev.to_long(wide, {n: f"{n}_prediction" for n in models}, y="label")
    if seq_pred is not None:
        long = long.unionByName(seq_pred.select(F.lit("sequence_model").alias("model"),
                                                S.SERIES, S.DT, S.Y, "yhat"))
    comparison = ev.ranking(ev.metrics(ev.valid_pairs(long)))
    report = ev.report_lines(comparison, family="sequence")
    # forecasting: direct (three pipelines) + recursive linear, joined, ensemble
    direct = fc.predict_future(models, data["panel"], forecast_days)
    intercept, coefs = fc.linear_terms(models["linear_regression"]) if "linear_regression" in models \
        else (0.0, {})
    rec = fc.roll_forward(data["panel"], intercept, coefs, forecast_days) \
        .select(S.DT, S.SERIES, F.col("yhat").alias("recursive_prediction"))
    forecasts = direct.join(rec, [S.DT, S.SERIES], "inner")
    if seq_model is not None:
        length = (sequence_params or {}).get("length", S.SEQUENCE_LENGTH)
        seq = fc.sequence_forecast(seq_model, data["panel"], seq_cols, forecast_days, length=length)
        forecasts = forecasts.join(seq.select(S.DT, S.SERIES, F.col("yhat").alias("sequence_prediction")),
                                   [S.DT, S.SERIES], "inner")
    cols = [c for c in forecasts.columns if "prediction" in c]
    forecasts = forecasts.withColumn("ensemble_prediction", ev.weighted_sum(cols))
    charts = {
        "monthly_profile": prof.monthly_profile(data["panel"]),
        "weekday_profile": prof.weekday_profile(data["panel"]),
        "trend": prof.trend_grouping_sets(data["panel"]),
        "metrics_long": ev.metrics_long(comparison),
    }
    if "random_forest" in models:
        charts["feature_importance"] = mdl.feature_importance(models["random_forest"], S.FEATURE_NAMES).limit(15)
    return {"data": data, "models": models, "train_metrics": train_metrics, "cv_scores": cv_scores,
            "sequence_history": seq_hist,
            "comparison": comparison, "report": report, "forecasts": forecasts, "charts": charts,
            "completed_at": _dt.datetime.now().isoformat(timespec="seconds")}
