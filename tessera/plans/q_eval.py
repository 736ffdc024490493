"""Evaluation queries on naive forecasters (previous day, previous week,
same day last year, 7-day smoother) so every metric is checkable by SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.functions.text import model_label
from tessera.operators import evaluate as ev
from tessera.operators import models as mdl
from tessera.plans import sql as Q
from tessera.plans.common import orders_features, orders_processed
from tessera.plans.registry import query, round_doubles, round_sig_cols

NAIVE = Q.NAIVE_MODELS
_M = S.METRIC_COLS


def naive_long(spark, sf_dir, processed=True):
    df = orders_processed(spark, sf_dir) if processed else orders_features(spark, sf_dir)
    return ev.to_long(df, NAIVE)


def naive_wide(spark, sf_dir):
    df = orders_processed(spark, sf_dir)
    return df.select(S.SERIES, S.SERIES_NAME, S.DT, F.col(S.Y).cast("double").alias(S.Y),
                     *[F.col(c).cast("double").alias(f"{m}_prediction") for m, c in NAIVE.items()])


def _metrics(spark, sf_dir):
    return ev.metrics(naive_long(spark, sf_dir))


_MSQL = ", ".join(f"{Q.rsig(c)} AS {c}" for c in _M)


@query("metrics_all", f"WITH {Q.preds_ctes()},\n{Q.metrics_ctes()}\nSELECT model, n, {_MSQL} FROM met")
def metrics_all(spark, sf_dir):
    """MSE, RMSE, MAE, MAPE, median APE, R2, directional accuracy, Theil's U per model."""
    return round_sig_cols(_metrics(spark, sf_dir), _M)


@query("directional_accuracy", f"WITH {Q.preds_ctes()},\n{Q.metrics_ctes()}\nSELECT model, {Q.rsig('Directional_Accuracy')} AS Directional_Accuracy FROM da")
def directional_accuracy(spark, sf_dir):
    """Direction agreement over the series-ordered concatenation (boundaries included)."""
    return round_sig_cols(ev.directional_accuracy(naive_long(spark, sf_dir)), ["Directional_Accuracy"])


@query("directional_accuracy_by_series", f"""WITH {Q.preds_ctes()},
d AS (SELECT model, series_id, y, yhat,
  lag(y) OVER (PARTITION BY model, series_id ORDER BY dt) AS py,
  lag(yhat) OVER (PARTITION BY model, series_id ORDER BY dt) AS pyhat FROM preds)
SELECT model, series_id,
  {Q.rsig("coalesce(avg(CASE WHEN py IS NULL THEN NULL WHEN ((y - py > 0) = (yhat - pyhat > 0)) THEN 1.0 ELSE 0.0 END), 0.0)")} AS Directional_Accuracy,
  count(py) AS pairs
FROM d GROUP BY model, series_id""")
def directional_accuracy_by_series(spark, sf_dir):
    return round_sig_cols(ev.directional_accuracy_by_series(naive_long(spark, sf_dir)),
                          ["Directional_Accuracy"])


@query("model_ranking", f"""WITH {Q.preds_ctes()},\n{Q.metrics_ctes()}
SELECT model, n, {_MSQL}, CAST(row_number() OVER (ORDER BY RMSE, model) AS INTEGER) AS rank FROM met""")
def model_ranking(spark, sf_dir):
    """Comparison table sorted by RMSE with its rank."""
    r = ev.ranking(_metrics(spark, sf_dir))
    return round_sig_cols(r, _M).orderBy("rank")


@query("best_models", f"""WITH {Q.preds_ctes()},\n{Q.metrics_ctes()}
SELECT arg_min(model, RMSE) AS best_model,
  arg_min(model, RMSE) FILTER (WHERE lower(model) LIKE '%naive%') AS best_family_model,
  arg_min(model, RMSE) FILTER (WHERE lower(model) NOT LIKE '%naive%') AS best_other_model
FROM met""")
def best_models(spark, sf_dir):
    """Best model overall, in one family ('naive' in the name) and outside it."""
    return ev.best_models(_metrics(spark, sf_dir), "naive")


@query("metrics_long", f"""WITH {Q.preds_ctes()},\n{Q.metrics_ctes()}
SELECT model, metric, {Q.rsig('value')} AS value FROM (
  SELECT model, 'RMSE' AS metric, RMSE AS value FROM met UNION ALL
  SELECT model, 'MAE', MAE FROM met UNION ALL
  SELECT model, 'MAPE', MAPE FROM met UNION ALL
  SELECT model, 'R2', R2 FROM met)""")
def metrics_long(spark, sf_dir):
    """Comparison bars: metrics unpivoted to (model, metric, value)."""
    return round_sig_cols(ev.metrics_long(_metrics(spark, sf_dir)), ["value"])


@query("residuals", f"WITH {Q.preds_ctes()} SELECT model, series_id, dt, y, round(yhat, 4) AS yhat, round(y - yhat, 4) AS residual FROM preds")
def residuals(spark, sf_dir):
    return round_doubles(ev.residuals(naive_long(spark, sf_dir)))


@query("error_histogram", f"""WITH {Q.preds_ctes()},
e AS (SELECT model, y - yhat AS e FROM preds),
x AS (SELECT model, min(e) AS lo, max(e) AS hi, count(*) AS n FROM e GROUP BY model),
b AS (SELECT e.model, CASE WHEN x.hi > x.lo THEN least(floor((e.e - x.lo) / (x.hi - x.lo) * 30), 29) + 1 ELSE 1 END AS bin
      FROM e JOIN x ON e.model = x.model),
c AS (SELECT model, bin, count(*) AS cnt FROM b GROUP BY model, bin),
g AS (SELECT model, lo, hi, n, CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 END AS width,
        unnest(generate_series(1, 30)) AS bin FROM x)
SELECT g.model, CAST(g.bin AS INTEGER) AS bin,
  round(g.lo + (g.bin - 1) * g.width, 4) AS bin_start, round(g.lo + g.bin * g.width, 4) AS bin_end,
  CAST(coalesce(c.cnt, 0) AS BIGINT) AS count,
  {Q.rsig('coalesce(c.cnt, 0) / (g.n * g.width)')} AS density
FROM g LEFT JOIN c ON g.model = c.model AND g.bin = c.bin""")
def error_histogram(spark, sf_dir):
    """30-bin density histogram of the errors per model (empty bins included)."""
    h = ev.error_histogram(naive_long(spark, sf_dir), 30)
    return round_sig_cols(h.withColumns({"bin": F.col("bin").cast("int"),
                                         "bin_start": F.round("bin_start", 4),
                                         "bin_end": F.round("bin_end", 4)}), ["density"])


@query("axis_extents", f"WITH {Q.preds_ctes()} SELECT least(min(y), min(yhat)) AS lo, greatest(max(y), max(yhat)) AS hi FROM preds")
def axis_extents(spark, sf_dir):
    return ev.axis_extents(naive_long(spark, sf_dir))


@query("valid_pairs", f"""WITH {Q.preds_ctes(processed=False)}
SELECT model, series_id, count(*) AS n_valid, min(dt) AS first_dt FROM preds
WHERE y IS NOT NULL AND yhat IS NOT NULL AND NOT isnan(y) AND NOT isnan(yhat)
GROUP BY model, series_id""")
def valid_pairs(spark, sf_dir):
    """Pairs left after dropping missing truth / predictions (undropped panel)."""
    v = ev.valid_pairs(naive_long(spark, sf_dir, processed=False))
    return v.groupBy("model", S.SERIES).agg(F.count(F.lit(1)).alias("n_valid"),
                                            F.min(S.DT).alias("first_dt"))


@query("recent_per_series", f"""WITH {Q.preds_ctes()}
SELECT model, series_id, dt, y, yhat, CAST(row_number() OVER (PARTITION BY model, series_id ORDER BY dt DESC) AS INTEGER) AS recent_rank
FROM preds QUALIFY recent_rank <= 30""")
def recent_per_series(spark, sf_dir):
    """Last 30 points of truth and every prediction per series (per-group top-k)."""
    r = ev.recent_per_series(naive_long(spark, sf_dir), 30)
    return r.withColumn("recent_rank", F.col("recent_rank").cast("int"))


@query("model_labels", f"""WITH {Q.preds_ctes()}
SELECT DISTINCT model, model || '_prediction' AS column_name,
  array_to_string(list_transform(string_split(model, '_'), lambda x: upper(x[1]) || lower(x[2:])), '_') AS label
FROM preds""")
def model_labels(spark, sf_dir):
    """Display label of each prediction column: strip '_prediction', title-case parts."""
    m = naive_long(spark, sf_dir).select("model").distinct()
    col = F.concat(F.col("model"), F.lit("_prediction"))
    return m.select("model", col.alias("column_name"), model_label(col).alias("label"))


_FOLDS_CTE = f"""{Q.preds_ctes()},
ix AS (SELECT *, row_number() OVER (ORDER BY series_id, dt) - 1 AS global_idx FROM proc),
nt AS (SELECT count(*) AS n, count(*) // 6 AS t FROM ix),
fx AS (SELECT ix.*, CASE WHEN global_idx >= n - 5 * t THEN CAST(floor((global_idx - (n - 5 * t)) / t) AS INTEGER) END AS test_fold,
       n, t FROM ix, nt)"""


@query("ts_split_folds", f"""WITH {_FOLDS_CTE}
SELECT test_fold AS fold, CAST(min(global_idx) AS BIGINT) AS train_rows, count(*) AS test_rows,
  arg_min(series_id, global_idx) AS first_test_series, arg_min(dt, global_idx) AS first_test_dt,
  arg_max(series_id, global_idx) AS last_test_series, arg_max(dt, global_idx) AS last_test_dt
FROM fx WHERE test_fold IS NOT NULL GROUP BY test_fold""")
def ts_split_folds(spark, sf_dir):
    """Five expanding-window folds over the (series, dt) row order: sizes and test bounds."""
    folded, total, t = mdl.ts_folds(orders_processed(spark, sf_dir))
    test = folded.where(F.col("test_fold").isNotNull())
    key = F.struct("global_idx")
    return test.groupBy(F.col("test_fold").alias("fold")).agg(
        F.min("global_idx").cast("long").alias("train_rows"), F.count(F.lit(1)).alias("test_rows"),
        F.min_by(S.SERIES, key).alias("first_test_series"), F.min_by(S.DT, key).alias("first_test_dt"),
        F.max_by(S.SERIES, key).alias("last_test_series"), F.max_by(S.DT, key).alias("last_test_dt"))


@query("cv_summary", f"""WITH {_FOLDS_CTE},
fp AS (SELECT p.model, f.test_fold, sqrt(avg((p.y - p.yhat) * (p.y - p.yhat))) AS rmse
       FROM preds p JOIN fx f ON p.series_id = f.series_id AND p.dt = f.dt
       WHERE f.test_fold IS NOT NULL GROUP BY p.model, f.test_fold)
SELECT model, {Q.rsig('avg(rmse)')} AS cv_rmse_mean, {Q.rsig('stddev_pop(rmse)')} AS cv_rmse_std,
  count(*) AS n_folds FROM fp GROUP BY model""")
def cv_summary(spark, sf_dir):
    """Fold RMSE of each naive model on the five test blocks: mean and population std."""
    folded, total, t = mdl.ts_folds(orders_processed(spark, sf_dir))
    long = ev.to_long(folded.where(F.col("test_fold").isNotNull()), NAIVE, keep=["test_fold"])
    per_fold = long.groupBy("model", "test_fold").agg(
        F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), 2))).alias("rmse"))
    s = per_fold.groupBy("model").agg(F.avg("rmse").alias("cv_rmse_mean"),
                                      F.stddev_pop("rmse").alias("cv_rmse_std"),
                                      F.count(F.lit(1)).alias("n_folds"))
    return round_sig_cols(s, ["cv_rmse_mean", "cv_rmse_std"])


@query("tail_split", f"""WITH {Q.preds_ctes()},
ix AS (SELECT series_id, dt, row_number() OVER (ORDER BY series_id, dt) - 1 AS global_idx, count(*) OVER () AS n FROM proc)
SELECT series_id, global_idx >= floor(0.8 * n) AS is_validation, count(*) AS n_rows, min(dt) AS first_dt, max(dt) AS last_dt
FROM ix GROUP BY 1, 2""")
def tail_split(spark, sf_dir):
    """Last 20 % of the (series, dt) row order flagged as validation rows."""
    from tessera.operators import panel as pnl
    df = pnl.with_global_index(orders_processed(spark, sf_dir))
    n = df.count()
    cut = int(0.8 * n)
    flagged = df.withColumn("is_validation", F.col("global_idx") >= F.lit(cut))
    return flagged.groupBy(S.SERIES, "is_validation").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(S.DT).alias("first_dt"), F.max(S.DT).alias("last_dt"))


@query("report_lines")
def report_lines(spark, sf_dir):
    """Evaluation report as ordered (line_no, line) rows."""
    return ev.report_lines(_metrics(spark, sf_dir))


_WIDE = ", ".join(f"CAST({c} AS DOUBLE) AS {m}_prediction" for m, c in NAIVE.items())
_WIDE_CTE = f"""{Q.preds_ctes()},
wide AS (SELECT series_id, series_name, dt, CAST(y AS DOUBLE) AS y, {_WIDE} FROM proc)"""
_EQ = " + ".join(f"{m}_prediction * {1.0 / len(NAIVE)!r}" for m in NAIVE)


@query("ensemble", f"WITH {_WIDE_CTE} SELECT series_id, dt, round({_EQ}, 4) AS ensemble_prediction FROM wide")
def ensemble(spark, sf_dir):
    """Equal-weight sum of every prediction column."""
    w = naive_wide(spark, sf_dir)
    cols = [c for c in w.columns if "prediction" in c]
    return w.select(S.SERIES, S.DT, F.round(ev.weighted_sum(cols), 4).alias("ensemble_prediction"))


_WEIGHTS = {"naive_lag_1_prediction": 0.5, "naive_lag_7_prediction": 0.3}
_WSQL = " + ".join(f"{m}_prediction * {_WEIGHTS.get(m + '_prediction', 1.0 / len(NAIVE))!r}" for m in NAIVE)


@query("ensemble_weighted", f"WITH {_WIDE_CTE} SELECT series_id, dt, round({_WSQL}, 4) AS ensemble_prediction FROM wide")
def ensemble_weighted(spark, sf_dir):
    """Given weights for two columns; the others fall back to 1/n (not normalised)."""
    w = naive_wide(spark, sf_dir)
    cols = [c for c in w.columns if "prediction" in c]
    return w.select(S.SERIES, S.DT, F.round(ev.weighted_sum(cols, _WEIGHTS), 4).alias("ensemble_prediction"))


@query("merge_forecasts", f"""WITH {_WIDE_CTE}
SELECT a.dt, a.series_id, a.series_name, a.naive_lag_1_prediction, a.naive_lag_7_prediction,
  b.naive_lag_365_prediction, round(b.smoother_mean_7_prediction, 4) AS smoother_mean_7_prediction
FROM wide a JOIN wide b ON a.dt = b.dt AND a.series_id = b.series_id""")
def merge_forecasts(spark, sf_dir):
    """Inner join of two forecast tables on (dt, series_id), right side projected."""
    w = naive_wide(spark, sf_dir)
    a = w.select(S.DT, S.SERIES, S.SERIES_NAME, "naive_lag_1_prediction", "naive_lag_7_prediction")
    b = w.select(S.DT, S.SERIES, "naive_lag_365_prediction",
                 F.round("smoother_mean_7_prediction", 4).alias("smoother_mean_7_prediction"))
    return a.join(b, [S.DT, S.SERIES], "inner")


@query("forecast_display", f"""WITH {_WIDE_CTE}
SELECT strftime(dt, '%Y-%m-%d') AS date, series_name, {', '.join(f'CAST(round_even({m}_prediction, 0) AS INTEGER) AS {m}_prediction' for m in NAIVE)}
FROM wide""")
def forecast_display(spark, sf_dir):
    """Display table: date as yyyy-MM-dd, predictions rounded half-even to integers."""
    w = naive_wide(spark, sf_dir)
    return w.select(F.date_format(S.DT, "yyyy-MM-dd").alias("date"), S.SERIES_NAME,
                    *[F.bround(f"{m}_prediction", 0).cast("int").alias(f"{m}_prediction") for m in NAIVE])
