"""Forecast queries: future frame and features, scoring, roll-forward,
overlay, and the end-to-end forecast and evaluation runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import evaluate as ev, features as feat, forecast as fc
from tessera.operators import model_store
from tessera.operators import panel as pnl, tree_roll
from tessera.plans import sql as Q
from tessera.plans.common import orders_panel, orders_processed, written_panel
from tessera.plans.q_models import _FEATS, stored_models, training_frame, written_frame
from tessera.plans.registry import query, round_doubles
from tessera.session import shared_path

H = S.FORECAST_DAYS

_FUT_CTES = f"""{Q.panel_ctes()},
mx AS (SELECT max(dt) AS last_dt FROM panel),
lastrow AS (SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY dt DESC) = 1),
fut AS (SELECT l.series_id, l.series_name,
  CAST(unnest(generate_series(CAST(m.last_dt + 1 AS TIMESTAMP), CAST(m.last_dt + {H} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dt,
  CAST(NULL AS BIGINT) AS y FROM lastrow l CROSS JOIN mx m),
comb AS (SELECT series_id, series_name, dt, y FROM panel UNION ALL SELECT series_id, series_name, dt, y FROM fut)"""


@query("future_frame", f"WITH {_FUT_CTES} SELECT series_id, series_name, dt, y FROM fut")
def future_frame(spark, sf_dir):
    """Each series' last row copied to the 30 days after the last date (target unknown)."""
    return fc.future_frame(orders_panel(spark, sf_dir), H)


@query("history_plus_future", f"""WITH {_FUT_CTES}
SELECT series_id, count(*) AS n_rows, count(y) AS n_known, max(dt) AS last_dt FROM comb GROUP BY series_id""")
def history_plus_future(spark, sf_dir):
    """Bag union of history and future rows (per-series row counts)."""
    p = orders_panel(spark, sf_dir)
    u = fc.history_plus_future(p, fc.future_frame(p, H))
    return u.groupBy(S.SERIES).agg(F.count(F.lit(1)).alias("n_rows"), F.count(S.Y).alias("n_known"),
                                   F.max(S.DT).alias("last_dt"))


def _future_sql(cols: list[str]) -> str:
    part = "PARTITION BY series_id ORDER BY dt"
    raw = dict(Q.calendar_sql())
    raw.update(Q.cyclic_sql(None))
    raw.update(Q.window_sql(digits=None))
    sel = ",\n  ".join(f"{raw[c]} AS {c}" for c in S.FEATURE_NAMES)
    fills = []
    for c in S.FEATURE_NAMES:
        if "lag" in c:
            e = f"coalesce(last_value({c} IGNORE NULLS) OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)"
        elif "rolling" in c:
            e = f"coalesce({c}, avg({c}) OVER (), 0)"
        else:
            e = f"coalesce({c}, 0)"
        fills.append(f"{e} AS {c}")
    outs = []
    for c in cols:
        if c in S.CYCLIC_COLS:
            outs.append(f"round({c}, 6) AS {c}")
        elif c in S.ROLLING_COLS or c in S.LAG_COLS:
            outs.append(f"round(CAST({c} AS DOUBLE), 4) AS {c}")
        else:
            outs.append(c)
    return f"""WITH {_FUT_CTES},
cf AS (SELECT series_id, series_name, dt, y,
  {sel}
  FROM comb),
ff AS (SELECT series_id, series_name, dt, y, {', '.join(fills)} FROM cf)
SELECT series_id, dt, {', '.join(outs)} FROM ff, mx WHERE dt > mx.last_dt"""


_FUT_COLS = S.FEATURE_NAMES


@query("future_features", _future_sql(_FUT_COLS))
def future_features(spark, sf_dir):
    """Features of the future rows: recomputed on history + future (missing y skipped), then
    the fill rules (lags forward-filled per series, rolling -> column mean, rest -> 0)."""
    f = fc.future_features(orders_panel(spark, sf_dir), H)
    return round_doubles(f.select(S.SERIES, S.DT, *_FUT_COLS), 4, {c: 6 for c in S.CYCLIC_COLS})


@query("ffill_lags", _future_sql(S.LAG_COLS))
def ffill_lags(spark, sf_dir):
    """Lag columns of the future rows after the per-series forward fill."""
    f = fc.future_features(orders_panel(spark, sf_dir), H)
    return round_doubles(f.select(S.SERIES, S.DT, *S.LAG_COLS), 4)


@query("forecast_overlay", f"""WITH {_FUT_CTES},
lasty AS (SELECT series_id, y FROM lastrow),
{Q.features_cte(digits_cyclic=None, digits_roll=None)},
fitted AS (SELECT series_id, dt, {', '.join(f"{c} AS {m}" for m, c in Q.NAIVE_MODELS.items())},
  row_number() OVER (PARTITION BY series_id ORDER BY dt DESC) AS k FROM feat)
SELECT p.series_id, p.dt, 'actual' AS kind, CAST(p.y AS DOUBLE) AS value FROM panel p
UNION ALL
{' UNION ALL '.join(f"SELECT series_id, dt, '{m}' AS kind, CAST({m} AS DOUBLE) AS value FROM fitted WHERE k <= 30" for m in Q.NAIVE_MODELS)}
UNION ALL
SELECT f.series_id, f.dt, 'forecast' AS kind, CAST(l.y AS DOUBLE) AS value FROM fut f JOIN lasty l ON f.series_id = l.series_id""")
def forecast_overlay(spark, sf_dir):
    """Chart table: the whole history, every naive model's values for the last 30 rows of each
    series, and a 30-day last-value forecast, tagged by kind."""
    p = orders_panel(spark, sf_dir)
    last_dt = fc.last_date(p)
    hist = p.select(S.SERIES, S.DT, F.lit("actual").alias("kind"), F.col(S.Y).cast("double").alias("value"))
    fitted = ev.recent_per_series(ev.to_long(feat.add_features(p), Q.NAIVE_MODELS), 30) \
        .select(S.SERIES, S.DT, F.col("model").alias("kind"), F.col("yhat").alias("value"))
    lasty = pnl.latest_rows(p).select(S.SERIES, F.col(S.Y).cast("double").alias("value"))
    fut = fc.future_frame(p, H, last_dt).select(S.SERIES, S.DT).join(lasty, S.SERIES) \
        .select(S.SERIES, S.DT, F.lit("forecast").alias("kind"), "value")
    return hist.unionByName(fitted).unionByName(fut)


@query("predict_future")
def predict_future(spark, sf_dir):
    """30-day forecast of the three stored pipelines on the recomputed future features."""
    panel = written_panel(spark, sf_dir)
    models = stored_models(spark, sf_dir, frame=lambda: written_frame(panel))
    return fc.predict_future(models, panel, H)


def _roll(spark, sf_dir):
    lr = stored_models(spark, sf_dir, ["linear_regression"])["linear_regression"]
    intercept, coefs = fc.linear_terms(lr)
    return fc.roll_forward(orders_panel(spark, sf_dir), intercept, coefs, H)


def stored_sequence(spark, sf_dir):
    return model_store.get_sequence(spark, sf_dir, lambda: orders_processed(spark, sf_dir), [S.Y] + _FEATS)


@query("sequence_summary")
def sequence_summary(spark, sf_dir):
    """The stored sequence model: window length, columns, trees, final and best losses."""
    m = stored_sequence(spark, sf_dir)
    best = min(m.losses, key=lambda r: r[2])
    row = (m.length, len(m.columns), m.model.getNumTrees, m.losses[-1][1], m.losses[-1][2], best[0], best[2])
    return spark.createDataFrame([row], "length int, n_columns int, n_trees int, final_loss double, "
                                        "final_val_loss double, best_iter int, best_val_loss double")


@query("roll_forward")
def roll_forward(spark, sf_dir):
    """Recursive 30-step forecast: each predicted day feeds the next day's lags and windows."""
    return _roll(spark, sf_dir)


def _sequence(spark, sf_dir):
    model = stored_sequence(spark, sf_dir)
    return fc.sequence_forecast(model, orders_panel(spark, sf_dir), model.columns, H)


@query("sequence_forecast")
def sequence_forecast(spark, sf_dir):
    """30-day forecast of the sequence model: each step predicts from the last 30 scaled
    feature rows, derives the new day's features from the history plus the prediction
    and rolls the window."""
    return _sequence(spark, sf_dir)


_FIXED = [  # FIXED VALUES: two small trees over four features, as (feature, threshold, left, right, value) per node
    (0.7, [("y_lag_1", 1e5, 1, 4, 0.0), ("y_lag_7", 1.5e5, 2, 3, 0.0), (None, 0.0, -1, -1, 9e4), (None, 0.0, -1, -1, 2.1e5),
           ("y_rolling_mean_7", 2.5e5, 5, 6, 0.0), (None, 0.0, -1, -1, 1.8e5), (None, 0.0, -1, -1, 3.2e5)]),
    (0.4, [("day_of_week", 3.5, 1, 4, 0.0), ("y_lag_7", 1.2e5, 2, 3, 0.0), (None, 0.0, -1, -1, 1.1e5), (None, 0.0, -1, -1, 2.6e5),
           ("y_rolling_mean_7", 2e5, 5, 6, 0.0), (None, 0.0, -1, -1, 1.4e5), (None, 0.0, -1, -1, 2.4e5)])]
_FIXED_COLS = ["y_lag_1", "y_lag_7", "y_rolling_mean_7", "day_of_week"]


@query("roll_forward_fixed_trees", f"""WITH RECURSIVE {Q.panel_ctes()},
ranked AS (SELECT series_id, dt, CAST(y AS DOUBLE) AS y, row_number() OVER (PARTITION BY series_id ORDER BY dt DESC) AS rn FROM panel),
start AS (SELECT series_id, max(dt) AS last_dt, list(y ORDER BY dt) AS h FROM ranked WHERE rn <= 365 GROUP BY series_id),
roll AS (
  SELECT series_id, last_dt, h, 0 AS step FROM start
  UNION ALL
  SELECT series_id, last_dt, list_append(h,
      0.7 * CASE WHEN h[-1] <= 1e5 THEN CASE WHEN h[-7] <= 1.5e5 THEN 9e4 ELSE 2.1e5 END
                 WHEN list_avg(h[-6:]) <= 2.5e5 THEN 1.8e5 ELSE 3.2e5 END
    + 0.4 * CASE WHEN isodow(last_dt + CAST(step + 1 AS INTEGER)) - 1 <= 3.5 THEN CASE WHEN h[-7] <= 1.2e5 THEN 1.1e5 ELSE 2.6e5 END
                 WHEN list_avg(h[-6:]) <= 2e5 THEN 1.4e5 ELSE 2.4e5 END), step + 1
  FROM roll WHERE step < 30)
SELECT series_id, CAST(last_dt + CAST(step AS INTEGER) AS DATE) AS dt, CAST(step AS INTEGER) AS step, round(h[-1], 4) AS yhat
FROM roll WHERE step > 0""")
def roll_forward_fixed_trees(spark, sf_dir):
    """Recursive 30-step forecast of two stated trees, walked inside the fold over the horizon."""
    node = "named_struct('feature', {}, 'threshold', {}D, 'left', {}, 'right', {}, 'value', {}D)"
    trees = ", ".join(f"named_struct('weight', {w}D, 'nodes', array(" + ", ".join(
        node.format(_FIXED_COLS.index(c) if c else -1, *rest) for c, *rest in nodes) + "))" for w, nodes in _FIXED)
    one = spark.range(1).select(F.expr(f"array({trees})").cast(tree_roll.TREES).alias("trees"))
    return round_doubles(tree_roll.roll_forward(orders_panel(spark, sf_dir), one, 2, _FIXED_COLS, H), 4)


@query("roll_forward_trees")
def roll_forward_trees(spark, sf_dir):
    """Recursive 30-step forecasts of the stored forest and boosting models, each one expression per series."""
    panel = written_panel(spark, sf_dir)
    models = stored_models(spark, sf_dir, ["random_forest", "gradient_boosting"], lambda: written_frame(panel))
    rows = [tree_roll.roll_forward(panel, tree_roll.trees_of(m), tree_roll.depth_of(m), _FEATS, H).select(F.lit(n).alias("model"), "*")
            for n, m in models.items()]
    return rows[0].unionByName(rows[1])


@query("roll_forward_sequence")
def roll_forward_sequence(spark, sf_dir):
    """The 30-day forecast of the stored sequence model as one expression per series."""
    return tree_roll.sequence_roll_forward(stored_sequence(spark, sf_dir), orders_panel(spark, sf_dir), H)


@query("forecast_run")
def forecast_run(spark, sf_dir):
    """Forecast table: three pipelines (direct), the recursive linear forecast and the
    sequence model joined on (dt, series_id), plus the equal-weight ensemble; also written
    as CSV to the shared folder."""
    import uuid
    direct = fc.predict_future(stored_models(spark, sf_dir), orders_panel(spark, sf_dir), H)
    rec = _roll(spark, sf_dir).select(S.DT, S.SERIES, F.col("yhat").alias("recursive_prediction"))
    seq = _sequence(spark, sf_dir).select(S.DT, S.SERIES, F.col("yhat").alias("sequence_prediction"))
    wide = direct.join(rec, [S.DT, S.SERIES], "inner").join(seq, [S.DT, S.SERIES], "inner")
    cols = [c for c in wide.columns if "prediction" in c]
    out = wide.withColumn("ensemble_prediction", ev.weighted_sum(cols)).orderBy(S.SERIES, S.DT)
    from tessera.sources import io
    path = shared_path(spark, f"forecasts-{uuid.uuid4().hex}.csv")
    io.save_table(out, path)  # a folder of part files: no single-task write at scale
    return out


@query("evaluation_run")
def evaluation_run(spark, sf_dir):
    """Score the stored pipelines and the sequence model on the panel (key-aligned),
    keep valid pairs, compare and rank."""
    models = stored_models(spark, sf_dir)
    df = training_frame(spark, sf_dir)
    wide = fc.score(models, df, keys=(S.SERIES, S.DT, "label"))
    long = ev.to_long(wide, {n: f"{n}_prediction" for n in models}, y="label")
    seq = stored_sequence(spark, sf_dir).predictions(orders_processed(spark, sf_dir))
    seq_long = seq.select(F.lit("sequence_model").alias("model"), S.SERIES, S.DT, S.Y, "yhat")
    return ev.ranking(ev.metrics(ev.valid_pairs(long.unionByName(seq_long)))).orderBy("rank")
