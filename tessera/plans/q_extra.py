"""Sequence tables, report parsing, exports, recursive-forecast check, drift and
paired-loss tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera import schema as S
from tessera.operators import evaluate as ev, features as feat, forecast as fc, profile as prof
from tessera.operators import panel as pnl
from tessera.plans import sql as Q
from tessera.plans.common import orders_panel, orders_processed
from tessera.plans.q_eval import NAIVE, naive_long, naive_wide, _metrics
from tessera.plans.registry import query, round_doubles, round_sig_cols
from tessera.session import shared_path
from tessera.sources import io

_P = f"WITH {Q.panel_ctes()}"


def _join_ints(arr_col):
    return F.array_join(F.transform(arr_col, lambda x: x.cast("long").cast("string")), ",")


@query("sequence_windows", f"""{_P},
w AS (SELECT series_id, dt, CAST(y AS DOUBLE) AS target,
  list(y) OVER (PARTITION BY series_id ORDER BY dt ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS win FROM panel)
SELECT series_id, dt, target, array_to_string(win, ',') AS window_y FROM w WHERE len(win) = 30""")
def sequence_windows(spark, sf_dir):
    """Inputs = the 30 preceding values of y (oldest first), target = y; incomplete histories dropped."""
    w = feat.sequence_windows(orders_panel(spark, sf_dir), [S.Y], 30)
    return w.select(S.SERIES, S.DT, "target", _join_ints(F.transform("window", lambda r: r[0])).alias("window_y"))


@query("last_sequence", f"""{_P},
t AS (SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY dt DESC) <= 30)
SELECT series_id, max(dt) AS last_dt, array_to_string(list(y ORDER BY dt), ',') AS window_y FROM t
GROUP BY series_id HAVING count(*) = 30""")
def last_sequence(spark, sf_dir):
    """The last 30 values of every series (series shorter than 30 are skipped)."""
    ls = feat.last_sequence(orders_panel(spark, sf_dir), [S.Y], 30)
    return ls.select(S.SERIES, "last_dt", _join_ints(F.transform("window", lambda r: r[0])).alias("window_y"))


_FIRST10 = [S.Y] + S.FEATURE_NAMES[:9]


def _corr10_sql():
    cols = _FIRST10
    aggs = [f"stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            aggs.append(f"covar_pop(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) AS c{i}_{j}")
    rows = []
    for i in range(len(cols)):
        for j in range(len(cols)):
            a, b = min(i, j), max(i, j)
            if i == j:
                r = f"CASE WHEN s{i} = 0 THEN NULL ELSE 1.0 END"
            else:
                r = f"CASE WHEN s{a} * s{b} = 0 THEN NULL ELSE c{a}_{b} / (s{a} * s{b}) END"
            rows.append(f"SELECT '{cols[i]}' AS col_a, {i} AS pos_a, '{cols[j]}' AS col_b, {j} AS pos_b, {r} AS corr FROM m")
    return f"""WITH {Q.panel_ctes()},
{Q.features_cte(digits_cyclic=None, digits_roll=None)},
proc AS (SELECT * FROM feat WHERE {Q.not_null_all(S.FEATURE_NAMES)}),
m AS (SELECT {', '.join(aggs)} FROM proc),
u AS ({' UNION ALL '.join(rows)})
SELECT col_a, CAST(pos_a AS INTEGER) AS pos_a, col_b, CAST(pos_b AS INTEGER) AS pos_b, round(corr, 6) AS corr FROM u"""


@query("corr_first10", _corr10_sql())
def corr_first10(spark, sf_dir):
    """Correlation of the default column choice: the first 10 numeric columns (by schema)."""
    df = orders_processed(spark, sf_dir)
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)][:10]
    return round_doubles(prof.corr_matrix(df, cols), 6)


@query("roll_forward_seasonal", f"""{_P},
mx AS (SELECT series_id, max(dt) AS last_dt FROM panel GROUP BY 1),
h AS (SELECT CAST(unnest(generate_series(1, 30)) AS INTEGER) AS step)
SELECT m.series_id, CAST(m.last_dt + h.step AS DATE) AS dt, h.step AS step, CAST(p.y AS DOUBLE) AS yhat
FROM mx m CROSS JOIN h JOIN panel p ON p.series_id = m.series_id AND p.dt = m.last_dt - 7 + ((h.step - 1) % 7) + 1""")
def roll_forward_seasonal(spark, sf_dir):
    """Recursive roll-forward with fixed coefficients (y = previous week's value): from step 8 on
    the forecast reads its own earlier predictions, so it repeats the last observed week."""
    out = fc.roll_forward(orders_panel(spark, sf_dir), 0.0, {"y_lag_7": 1.0}, 30)
    return out.withColumn("step", F.col("step").cast("int"))


@query("report_parse")
def report_parse(spark, sf_dir):
    """Write the evaluation report as text to the shared folder, read it back and parse the
    comparison block into a table (row, column named by the header line, value)."""
    path = shared_path(spark, f"report-{uuid.uuid4().hex}")
    io.write_text_lines(ev.report_lines(_metrics(spark, sf_dir)), path)
    return io.report_comparison_table(io.read_report_comparison(spark, path)).drop("file")


_SLICE_SQL = f"""{_P}
SELECT series_id, series_name, dt, y FROM panel WHERE series_id = '4-NOT SPECIFIED' AND dt BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"""


@query("export_slice", _SLICE_SQL)
def export_slice(spark, sf_dir):
    """CSV export of a filtered slice (with header) and its schema-typed read-back."""
    path = shared_path(spark, f"slice-{uuid.uuid4().hex}.csv")
    sl = pnl.filter_series_range(orders_panel(spark, sf_dir), "4-NOT SPECIFIED", "2000-01-01", "2000-12-31")
    io.save_table(sl, path)
    return io.load_table(spark, path, schema=sl.schema).select(S.SERIES, S.SERIES_NAME, S.DT, S.Y)


_DRIFT_SQL = f"""WITH {Q.preds_ctes()},
e AS (SELECT model, series_id, dt, (y - yhat) * (y - yhat) AS se FROM preds),
r AS (SELECT model, series_id, dt,
  sqrt(avg(se) OVER (PARTITION BY model, series_id ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) AS rolling_rmse,
  sqrt(avg(se) OVER (PARTITION BY model, series_id)) AS baseline_rmse FROM e)
SELECT model, series_id, dt, {Q.rsig('rolling_rmse')} AS rolling_rmse, {Q.rsig('baseline_rmse')} AS baseline_rmse,
  round(rolling_rmse / baseline_rmse, 6) AS ratio
FROM r WHERE rolling_rmse > 1.25 * baseline_rmse"""


@query("drift_alerts", _DRIFT_SQL)
def drift_alerts(spark, sf_dir):
    """Days where the 30-day rolling RMSE of a model exceeds 1.25 x its whole-series RMSE."""
    from pyspark.sql import Window
    e = naive_long(spark, sf_dir).select("model", S.SERIES, S.DT, F.pow(F.col("y") - F.col("yhat"), 2).alias("se"))
    w = Window.partitionBy("model", S.SERIES).orderBy(S.DT)
    r = e.select("model", S.SERIES, S.DT, F.sqrt(F.avg("se").over(w.rowsBetween(-29, 0))).alias("rolling_rmse"),
                 F.sqrt(F.avg("se").over(Window.partitionBy("model", S.SERIES))).alias("baseline_rmse"))
    out = r.where(F.col("rolling_rmse") > 1.25 * F.col("baseline_rmse")) \
        .withColumn("ratio", F.round(F.col("rolling_rmse") / F.col("baseline_rmse"), 6))
    return round_sig_cols(out, ["rolling_rmse", "baseline_rmse"])


def _pairs():
    ms = list(NAIVE)
    return [(a, b) for i, a in enumerate(ms) for b in ms[i + 1:]]


def _paired_sql():
    parts = []
    for a, b in _pairs():
        d = (f"((y - {a}_prediction) * (y - {a}_prediction) - (y - {b}_prediction) * (y - {b}_prediction))")
        parts.append(f"""SELECT '{a}' AS model_a, '{b}' AS model_b, count(*) AS n,
  {Q.rsig(f'avg({d})')} AS mean_diff, {Q.rsig(f'stddev_samp({d})')} AS sd_diff,
  {Q.rsig(f'avg({d}) / (stddev_samp({d}) / sqrt(count(*)))')} AS t_stat FROM wide""")
    wide = ", ".join(f"CAST({c} AS DOUBLE) AS {m}_prediction" for m, c in NAIVE.items())
    return f"""WITH {Q.preds_ctes()},
wide AS (SELECT series_id, dt, CAST(y AS DOUBLE) AS y, {wide} FROM proc)
{' UNION ALL '.join(parts)}"""


@query("paired_loss_test", _paired_sql())
def paired_loss_test(spark, sf_dir):
    """Paired squared-loss differences for every model pair: mean, sample std and t statistic.
    Model pairs are column pairs of the wide table, so one aggregation serves all pairs."""
    w = naive_wide(spark, sf_dir)
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for k, (a, b) in enumerate(_pairs()):
        d = (F.pow(F.col(S.Y) - F.col(f"{a}_prediction"), 2) - F.pow(F.col(S.Y) - F.col(f"{b}_prediction"), 2))
        aggs += [F.avg(d).alias(f"m{k}"), F.stddev_samp(d).alias(f"s{k}")]
        rows.append(f"'{a}', '{b}', m{k}, s{k}")
    one = w.agg(*aggs)
    long = one.selectExpr("n", f"stack({len(rows)}, {', '.join(rows)}) AS (model_a, model_b, mean_diff, sd_diff)")
    out = long.select("model_a", "model_b", "n", "mean_diff", "sd_diff",
                      F.try_divide(F.col("mean_diff"), F.col("sd_diff") / F.sqrt("n")).alias("t_stat"))
    return round_sig_cols(out, ["mean_diff", "sd_diff", "t_stat"])


_EV_P = f"WITH {Q.panel_ctes(table='events', series='event_type', ts='ts', value='value')}"
_EV_PART = "PARTITION BY series_id ORDER BY dt"


@query("events_panel_features", f"""{_EV_P}
SELECT series_id, dt, y,
  CAST(lag(y, 1) OVER ({_EV_PART}) AS DOUBLE) AS y_lag_1,
  CAST(lag(y, 7) OVER ({_EV_PART}) AS DOUBLE) AS y_lag_7,
  round(avg(y) OVER ({_EV_PART} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS y_rolling_mean_7,
  round(stddev_samp(y) OVER ({_EV_PART} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS y_rolling_std_7
FROM panel""")
def events_panel_features(spark, sf_dir):
    """Short panel from the events table (daily value per event type, 30 days) with the lag and
    rolling features a 30-day history supports."""
    from tessera.plans.common import events_panel
    p = events_panel(spark, sf_dir)
    lags = feat.lag_columns(S.Y, [1, 7])
    roll = feat.rolling_columns(S.Y, [7])
    return round_doubles(p.select(S.SERIES, S.DT, S.Y, *[v.alias(k) for k, v in lags.items()],
                                  roll["y_rolling_mean_7"].alias("y_rolling_mean_7"),
                                  roll["y_rolling_std_7"].alias("y_rolling_std_7")))
