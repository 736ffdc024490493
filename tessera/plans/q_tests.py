"""Tests of loss differences between models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import significance as sg
from tessera.plans import sql as Q
from tessera.plans.q_eval import NAIVE, naive_wide
from tessera.plans.registry import query, round_sig_cols
from tessera.tables import reliable

_LAGS = 7
_MODELS = list(NAIVE)
_DIFFS = "\n  UNION ALL ".join(
    f"SELECT series_id, dt, '{a}' AS model_a, '{b}' AS model_b, (y - {NAIVE[a]}) * (y - {NAIVE[a]}) - (y - {NAIVE[b]}) * (y - {NAIVE[b]}) AS d "
    "FROM (SELECT series_id, dt, CAST(y AS DOUBLE) AS y, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in dict.fromkeys(NAIVE.values())) + " FROM proc)"
    for i, a in enumerate(_MODELS) for b in _MODELS[i + 1:])
_LAGGED = ", ".join(f"c * lag(c, {k}) OVER w AS c{k}" for k in range(1, _LAGS + 1))
_LONG_RUN = " + ".join(["sum(c * c)"] + [f"2 * (1 - {k} / {_LAGS + 1}) * sum(c{k})" for k in range(1, _LAGS + 1)])


@query("diebold_mariano", f"""WITH {Q.preds_ctes()},
diffs AS ({_DIFFS}),
centred AS (SELECT *, d - avg(d) OVER (PARTITION BY series_id, model_a, model_b) AS c FROM diffs),
lagged AS (SELECT *, {_LAGGED} FROM centred WINDOW w AS (PARTITION BY series_id, model_a, model_b ORDER BY dt)),
v AS (SELECT series_id, model_a, model_b, count(*) AS n, avg(d) AS mean_diff, ({_LONG_RUN}) / count(*) AS long_run_var
      FROM lagged GROUP BY ALL)
SELECT series_id, model_a, model_b, n, {Q.rsig('mean_diff / 1e6', 8)} AS mean_diff, {Q.rsig('long_run_var / 1e12', 8)} AS long_run_var,
       {Q.rsig('mean_diff / sqrt(long_run_var / n)', 8)} AS statistic FROM v""")
def diebold_mariano(spark, sf_dir):
    """Squared-loss differences (in millions) of every pair of naive forecasters per series, over their long-run deviation (7 lags)."""
    out = sg.diebold_mariano(sg.loss_differences(naive_wide(spark, sf_dir), _MODELS), _LAGS)
    out = out.withColumns({"mean_diff": F.col("mean_diff") / 1e6, "long_run_var": F.col("long_run_var") / 1e12})
    return round_sig_cols(out, ["mean_diff", "long_run_var", "statistic"], 8)


@query("loss_significance")
def loss_significance(spark, sf_dir):
    """The same with p-values of Student's t, Holm's correction per series and a seeded moving-block bootstrap."""
    wide = reliable(naive_wide(spark, sf_dir).select(S.SERIES, S.DT, S.Y, *[f"{m}_prediction" for m in _MODELS]))
    return sg.loss_tests(wide, _MODELS, _LAGS)
