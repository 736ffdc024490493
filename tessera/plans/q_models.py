"""Model queries: scaling, univariate selection, OLS check, Spark ML fits,
cross-validation, importance, summaries, sequence regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import clean, evaluate as ev, features as feat, forecast as fc, models as mdl
from tessera.operators import model_store, tuning
from tessera.plans import sql as Q
from tessera.plans.common import orders_processed, written_panel
from tessera.plans.registry import query, round_doubles, round_sig_cols
from tessera.session import at_once
from tessera.tables import reliable

_FEATS = S.FEATURE_NAMES
_PROC = f"""WITH {Q.panel_ctes()},
{Q.features_cte(digits_cyclic=None, digits_roll=None)},
proc AS (SELECT * FROM feat WHERE {Q.not_null_all(S.FEATURE_NAMES)})"""


def training_frame(spark, sf_dir):
    return mdl.feature_frame(orders_processed(spark, sf_dir))


def written_frame(panel):
    """The training frame of a panel as a written table."""
    return reliable(mdl.feature_frame(feat.processed_panel(panel)))


def stored_models(spark, sf_dir, names=mdl.MODEL_NAMES, frame=None):
    """The stored pipelines; ``frame()`` gives the training frame if the caller has it."""
    return model_store.get_models(spark, sf_dir, names, frame or (lambda: training_frame(spark, sf_dir)), _FEATS)


_SC = ["y_lag_1", "y_rolling_mean_30", "y_rolling_std_30", "month_sin", "is_holiday"]


@query("standardize", f"""{_PROC}
SELECT series_id, dt, {', '.join(f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END, 6) AS {c}_z" for c in _SC)}
FROM proc""")
def standardize(spark, sf_dir):
    """(x - mean) / population std (scikit-learn's scaler); constant columns -> 0."""
    df = orders_processed(spark, sf_dir)
    z = clean.standardize(df, _SC, suffix="_z")
    return round_doubles(z.select(S.SERIES, S.DT, *[f"{c}_z" for c in _SC]), 6)


@query("minmax_scale", f"""{_PROC}
SELECT series_id, dt, {', '.join(f"round(coalesce(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN NULL ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 0.0), 6) AS {c}_s" for c in _SC + ['y'])}
FROM proc""")
def minmax_scale(spark, sf_dir):
    """(x - min) / (max - min); constant columns -> 0."""
    df = reliable(orders_processed(spark, sf_dir))
    cols = _SC + [S.Y]
    s = clean.minmax_scale(df, clean.minmax_fit(df, cols), suffix="_s")
    return round_doubles(s.select(S.SERIES, S.DT, *[f"{c}_s" for c in cols]), 6)


@query("minmax_inverse", f"""{_PROC}
SELECT series_id, dt, CAST(y AS DOUBLE) AS y_restored FROM proc""")
def minmax_inverse(spark, sf_dir):
    """Scale y to [0, 1] and back: the inverse restores the original values."""
    df = reliable(orders_processed(spark, sf_dir))
    rng = clean.minmax_fit(df, [S.Y])
    s = clean.minmax_scale(df, rng, suffix="_s").select(S.SERIES, S.DT, F.col("y_s").alias(S.Y))
    back = clean.minmax_inverse(s, rng, suffix="_restored")
    return back.select(S.SERIES, S.DT, F.round("y_restored", 4).alias("y_restored"))


_FS_SQL = f"""{_PROC},
m AS (SELECT count(*) AS n, stddev_pop(CAST(y AS DOUBLE)) AS sy,
  {', '.join(f"covar_pop(CAST({c} AS DOUBLE), CAST(y AS DOUBLE)) AS cv{i}, stddev_pop(CAST({c} AS DOUBLE)) AS sd{i}" for i, c in enumerate(_FEATS))}
  FROM proc),
r AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {i} AS position, CASE WHEN sd{i} * sy = 0 THEN NULL ELSE cv{i} / (sd{i} * sy) END AS corr, n FROM m" for i, c in enumerate(_FEATS))}),
f AS (SELECT feature, CAST(position AS INTEGER) AS position, corr, corr * corr / (1 - corr * corr) * (n - 2) AS f_score FROM r)"""


@query("f_scores", f"{_FS_SQL} SELECT feature, position, round(corr, 8) AS corr, {Q.rsig('f_score', 8)} AS f_score FROM f")
def f_scores(spark, sf_dir):
    """Univariate F statistic of each feature against y (scikit-learn's f_regression)."""
    fs = mdl.f_scores(training_frame(spark, sf_dir), _FEATS)
    return round_sig_cols(fs.withColumn("corr", F.round("corr", 8)), ["f_score"], 8)


@query("select_k_best", f"""{_FS_SQL}
SELECT feature, position, CAST(row_number() OVER (ORDER BY f_score DESC NULLS LAST, position) AS INTEGER) AS rank FROM f
QUALIFY rank <= 20""")
def select_k_best(spark, sf_dir):
    """The 20 features with the highest F statistic."""
    sel = mdl.select_k_best(mdl.f_scores(training_frame(spark, sf_dir), _FEATS), 20)
    return sel.select("feature", "position", F.col("rank").cast("int").alias("rank"))


@query("ols_single", f"""{_PROC}
SELECT {Q.rsig('regr_slope(CAST(y AS DOUBLE), y_lag_1)', 8)} AS slope, {Q.rsig('regr_intercept(CAST(y AS DOUBLE), y_lag_1)', 8)} AS intercept,
  count(*) AS n FROM proc""")
def ols_single(spark, sf_dir):
    """Least squares on one feature (y on its previous day) with Spark ML, vs SQL regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = training_frame(spark, sf_dir)
    model = Pipeline(stages=[VectorAssembler(inputCols=["y_lag_1"], outputCol="features"),
                             LinearRegression(labelCol="label", solver="normal", regParam=0.0)]).fit(df)
    lr = model.stages[-1]
    out = spark.createDataFrame([(float(lr.coefficients[0]), float(lr.intercept), int(lr.summary.numInstances))],
                                "slope double, intercept double, n long")
    return round_sig_cols(out, ["slope", "intercept"], 8)


def _fit_predict(spark, sf_dir, name):
    df = reliable(training_frame(spark, sf_dir))
    model = mdl.fit(name, df, _FEATS)
    return model.transform(df).select(S.SERIES, S.DT, "label", "prediction")


@query("linear_regression")
def linear_regression(spark, sf_dir):
    """Standardise -> top-20 F-score features -> ordinary least squares; in-sample predictions."""
    return _fit_predict(spark, sf_dir, "linear_regression")


@query("random_forest")
def random_forest(spark, sf_dir):
    """Random forest (100 trees, depth 10, leaf >= 2, all features per split, seed 42)."""
    return _fit_predict(spark, sf_dir, "random_forest")


@query("gradient_boosting")
def gradient_boosting(spark, sf_dir):
    """Gradient-boosted trees (100 rounds, rate 0.1, depth 6, leaf >= 2, seed 42)."""
    return _fit_predict(spark, sf_dir, "gradient_boosting")


def stored_scores(spark, sf_dir, frame=None):
    return model_store.get_scores(spark, sf_dir, mdl.MODEL_NAMES, frame or (lambda: training_frame(spark, sf_dir)), _FEATS)


@query("cv_scores")
def cv_scores(spark, sf_dir):
    """Five expanding-window folds of the three pipelines: RMSE per fold, plus mean / pop std."""
    scores = stored_scores(spark, sf_dir)
    return scores.join(mdl.cv_summary(scores), "model")


@query("cv_fold_sizes", f"""{_PROC}, n AS (SELECT count(*) AS n, count(*) // 6 AS t FROM proc)
SELECT CAST(f AS INTEGER) AS fold, n - (5 - f) * t AS train_rows, t AS test_rows
FROM n, (SELECT unnest(range(5)) AS f)""")
def cv_fold_sizes(spark, sf_dir):
    """Training and test rows of every fold of the written fold table, counted from its rows."""
    folds = tuning.fold_table(training_frame(spark, sf_dir), _FEATS)
    test = F.col("test_fold")
    cuts = folds.rows.where(test.isNotNull()).groupBy(test.alias("fold")).agg(F.min("global_idx").alias("start"),
                                                                           F.count("*").alias("test_rows"))
    return folds.rows.join(F.broadcast(cuts), F.col("global_idx") < F.col("start")) \
        .groupBy("fold", "test_rows").agg(F.count("*").alias("train_rows")).select("fold", "train_rows", "test_rows")


#: candidates of the race, small enough for a laptop; any grid can be given to tuning.race
TUNING_GRID = {
    "linear_regression": tuning.grid(select_k=[5, 10, 20, 29], regParam=[0.0, 0.1]),
    "random_forest": tuning.grid(numTrees=[20], maxDepth=[4, 7, 10], minInstancesPerNode=[2, 8]),
    "gradient_boosting": tuning.grid(maxIter=[15], maxDepth=[3, 5], stepSize=[0.1, 0.3]),
}


@query("tune_models")
def tune_models(spark, sf_dir):
    """Successive halving over a grid for each pipeline on the time-ordered folds: one row per candidate and rung."""
    return tuning.race(TUNING_GRID, tuning.fold_table(training_frame(spark, sf_dir), _FEATS))


@query("train_metrics")
def train_metrics(spark, sf_dir):
    """Fit the three pipelines on all rows, score them in-sample (comparison table) and by cross-validation."""
    df = written_frame(written_panel(spark, sf_dir))
    scores, (_, metrics, _) = at_once(spark, [lambda: stored_scores(spark, sf_dir, lambda: df),
                                              lambda: mdl.train_models(df, _FEATS, cv=False)])
    return ev.ranking(metrics.join(mdl.cv_summary(scores), "model"))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Top-15 feature importances of the random forest (sum to 1)."""
    m = stored_models(spark, sf_dir, ["random_forest"])["random_forest"]
    return mdl.feature_importance(m, _FEATS).limit(15)


@query("model_summary")
def model_summary(spark, sf_dir):
    """One row per stored pipeline: estimator, inputs, trees, nodes, in-sample error measures, mean and deviation
    of the cross-validation."""
    df = written_frame(written_panel(spark, sf_dir))
    scores, models = at_once(spark, [lambda: stored_scores(spark, sf_dir, lambda: df),
                                     lambda: stored_models(spark, sf_dir, frame=lambda: df)])
    return mdl.model_summary(models, ev.metrics(mdl.fitted_values(models, df)), scores)


@query("sequence_regression")
def sequence_regression(spark, sf_dir):
    """Boosted trees on the 30 preceding min-max scaled rows of every numeric
    column, early stopping on the last 20 % (validation tail); loss per iteration."""
    df = orders_processed(spark, sf_dir)
    cols = [S.Y] + _FEATS
    _, _, hist = fc.sequence_regression(df, cols, max_iter=50)
    return hist
