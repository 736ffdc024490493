"""Model layer on Spark ML: feature selection, pipelines, time-ordered CV,
training, importance, summaries and persistence.

Training frames are checkpointed into ``spark.checkpoint.dir`` (reliable
storage) before the repeated fits, so lost executors recompute from the
checkpoint, not from the raw tables.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import panel as pnl
from tessera.tables import reliable

NON_FEATURES = [S.Y, S.DT, S.SERIES, S.SERIES_NAME]
MODEL_NAMES = ["linear_regression", "random_forest", "gradient_boosting"]
#: engine settings (not model parameters): a forest keeps per-row node ids cached between tree levels and checkpoints
#: them every 10 iterations into spark.checkpoint.dir; boosting grows one small tree at a time, which a task walks
#: in less time than a written table of node ids costs at each level. The fitted trees are the same.
FOREST_ENGINE = dict(cacheNodeIds=True, checkpointInterval=10)
BOOSTING_ENGINE = dict(cacheNodeIds=False, checkpointInterval=10)


def feature_columns(df: DataFrame, exclude=NON_FEATURES) -> list[str]:
    """Feature columns by exclusion of keys and target (schema only)."""
    return [c for c in df.columns if c not in exclude and c not in ("label", "global_idx")]


def feature_frame(df: DataFrame, target: str = S.Y) -> DataFrame:
    """Keys + ``label`` (double) + features in schema order."""
    feats = feature_columns(df, exclude=[target, S.DT, S.SERIES, S.SERIES_NAME])
    return df.select(S.SERIES, S.DT, F.col(target).cast("double").alias("label"), *feats)


def f_scores(df: DataFrame, cols: list[str], label: str = "label") -> DataFrame:
    """Univariate regression F = r^2 / (1 - r^2) * (n - 2) per feature, one aggregation.

    r uses population moments with a divide guard, so a constant feature gets
    a null r (and F) instead of an error.
    """
    aggs = [F.count(F.lit(1)).alias("_n"), F.stddev_pop(label).alias("_sy")]
    for c in cols:
        aggs += [F.covar_pop(F.col(c).cast("double"), F.col(label)).alias(f"cv_{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"sd_{c}")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', {i}, cv_{c}, sd_{c}" for i, c in enumerate(cols))
    long = one.selectExpr("_n", "_sy", f"stack({len(cols)}, {stack}) AS (feature, position, cv, sd)")
    r = F.try_divide(F.col("cv"), F.col("sd") * F.col("_sy"))
    return long.select("feature", F.col("position").cast("int").alias("position"),
                       r.alias("corr"),
                       F.try_multiply(F.try_divide(r * r, F.lit(1.0) - r * r), F.col("_n") - 2)
                       .alias("f_score"))


def select_k_best(scores: DataFrame, k: int = S.SELECT_K) -> DataFrame:
    """Top-k features by F score (ties: earlier column first). One row per feature,
    so the ordering window runs over a table of size #features."""
    w = Window.orderBy(F.col("f_score").desc_nulls_last(), F.col("position"))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def selected_features(df: DataFrame, cols: list[str], k: int = S.SELECT_K) -> list[str]:
    rows = select_k_best(f_scores(df, cols), k).select("feature", "position").collect()
    return [r["feature"] for r in sorted(rows, key=lambda r: r["position"])]


def make_pipeline(name: str, cols: list[str], params: dict | None = None) -> Pipeline:
    """Unfitted pipeline by name (the linear one gets its columns pre-selected)."""
    params = dict(params or {})
    if name == "linear_regression":
        return Pipeline(stages=[
            VectorAssembler(inputCols=cols, outputCol="raw_features", handleInvalid="error"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            LinearRegression(featuresCol="features", labelCol="label", solver="normal",
                             regParam=0.0, **params)])
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error")
    if name == "random_forest":
        p = dict(S.RF_PARAMS, featureSubsetStrategy="all", **FOREST_ENGINE)
        p.update(params)
        return Pipeline(stages=[assembler, RandomForestRegressor(labelCol="label", **p)])
    if name == "gradient_boosting":
        p = dict(S.GBT_PARAMS, **BOOSTING_ENGINE)
        p.update(params)
        return Pipeline(stages=[assembler, GBTRegressor(labelCol="label", **p)])
    raise ValueError(f"unknown model {name}")


def pipeline_columns(name: str, df: DataFrame, cols: list[str]) -> list[str]:
    return selected_features(df, cols) if name == "linear_regression" else cols


def fit(name: str, df: DataFrame, cols: list[str], params: dict | None = None) -> PipelineModel:
    from tessera.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return make_pipeline(name, pipeline_columns(name, df, cols), params).fit(df)


def fit_all(names, df: DataFrame, cols: list[str], params: dict | None = None) -> dict[str, PipelineModel]:
    """The fitted pipelines by name, the slowest begun first. A fit is a row of short jobs of which each
    waits for the one before; the pipelines do not depend on each other and are fitted at once."""
    from tessera.session import at_once
    later = list(reversed(list(names)))
    fitted = at_once(df.sparkSession, [partial(fit, n, df, cols, (params or {}).get(n)) for n in later])
    models = dict(zip(later, fitted))
    return {n: models[n] for n in names}


# --- time-ordered folds --------------------------------------------------------
def ts_folds(df: DataFrame, n_splits: int = S.CV_FOLDS, by: str = "row") -> DataFrame:
    """Expanding-window folds: fold f tests rows [N-(k-f)t, N-(k-f)t+t), t = N//(k+1),
    and trains on every earlier row.  ``by='row'`` orders by (series_id, dt) as
    the original row position does; ``by='date'`` orders by (dt, series_id), so
    no test day precedes a training day.

    Adds ``global_idx`` and ``test_fold`` (null outside every test block).
    """
    if by == "row":
        indexed = pnl.with_global_index(df, (S.SERIES, S.DT))
    elif by == "date":
        indexed = _date_index(df)
    else:
        raise ValueError("by must be 'row' or 'date'")
    total = indexed.agg(F.count(F.lit(1))).first()[0]
    t = total // (n_splits + 1)
    first = total - n_splits * t
    fold = F.when(F.col("global_idx") >= first,
                  F.floor((F.col("global_idx") - first) / F.lit(t)).cast("int"))
    return indexed.withColumn("test_fold", fold), total, t


def _date_index(df: DataFrame) -> DataFrame:
    """0-based position in (dt, series_id) order, by distributed prefix sums: no task sorts
    all series of a day."""
    from tessera.operators.positions import exclusive_prefix_sum
    one = df.withColumn("_one", F.lit(1).cast("long"))
    return exclusive_prefix_sum(one, [S.DT, S.SERIES], "_one", "global_idx").drop("_one")


def cross_validate(name: str, df: DataFrame, cols: list[str], n_splits: int = S.CV_FOLDS,
                   by: str = "row", params: dict | None = None) -> DataFrame:
    """RMSE per fold of pipeline ``name`` on time-ordered folds."""
    from tessera.operators import tuning
    return tuning.cross_validate([name], tuning.fold_table(df, cols, n_splits, by), {name: params} if params else None)


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and population std of the fold RMSE per model."""
    return scores.groupBy("model").agg(F.avg("rmse").alias("cv_rmse_mean"),
                                       F.stddev_pop("rmse").alias("cv_rmse_std"))


def train_models(df: DataFrame, cols: list[str], names=MODEL_NAMES, cv: bool = True,
                 params: dict | None = None):
    """CV and, beside it, fit on all rows; in-sample metrics. Returns (models, metrics DataFrame, cv DataFrame)."""
    from tessera.operators import evaluate as ev
    from tessera.operators import tuning
    from tessera.session import at_once
    data = reliable(df)
    models, cv_df = at_once(df.sparkSession, [
        lambda: fit_all(names, data, cols, params),
        lambda: tuning.cross_validate(names, tuning.fold_table(data, cols), params) if cv else None])
    return models, ev.metrics(fitted_values(models, data)), cv_df


def fitted_values(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Predictions of every model on ``df`` as one long table (model, series_id, dt, y, yhat)."""
    preds = [m.transform(df).select(F.lit(name).alias("model"), S.SERIES, S.DT, F.col("label").alias(S.Y),
                                    F.col("prediction").alias("yhat")) for name, m in models.items()]
    return reduce(DataFrame.unionByName, preds)


def feature_importance(model: PipelineModel, cols: list[str] | None = None) -> DataFrame:
    """(feature, importance) sorted descending; linear models give an empty table."""
    est = model.stages[-1]
    spark = SparkSession.getActiveSession()
    schema = "feature string, importance double"
    if not hasattr(est, "featureImportances"):
        return spark.createDataFrame([], schema)
    cols = cols or model.stages[0].getInputCols()
    imp = est.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(cols, [float(v) for v in imp])), schema) \
        .orderBy(F.col("importance").desc(), "feature")


def model_summary(models: dict[str, PipelineModel], metrics: DataFrame | None = None, scores: DataFrame | None = None) -> DataFrame:
    """One row per model: type, number of input features, trees, nodes; with ``metrics`` the error
    measures, with the fold ``scores`` the mean and deviation of the cross-validation."""
    rows = []
    for name, m in models.items():
        est = m.stages[-1]
        n_in = len(m.stages[0].getInputCols())
        trees = getattr(est, "getNumTrees", None)
        rows.append((name, type(est).__name__, n_in,
                     int(est.getNumTrees) if trees is not None else None,
                     int(est.totalNumNodes) if hasattr(est, "totalNumNodes") else None))
    spark = SparkSession.getActiveSession()
    out = spark.createDataFrame(rows, "model string, model_type string, n_features int, "
                                      "n_trees int, total_nodes int")
    if metrics is not None:
        out = out.join(metrics, "model", "left")
    return out if scores is None else out.join(cv_summary(scores), "model", "left")


def save_models(models: dict[str, PipelineModel], path: str) -> str:
    for name, m in models.items():
        m.write().overwrite().save(f"{path.rstrip('/')}/{name}")
    return path


def load_models(path: str, names=MODEL_NAMES) -> dict[str, PipelineModel]:
    return {n: PipelineModel.load(f"{path.rstrip('/')}/{n}") for n in names}
