"""Recursive forecasts of tree ensembles inside one expression.

A fitted forest or boosting model is read from its saved form (Spark ML writes one row per node) and gathered into
one value, an array of trees, each with a weight and its nodes in order: feature, threshold, left, right, value.
Its size is that of the model, whatever the data.  :func:`predicted` walks every tree with ``aggregate`` over such an
array, so a model can be applied anywhere a column can: here inside the fold over the horizon that keeps a
series' history as its state.  The whole forecast is one job without Python, and no step is written.

Missing features count as 0, as in the linear roll-forward.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import features as feat, forecast as fc
from tessera.session import shared_path
from tessera.tables import delete_path, reliable

#: nodes are in order of their ids, which count from 0; a leaf has no left child (-1)
TREES = ("array<struct<weight: double, nodes: array<struct<feature: int, threshold: double, left: int, right: int, "
         "value: double>>>>")


def saved_trees(spark: SparkSession, path: str, mean: bool) -> DataFrame:
    """One row (trees, depth) of a tree ensemble saved below ``path``; with ``mean`` the weights are divided by
    the number of trees (a forest), otherwise taken as they are (boosting)."""
    n = F.col("nodeData")
    split = F.try_element_at(n["split"]["leftCategoriesOrThreshold"], F.lit(1))
    node = F.struct(n["split"]["featureIndex"].alias("feature"), split.alias("threshold"), n["leftChild"].alias("left"),
                    n["rightChild"].alias("right"), n["prediction"].alias("value"))
    data = spark.read.parquet(f"{path}/data")
    if not data.where(n["split"]["numCategories"] > 0).isEmpty():
        raise ValueError("splits on categories are not read")
    trees = data.groupBy("treeID").agg(F.array_sort(F.collect_list(F.struct(n["id"].alias("id"), node.alias("node")))).alias("nodes"))
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "about", "weight").select("treeID", "weight")
    one = trees.join(weights, "treeID").select(
        "treeID", F.struct("weight", F.transform("nodes", lambda x: x["node"]).alias("nodes")).alias("tree")) \
        .agg(F.array_sort(F.collect_list(F.struct("treeID", "tree"))).alias("all"))
    every = F.transform("all", lambda x: x["tree"])
    if mean:
        count = F.size("all").cast("double")
        every = F.transform("all", lambda x: x["tree"].withField("weight", F.lit(1.0) / count))
    return one.select(every.cast(TREES).alias("trees"))


def trees_of(model, spark: SparkSession | None = None) -> DataFrame:
    """The same of a fitted forest or boosting model (or of the pipeline that ends in one), written on the way."""
    est = model.stages[-1] if hasattr(model, "stages") else model
    spark = spark or SparkSession.getActiveSession()
    path = shared_path(spark, f"trees/{uuid.uuid4().hex}")
    est.write().save(path)
    trees = reliable(saved_trees(spark, path, "RandomForest" in type(est).__name__))
    delete_path(spark, path)
    return trees


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def predicted(trees: Column, x: Column, depth: int) -> Column:
    """Prediction of the ensemble for the feature array ``x``; no tree is deeper than ``depth``."""
    def down(nodes):
        def one(at, _):
            n = nodes[at]
            return F.when(n["left"] < 0, at).when(x[n["feature"]] <= n["threshold"], n["left"]).otherwise(n["right"])
        return nodes[F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), one)]["value"]
    return F.aggregate(trees, F.lit(0.0).cast("double"), lambda total, t: total + t["weight"] * down(t["nodes"]))


def depth_of(model) -> int:
    est = model.stages[-1] if hasattr(model, "stages") else model
    return max(t.depth for t in est.trees)


def _number(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def roll_forward(panel: DataFrame, trees: DataFrame, depth: int, cols: list[str], horizon: int = S.FORECAST_DAYS,
                 history: int = S.YEAR_LAG) -> DataFrame:
    """Recursive forecast of a model over the panel's features: series_id, dt, step, yhat.

    Each step computes the features of the next day from the last ``history`` values, predicts, and appends the
    prediction.  ``trees`` has one row (see :func:`trees_of`), ``cols`` the model's features in order.
    """
    w = Window.partitionBy(S.SERIES).orderBy(F.col(S.DT).desc())
    top = panel.select(S.SERIES, S.DT, F.col(S.Y).cast("double").alias(S.Y)) \
        .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= history)
    state = top.groupBy(S.SERIES).agg(F.sort_array(F.collect_list(F.struct(S.DT, S.Y))).alias("_h"), F.max(S.DT).alias("last_dt")) \
        .select(S.SERIES, "last_dt", F.transform("_h", lambda r: r[S.Y]).alias("state"), trees.scalar().alias("trees"))

    def step(acc, i):
        f = fc.step_features(acc["s"], F.date_add(F.col("last_dt"), i))
        yhat = let(F.array(*[_number(f[c]) for c in cols]), lambda x: predicted(F.col("trees"), x, depth))
        return let(yhat, lambda y: F.struct(_pushed(acc["s"], y, history).alias("s"), F.concat(acc["out"], F.array(y)).alias("out")))

    start = F.struct(F.col("state").alias("s"), F.array().cast("array<double>").alias("out"))
    return _steps(state, F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["out"])


def _pushed(values: Column, one: Column, most: int) -> Column:
    longer = F.concat(values, F.array(one))
    return F.when(F.size(values) >= most, F.slice(longer, 2, most)).otherwise(longer)


def _steps(state: DataFrame, out: Column) -> DataFrame:
    return state.select(S.SERIES, "last_dt", F.posexplode(out).alias("step", "yhat")) \
        .select(S.SERIES, F.date_add("last_dt", F.col("step") + 1).alias(S.DT), (F.col("step") + 1).alias("step"), "yhat")


def sequence_roll_forward(model: fc.SequenceModel, panel: DataFrame, horizon: int = S.FORECAST_DAYS,
                          history: int = S.YEAR_LAG) -> DataFrame:
    """The sequence model's forecast in one expression: its state also holds the last rows of scaled features.

    Gives what :func:`tessera.operators.forecast.sequence_forecast` computes step by step.
    """
    length, cols = model.length, model.columns
    low, high = model.ranges[S.Y]

    def scaled(name: str, c: Column) -> Column:
        lo, hi = model.ranges[name]
        return F.coalesce(F.try_divide(c.cast("double") - F.lit(lo), F.lit(hi) - F.lit(lo)), F.lit(0.0))

    feats = feat.add_features(panel.select(S.SERIES, S.SERIES_NAME, S.DT, S.Y))
    w = Window.partitionBy(S.SERIES).orderBy(F.col(S.DT).desc())
    top = feats.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= history) \
        .select(S.SERIES, S.DT, F.col(S.Y).cast("double").alias("_y"), F.array(*[scaled(c, F.col(c)) for c in cols]).alias("_row"), "_rn")
    held = top.groupBy(S.SERIES).agg(F.sort_array(F.collect_list(F.struct(S.DT, "_y"))).alias("_h"), F.max(S.DT).alias("last_dt"),
                                     F.sort_array(F.collect_list(F.when(F.col("_rn") <= length, F.struct(S.DT, "_row")))).alias("_w"))
    state = held.where(F.size("_w") == length).select(
        S.SERIES, "last_dt", F.transform("_h", lambda r: r["_y"]).alias("hist"), F.transform("_w", lambda r: r["_row"]).alias("window"),
        trees_of(model.model).scalar().alias("trees"))
    depth = depth_of(model.model)

    def step(acc, i):
        d = F.date_add(F.col("last_dt"), i)
        yhat = let(F.flatten(acc["window"]), lambda x: predicted(F.col("trees"), x, depth)) * (high - low) + low

        def rolled(y):
            f = fc.day_features(acc["hist"], y, d)
            return F.struct(_pushed(acc["hist"], y, history).alias("hist"),
                            F.concat(F.slice(acc["window"], 2, length - 1), F.array(F.array(*[scaled(c, f[c]) for c in cols]))).alias("window"),
                            F.concat(acc["out"], F.array(y)).alias("out"))
        return let(yhat, rolled)

    start = F.struct("hist", "window", F.array().cast("array<double>").alias("out"))
    return _steps(state, F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["out"])
