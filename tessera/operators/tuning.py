"""Cross-validation and racing over time-ordered folds.

One fold table serves every model: rows get their position and fold once, the features are assembled
once, and the result is written to the shared folder (:func:`fold_table`).  A fit reads its training rows by
position from there.  Fits of different candidates and folds do not depend on each other, so they are submitted from
driver threads, as many as the cluster has cores, and Spark fills its cores with their tasks; nothing but one number
per fit comes back.

:func:`race` tunes by successive halving on the number of folds: all candidates are scored on the first folds
(which have the fewest training rows), the better part goes on to the next ones, and only the last are scored on all.
With ``keep = 1`` nobody is dropped, which is the exhaustive search.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import models as mdl
from tessera.session import at_once, ensure_checkpoint_dir
from tessera.tables import reliable

SCORES = "model string, fold int, train_rows long, test_rows long, rmse double"
RACE = ("model string, params string, rung int, folds int, rmse_mean double, rmse_std double, place int, "
        "kept boolean, best boolean")


@dataclass
class Folds:
    """The written fold table: keys, label, raw features, the assembled vector, position and test fold."""
    rows: DataFrame
    columns: list[str]
    n: int
    first: int
    size: int

    def start(self, fold: int) -> int:
        return self.first + fold * self.size

    def train(self, fold: int) -> DataFrame:
        return self.rows.where(F.col("global_idx") < self.start(fold))

    def test(self, fold: int) -> DataFrame:
        return self.rows.where(F.col("test_fold") == fold)


def fold_table(df: DataFrame, cols: list[str], n_splits: int = S.CV_FOLDS, by: str = "row") -> Folds:
    """Expanding-window folds of ``df`` (label and ``cols``), indexed, assembled and written once."""
    folded, total, size = mdl.ts_folds(df, n_splits, by)
    if not size:
        raise ValueError(f"{total} rows are too few for {n_splits} folds")
    vector = VectorAssembler(inputCols=cols, outputCol="assembled", handleInvalid="error").transform(folded)
    return Folds(reliable(vector), list(cols), n_splits, total - n_splits * size, size)


def estimator(name: str, folds: Folds, train: DataFrame, params: dict | None = None) -> Pipeline:
    """The unfitted pipeline ``name`` over the assembled vector; ``select_k`` is the number of features
    that the linear one keeps, chosen by F scores of the training rows."""
    params = dict(params or {})
    if name == "linear_regression":
        k = int(params.pop("select_k", S.SELECT_K))
        chosen = mdl.selected_features(train, folds.columns, k)
        return Pipeline(stages=[
            VectorSlicer(inputCol="assembled", outputCol="chosen", indices=[folds.columns.index(c) for c in chosen]),
            StandardScaler(inputCol="chosen", outputCol="features", withMean=True, withStd=True),
            LinearRegression(**dict(dict(featuresCol="features", labelCol="label", solver="normal", regParam=0.0), **params))])
    columns = dict(featuresCol="assembled", labelCol="label")
    if name == "random_forest":
        return Pipeline(stages=[RandomForestRegressor(**dict(S.RF_PARAMS, featureSubsetStrategy="all", **columns, **mdl.FOREST_ENGINE) | params)])
    if name == "gradient_boosting":
        return Pipeline(stages=[GBTRegressor(**dict(S.GBT_PARAMS, **columns, **mdl.BOOSTING_ENGINE) | params)])
    raise ValueError(f"unknown model {name}")


def fold_rmse(name: str, folds: Folds, fold: int, params: dict | None = None) -> float:
    train = folds.train(fold)
    model = estimator(name, folds, train, params).fit(train)
    mse = model.transform(folds.test(fold)).agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0]
    return math.sqrt(mse)


def _scored(folds: Folds, jobs: list[tuple[str, dict | None, int]], threads: int | None) -> list[float]:
    spark = folds.rows.sparkSession
    ensure_checkpoint_dir(spark)
    return at_once(spark, [partial(fold_rmse, name, folds, fold, params) for name, params, fold in jobs], threads)


def cross_validate(names: Iterable[str], folds: Folds, params: dict[str, dict] | None = None, threads: int | None = None) -> DataFrame:
    """RMSE of every pipeline on every fold: one row per (model, fold). The longest fits begin first."""
    jobs = [(name, (params or {}).get(name), fold) for name in reversed(list(names)) for fold in reversed(range(folds.n))]
    rows = [(name, fold, folds.start(fold), folds.size, rmse)
            for (name, _, fold), rmse in zip(jobs, _scored(folds, jobs, threads))]
    return folds.rows.sparkSession.createDataFrame(sorted(rows), SCORES)


def grid(**choices: list) -> list[dict]:
    """All combinations of the given parameter values, in order."""
    return [dict(zip(choices, values)) for values in itertools.product(*choices.values())]


def rungs(n_folds: int, n_candidates: int, keep: float) -> list[int]:
    """How many folds have been scored after each rung: one, then twice as many each time, at last all."""
    out, folds = [], 1
    while folds < n_folds and n_candidates > 1 and keep < 1:
        out.append(folds)
        folds *= 2
        n_candidates = max(1, math.ceil(n_candidates * keep))
    return [*out, n_folds]


def mean_and_deviation(values: list[float]) -> tuple[float, float]:
    mean = sum(values) / len(values)
    return mean, math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


def race(candidates: dict[str, list[dict]], folds: Folds, keep: float = 0.5, threads: int | None = None) -> DataFrame:
    """Successive halving of each model's ``candidates``: one row per candidate and rung that it took part in.

    After a rung the ``keep`` best share (rounded up) of a model's candidates by their mean RMSE over the folds so
    far goes on; equal means go by the candidates' order.  ``best`` marks a model's first candidate of the last rung.
    """
    out = []
    for name, own in candidates.items():
        scores: list[list[float]] = [[] for _ in own]
        open_ = list(range(len(own)))
        steps = rungs(folds.n, len(own), keep)
        for rung, upto in enumerate(steps):
            jobs = [(i, fold) for i in open_ for fold in range(len(scores[i]), upto)]
            for (i, _), rmse in zip(jobs, _scored(folds, [(name, own[i], fold) for i, fold in jobs], threads)):
                scores[i].append(rmse)
            ranked = sorted(open_, key=lambda i: (mean_and_deviation(scores[i])[0], i))
            last = rung == len(steps) - 1
            stay = 1 if last else max(1, math.ceil(len(ranked) * keep))
            for place, i in enumerate(ranked, 1):
                out.append((name, json.dumps(own[i], sort_keys=True), rung, upto, *mean_and_deviation(scores[i]), place,
                            place <= stay, last and place == 1))
            open_ = sorted(ranked[:stay])
    return folds.rows.sparkSession.createDataFrame(out, RACE)
