"""Load-or-fit store of fitted pipelines in the shared checkpoint folder.

Training queries always fit; downstream steps (importance, summaries,
forecasts, evaluation) load the persisted pipeline when it exists, as the
original pipeline's forecasting step loads the models its training step saved.
"""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from tessera import __version__
from tessera.operators import models as mdl
from tessera.session import shared_path
from tessera.sources.tables import fingerprint
from tessera.tables import path_exists, reliable

_MEMO: dict[str, PipelineModel] = {}


def _key(sf_dir: str, data: str, name: str, tag: str, cols) -> str:
    """Store key: input folder and the state of its files, tag, feature list and the model parameters, so a
    change of any of them fits a new model instead of reusing a stale one."""
    from tessera import schema as S
    spec = f"{__version__}|{sf_dir.rstrip('/')}|{data}|{tag}|{','.join(cols)}|{S.RF_PARAMS}|{S.GBT_PARAMS}"
    h = hashlib.sha1(spec.encode()).hexdigest()[:16]
    return f"models/{h}/{name}"


def get_models(spark: SparkSession, sf_dir: str, names, train_fn, cols, tag: str = "panel") -> dict[str, PipelineModel]:
    """``train_fn()`` returns the training frame; pipelines of which no saved one exists are fitted on it, at once."""
    data = fingerprint(spark, sf_dir)
    paths = {n: shared_path(spark, _key(sf_dir, data, n, tag, cols)) for n in names}
    for path in paths.values():
        if path not in _MEMO and path_exists(spark, path):
            _MEMO[path] = PipelineModel.load(path)
    missing = [n for n, path in paths.items() if path not in _MEMO]
    if missing:
        for n, model in mdl.fit_all(missing, reliable(train_fn()), cols).items():
            model.write().overwrite().save(paths[n])
            _MEMO[paths[n]] = model
    return {n: _MEMO[path] for n, path in paths.items()}


def get_sequence(spark: SparkSession, sf_dir: str, train_fn, cols, tag: str = "sequence"):
    """The stored sequence model with its ranges and length; fitted and saved when there is none."""
    from tessera.operators import forecast as fc
    path = shared_path(spark, _key(sf_dir, fingerprint(spark, sf_dir), "sequence", tag, cols))
    if path not in _MEMO:
        if not path_exists(spark, f"{path}/settings"):
            fc.fitted_sequence(reliable(train_fn()), cols).save(spark, path)
        _MEMO[path] = fc.SequenceModel.load(spark, path)
    return _MEMO[path]


def get_scores(spark: SparkSession, sf_dir: str, names, train_fn, cols, tag: str = "panel"):
    """Cross-validation scores of the pipelines, one row per (model, fold); computed and saved when there are none."""
    from tessera.operators import tuning
    path = shared_path(spark, _key(sf_dir, fingerprint(spark, sf_dir), "cv-" + "-".join(names), tag, cols))
    if not path_exists(spark, f"{path}/_SUCCESS"):
        tuning.cross_validate(names, tuning.fold_table(train_fn(), cols)).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(tuning.SCORES).parquet(path)
