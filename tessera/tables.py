"""Written intermediate tables: cut lineage in the shared folder, and clear up afterwards."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tessera.session import shared_path

_WRITTEN: list[str] = []


def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage: write the frame as a parquet table below the cluster's
    ``spark.checkpoint.dir`` and read it back.

    Unlike ``Dataset.checkpoint`` (which runs the plan once for the action and
    once more to write the checkpoint unless the data is cached) the plan runs
    once; readers get columnar scans, and a lost executor re-reads the table
    instead of recomputing the upstream plan.
    """
    path = shared_path(df.sparkSession, f"tables/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_file(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(target) and fs.getFileStatus(target).isFile()


def dropped(df: DataFrame) -> None:
    """Delete a table made by :func:`reliable` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = next((p for p in _WRITTEN if folder.endswith(p.split(":", 1)[-1].lstrip("/"))), None)
        if path:
            delete_path(df.sparkSession, path)
            _WRITTEN.remove(path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written inside the block when it ends; consume results inside."""
    first = len(_WRITTEN)
    try:
        yield
    finally:
        for path in _WRITTEN[first:]:
            delete_path(spark, path)
        del _WRITTEN[first:]
