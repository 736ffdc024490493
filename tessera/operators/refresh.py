"""Incremental refresh of the processed panel.

A store is a folder with three parts:

* ``totals/v=N``: day totals per input file, written by the N-th refresh for the files that were new to it;
* ``features/v=N/of_month=M``: the processed panel of the months that the N-th refresh recomputed;
* ``manifest/v=N``: what version N consists of, one row per input file (size, time of change, and the refresh that
  read it) and one per month (the refresh that wrote it).

A refresh lists the input folder and compares it with the last manifest.  Only new and changed files are read.  The days in them, and
those of files that are gone or have changed, are the changed days; a day's value enters the features of itself and of the ``look_back`` days
after it, so only the months of these days are computed again, from the totals of these months and of the ``look_back``
days before them.  Nothing is overwritten: the new months lie beside the old ones until the manifest, written last and
complete only with its ``_SUCCESS`` mark, names them.  A refresh that dies before that leaves files that no manifest names,
which the next refresh of the same number deletes first.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import features as feat, panel as pnl
from tessera.tables import delete_path, path_exists, reliable

MANIFEST = "kind string, name string, size long, changed timestamp, version int"
TOTALS = "file string, series_id string, dt date, amount decimal(28,2)"


@dataclass
class Report:
    """What a refresh did; ``version`` is the one readers see now."""
    version: int
    files_read: int = 0
    files_gone: int = 0
    changed_days: int = 0
    totals_read: int = 0
    months_written: list[str] = field(default_factory=list)


def _version(spark: SparkSession, root: str) -> int:
    """The last published version, 0 without any."""
    n = 0
    if path_exists(spark, f"{root}/manifest"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for s in fs.listStatus(folder):
            if path_exists(spark, f"{s.getPath().toString()}/_SUCCESS"):
                n = max(n, int(s.getPath().getName().removeprefix("v=")))
    return n


def _manifest(spark: SparkSession, root: str, version: int) -> DataFrame:
    if not version:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v={version}")


def listed(spark: SparkSession, source_dir: str) -> DataFrame:
    """name, size, changed of the parquet files below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(source_dir)
    return files.select(F.col("path").alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def _totals(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Day totals of the ``files`` (name, version) of a manifest."""
    held = spark.read.schema(TOTALS + ", v int").parquet(f"{root}/totals")
    return held.join(files.select(F.col("name").alias("file"), F.col("version").alias("v")), ["file", "v"], "left_semi")


def refresh(spark: SparkSession, source_dir: str, root: str, observations, look_back: int = S.YEAR_LAG,
            drop_from_name: str | None = None, publish: bool = True) -> Report:
    """Bring the store below ``root`` up to date with the files of ``source_dir``.

    ``observations`` makes (series_id, dt, amount) of a raw frame.  ``publish=False`` stops before the manifest.
    """
    old = _version(spark, root)
    new = old + 1
    for part in ("totals", "features", "manifest"):  # of a refresh that died
        delete_path(spark, f"{root}/{part}/v={new}")
    before = _manifest(spark, root, old)
    known = before.where("kind = 'file'")
    now = reliable(listed(spark, source_dir))
    same = ["name", "size", "changed"]
    fresh = now.join(known, same, "left_anti")
    gone = reliable(known.join(now, same, "left_anti"))
    names = [r["name"] for r in fresh.select("name").collect()]
    n_gone = gone.count()
    if not names and not n_gone:
        return Report(old)
    if names:
        raw = spark.read.parquet(*names)
        rows = observations(raw.withColumn("_file", F.col("_metadata.file_path")))
        rows.where(F.col(S.SERIES).isNotNull() & F.col(S.DT).isNotNull()) \
            .groupBy(F.col("_file").alias("file"), S.SERIES, S.DT).agg(F.sum("amount").cast("decimal(28,2)").alias("amount")) \
            .write.parquet(f"{root}/totals/v={new}")
    else:
        spark.createDataFrame([], TOTALS).write.parquet(f"{root}/totals/v={new}")
    kept = known.join(now, same, "left_semi").unionByName(
        fresh.select(F.lit("file").alias("kind"), *same, F.lit(new).alias("version")))
    touched = _totals(spark, root, fresh.withColumn("version", F.lit(new)).select("name", "version")
                      .union(gone.select("name", "version"))).select(S.DT).distinct()
    days = reliable(touched)
    report = Report(new, len(names), n_gone, days.count())
    totals = _totals(spark, root, kept)
    bounds = totals.agg(F.min(S.DT), F.max(S.DT)).first()
    old_bounds = _totals(spark, root, known).agg(F.min(S.DT), F.max(S.DT)).first() if old else (None, None)
    months = _months(days, bounds, old_bounds, look_back)
    if months and bounds[0]:
        report.totals_read = _write_months(spark, totals, bounds, months, f"{root}/features/v={new}", look_back, drop_from_name)
    report.months_written = [m.isoformat() for m in months]
    done = spark.createDataFrame([("month", m.isoformat(), None, None, new) for m in months], MANIFEST)
    rest = before.where(F.col("kind") == "month").join(done.select("name"), "name", "left_anti").select(*done.columns)
    # months that the panel no longer reaches go
    rest = rest.where(F.col("name").between(*[b.replace(day=1).isoformat() for b in bounds])) if bounds[0] else rest.where("false")
    if publish:
        kept.select(*done.columns).unionByName(rest).unionByName(done).coalesce(1).write.parquet(f"{root}/manifest/v={new}")
    return report


def _months(days: DataFrame, bounds, old_bounds, look_back: int) -> list[dt.date]:
    """First days of the months whose features a refresh has to compute again, in order."""
    lo, hi = bounds
    if lo is None:
        return []
    if lo != old_bounds[0]:  # the panel begins on another day: every row's history is another
        days = days.sparkSession.createDataFrame([(lo, hi)], "a date, b date")
    else:
        ahead = days.select(F.col(S.DT).alias("a"), F.least(F.date_add(S.DT, look_back), F.lit(hi)).alias("b"))
        # all series get the days up to the new end; days after an earlier end go with their month
        moved = sorted([hi, old_bounds[1]])
        days = ahead.where("a <= b").unionByName(days.sparkSession.createDataFrame(
            [tuple(moved)] if hi > old_bounds[1] else [(hi, hi)] if hi < old_bounds[1] else [], "a date, b date"))
    found = days.select(F.explode(F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))).alias("m")).distinct()
    return sorted(r["m"] for r in found.collect())


def _write_months(spark, totals, bounds, months, path, look_back, drop_from_name) -> int:
    start = max(bounds[0], months[0] - dt.timedelta(days=look_back))
    end = min(bounds[1], (months[-1].replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1))
    some = reliable(totals.where(F.col(S.DT).between(F.lit(start), F.lit(end))).groupBy(S.SERIES, S.DT).agg(F.sum("amount").alias("amount")))
    # every series has all days of the panel, also one without rows in this stretch
    idle = totals.select(S.SERIES).distinct().select(S.SERIES, F.lit(start).alias(S.DT), F.lit(0).cast("decimal(38,2)").alias("amount"))
    panel = pnl.build_panel(some.unionByName(idle), start, end, drop_from_name=drop_from_name)
    rows = feat.processed_panel(panel).withColumn("of_month", F.trunc(S.DT, "month"))
    rows.where(F.col("of_month").isin(months)).repartition("of_month").write.partitionBy("of_month").parquet(path)
    return some.count()


def current(spark: SparkSession, root: str) -> DataFrame:
    """The processed panel of the last published version."""
    version = _version(spark, root)
    months = _manifest(spark, root, version).where("kind = 'month'").select(F.col("name").cast("date").alias("of_month"), F.col("version").alias("v"))
    kinds = ", ".join(f"{c} {'int' if c in S.CALENDAR_INT_COLS else 'double'}" for c in S.FEATURE_NAMES)
    if not version:
        return spark.createDataFrame([], f"series_id string, series_name string, dt date, y long, {kinds}")
    # months are a few hundred at most, so the list of those in use is broadcast and prunes the folders
    return spark.read.parquet(f"{root}/features").join(F.broadcast(months), ["of_month", "v"], "left_semi").drop("of_month", "v")
