"""Live features: the 29 features of the daily panel, kept up to date by a stream of observations.

Observations (series_id, dt, amount) come as files.  Every series is one key of a stateful operator: its state holds
the day totals of the last ``look_back + reopen`` days and the first of these days, in a state store on disk
(RocksDB), so a state does not grow with a series' age and the states of all series need not fit in memory.

A micro-batch adds its observations to the totals.  Days between observations are gap days of the panel.  An observation
may be late: if it lies at most ``reopen`` days before the series' last day, its day is reopened, and that day and
all later ones get new features.  What comes later still is returned as a row of its own (``too_late``), never dropped
silently.  An idle series moves on by heartbeats, observations of amount 0, as its key would otherwise not be called.

The operator returns each changed day with its value and the values of the days before it; the features follow from
these by expressions (the same as in forecasts), without Python.  Every micro-batch is written to a folder of its
number, so a batch that runs again after a failure overwrites itself; readers take the newest row per series and day.
After a restart the query goes on from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera import schema as S
from tessera.operators import forecast as fc
from tessera.operators.panel import series_name_expr
from tessera.tables import path_exists

OBSERVATIONS = "series_id string, dt date, amount decimal(18,2)"
CHANGED = "series_id string, day int, y double, before array<double>, too_late boolean, cents long"
STATE = "first int, cents array<long>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHUNK = 500


def observation_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(OBSERVATIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def changed_days(observations: DataFrame, look_back: int = S.YEAR_LAG, reopen: int = 365, floor_value: int = S.Y_FLOOR) -> DataFrame:
    """Stateful part: rows of ``CHANGED`` for every day whose value or look-back changes in a micro-batch.

    Rows without series or day are not observations; a missing amount counts as 0.
    """
    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, cents = (state.get[0], np.array(state.get[1], np.int64)) if state.exists else (None, np.zeros(0, np.int64))
        oldest = None if first is None else first + len(cents) - 1 - reopen
        new: dict[int, int] = {}
        late: list[tuple[int, int]] = []
        for frame in frames:
            day, value = frame["day"].to_numpy(), frame["cents"].to_numpy()
            if oldest is not None:
                late += zip(day[day < oldest].tolist(), value[day < oldest].tolist())
                day, value = day[day >= oldest], value[day >= oldest]
            days, of = np.unique(day, return_inverse=True)
            sums = np.zeros(len(days), np.int64)
            np.add.at(sums, of, value)
            for d, s in zip(days.tolist(), sums.tolist()):
                new[d] = new.get(d, 0) + s
        if late:
            yield pd.DataFrame({"series_id": key[0], "day": [d for d, _ in late], "y": None, "before": None, "too_late": True,
                                "cents": [c for _, c in late]})
        if not new:
            return
        start = min(new) if first is None else min(first, min(new))
        end = max(new) if first is None else max(first + len(cents) - 1, max(new))
        total = np.zeros(end - start + 1, np.int64)
        if first is not None:
            total[first - start: first - start + len(cents)] = cents
        for d, c in new.items():
            total[d - start] += c
        y = (np.maximum(total, floor_value * 100) // 100).astype(np.float64)
        begin = min(new) if first is None else min(min(new), first + len(cents))  # gap days after the old end are new, too
        for a in range(begin, end + 1, _CHUNK):
            days = range(a, min(a + _CHUNK, end + 1))
            yield pd.DataFrame({"series_id": key[0], "day": list(days), "y": y[a - start: a - start + len(days)],
                                "before": [y[max(0, d - start - look_back): d - start] for d in days], "too_late": False,
                                "cents": total[a - start: a - start + len(days)]})
        kept = total[-(look_back + reopen + 1):]
        state.update((end - len(kept) + 1, kept.tolist()))

    rows = observations.where("series_id is not null and dt is not null") \
        .select(S.SERIES, F.unix_date("dt").alias("day"), (F.coalesce("amount", F.lit(0)) * 100).cast("long").alias("cents"))
    return rows.groupBy(S.SERIES).applyInPandasWithState(update, CHANGED, STATE, "update", GroupStateTimeout.NoTimeout)


def with_features(changed: DataFrame, drop_from_name: str | None = None) -> DataFrame:
    """series_id, series_name, dt, y and the 29 features of changed days, too_late and amount of the others."""
    d = changed.withColumns({S.DT: F.date_from_unix_date("day"), S.SERIES_NAME: series_name_expr(S.SERIES, drop_from_name)})
    f = fc.day_features(F.col("before"), F.col("y"), F.col(S.DT))
    return d.select(S.SERIES, S.SERIES_NAME, S.DT, F.col("y").cast("long").alias(S.Y), *[f[c].alias(c) for c in S.FEATURE_NAMES],
                    "too_late", (F.col("cents") / F.lit(100)).cast("decimal(18,2)").alias("amount"))


def run_available(stream: DataFrame, sink_dir: str, checkpoint_dir: str, state_partitions: int | None = None,
                  drop_from_name: str | None = None):
    """Process all files there are, then stop.  ``state_partitions`` counts at the first start only."""
    spark = stream.sparkSession
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}

    def write(batch: DataFrame, batch_id: int):
        with_features(batch, drop_from_name).withColumn("batch_id", F.lit(batch_id).cast("long")) \
            .write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        q = changed_days(stream).writeStream.outputMode("update").foreachBatch(write) \
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return q


def _sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    if path_exists(spark, sink_dir):
        return spark.read.parquet(sink_dir).drop("batch")
    kinds = ", ".join(f"{c} double" for c in S.FEATURE_NAMES)
    return spark.createDataFrame([], f"series_id string, series_name string, dt date, y long, {kinds}, too_late boolean, "
                                     "amount decimal(18,2), batch_id long")


def current(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The newest features of every series and day."""
    w = Window.partitionBy(S.SERIES, S.DT).orderBy(F.col("batch_id").desc())
    return _sink(spark, sink_dir).where("not too_late").withColumn("_rn", F.row_number().over(w)).where("_rn = 1") \
        .select(S.SERIES, S.SERIES_NAME, S.DT, S.Y, *S.FEATURE_NAMES)


def too_late(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Observations that came more than ``reopen`` days after their series' last day."""
    return _sink(spark, sink_dir).where("too_late").select(S.SERIES, S.DT, "amount", "batch_id")
