"""Structured Streaming form of the panel builder (live refresh).

New event files arriving in a folder are aggregated into daily totals per
series with an event-time window and a watermark; each micro-batch's updated
aggregates are written by ``foreachBatch`` into a batch-id-named folder
(idempotent on replay), and readers take the newest row per (series, day).
Checkpoint and sink live below ``spark.checkpoint.dir`` so a restarted query
resumes from its offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.tables import is_file, path_exists


def daily_stream(spark: SparkSession, source_dir: str, file_glob: str | None, schema,
                 ts_col: str, series_col: str, value_col: str, watermark: str | None = "2 days",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Daily totals of the files below ``source_dir`` (a folder, or a table written as one file or
    a folder of part files); ``file_glob`` restricts file names.

    Rows that come more than ``watermark`` after the newest event are dropped, as Spark says
    when state is cleared.  For a backfill, where files may come in any order of time, give
    ``watermark=None``: state is then kept for every day and nothing is dropped.
    """
    if is_file(spark, source_dir):  # file streams read folders
        source_dir, file_glob = source_dir.rsplit("/", 1)
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(source_dir)
    ts = utc_instant(F.col(ts_col)) if schema[ts_col].dataType.typeName() == "timestamp_ntz" \
        else F.col(ts_col)
    rows = events.select(ts.alias("ts"), F.col(series_col).alias(S.SERIES),
                         F.col(value_col).cast("decimal(18,2)").alias("amount"))
    if watermark:
        rows = rows.withWatermark("ts", watermark)
    return (rows.groupBy(F.window("ts", "1 day").alias("w"), S.SERIES)
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("amount").alias("amount")))


def utc_instant(ntz):
    """TIMESTAMP whose UTC wall clock equals the TIMESTAMP_NTZ wall clock.

    Watermarks need TIMESTAMP; a plain cast would read the wall clock in the
    session time zone and shift the day windows.  Built from time-zone-free
    parts (unix day, hour, minute, seconds with fraction).
    """
    micros = (F.unix_date(F.to_date(ntz)).cast("long") * 86_400_000_000
              + F.hour(ntz).cast("long") * 3_600_000_000 + F.minute(ntz).cast("long") * 60_000_000
              + (F.date_part(F.lit("SECOND"), ntz) * 1_000_000).cast("long"))
    return F.timestamp_micros(micros)


def window_day(start):
    """Day of a UTC-aligned window start, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(start) / F.lit(86_400_000_000)).cast("int"))


def _writer(sink_dir: str):
    def write(batch: DataFrame, batch_id: int):
        (batch.select(S.SERIES, window_day(F.col("w.start")).alias(S.DT), "n_events", "amount",
                      F.lit(batch_id).cast("long").alias("batch_id"))
         .write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}"))
    return write


def run_to_completion(stream: DataFrame, sink_dir: str, checkpoint_dir: str,
                      state_partitions: int | None = None):
    """Process everything available now (update mode), then stop.

    ``state_partitions`` sets the number of state-store partitions of a new
    query (Spark fixes it at the first start and keeps it in the checkpoint);
    the session setting is restored right after the start.
    """
    spark = stream.sparkSession
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    if state_partitions:
        spark.conf.set(key, str(state_partitions))
    try:
        q = (stream.writeStream.outputMode("update").foreachBatch(_writer(sink_dir))
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, old)
    q.awaitTermination()
    return q


def read_latest(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Newest aggregate per (series, day) across micro-batches; no rows before the first batch."""
    if not path_exists(spark, sink_dir):
        return spark.createDataFrame([], "series_id string, dt date, n_events long, amount decimal(28,2)")
    df = spark.read.parquet(sink_dir)
    w = Window.partitionBy(S.SERIES, S.DT).orderBy(F.col("batch_id").desc())
    return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select(S.SERIES, S.DT, "n_events", "amount"))
