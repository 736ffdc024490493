import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import types as T

from tessera.streaming import live_panel as live

SCHEMA = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("event_type", T.StringType()),
                       T.StructField("value", T.DoubleType())])


def _write(path, rows):
    table = pa.table({"ts": pa.array([r[0] for r in rows], pa.timestamp("us")),
                      "event_type": [r[1] for r in rows], "value": [r[2] for r in rows]})
    pq.write_table(table, path)


def _totals(spark, sink):
    return {(r.series_id, r.dt.isoformat()): (r.n_events, float(r.amount))
            for r in live.read_latest(spark, sink).collect()}


def test_late_data_updates_and_watermark_drops(spark, tmp_path):
    src, sink, ckpt = tmp_path / "src", str(tmp_path / "sink"), str(tmp_path / "ckpt")
    src.mkdir()
    d = lambda day, h=12: dt.datetime(2024, 1, day, h)

    def run():
        stream = live.daily_stream(spark, str(src), "*.parquet", SCHEMA, "ts", "event_type", "value",
                                   watermark="2 days")
        live.run_to_completion(stream, sink, ckpt)

    _write(src / "a.parquet", [(d(1), "click", 1.5), (d(1, 13), "click", 2.0), (d(2), "view", 4.0)])
    run()
    assert _totals(spark, sink) == {("click", "2024-01-01"): (2, 3.5), ("view", "2024-01-02"): (1, 4.0)}

    # a late click for day 1 (inside the watermark) and a new day 10
    _write(src / "b.parquet", [(d(1, 20), "click", 1.0), (d(10), "view", 7.0)])
    run()
    got = _totals(spark, sink)
    assert got[("click", "2024-01-01")] == (3, 4.5)
    assert got[("view", "2024-01-10")] == (1, 7.0)

    # the watermark is now day 8: an event for day 2 is too late and is dropped
    _write(src / "c.parquet", [(d(2, 15), "view", 100.0), (d(11), "view", 1.0)])
    run()
    got = _totals(spark, sink)
    assert got[("view", "2024-01-02")] == (1, 4.0)
    assert got[("view", "2024-01-11")] == (1, 1.0)


def test_day_windows_ignore_session_time_zone(spark, tmp_path):
    src, sink, ckpt = tmp_path / "src", str(tmp_path / "sink"), str(tmp_path / "ckpt")
    src.mkdir()
    _write(src / "a.parquet", [(dt.datetime(2024, 1, 1, 0, 30), "click", 1.0),
                               (dt.datetime(2024, 1, 1, 23, 30), "click", 2.0),
                               (dt.datetime(2024, 1, 2, 0, 10), "click", 4.0)])
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        stream = live.daily_stream(spark, str(src), "*.parquet", SCHEMA, "ts", "event_type", "value")
        live.run_to_completion(stream, sink, ckpt)
        got = _totals(spark, sink)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {("click", "2024-01-01"): (2, 3.0), ("click", "2024-01-02"): (1, 4.0)}


def test_table_folder_equals_the_batch_panel(spark, tmp_path):
    """A table written by Spark is a folder of part files; late files of a backfill count in full."""
    from pyspark.sql import functions as F

    rows = [(dt.datetime(2024, 1, d, h), f"type{d % 3}", float(d + h)) for d in range(1, 20) for h in (3, 12)]
    df = spark.createDataFrame(rows, SCHEMA)
    table = str(tmp_path / "events.parquet")
    df.orderBy(F.col("ts").desc()).repartition(4).write.parquet(table)
    sink = str(tmp_path / "sink")
    assert live.read_latest(spark, sink).count() == 0
    stream = live.daily_stream(spark, table, None, SCHEMA, "ts", "event_type", "value", watermark=None,
                               max_files_per_trigger=1)
    live.run_to_completion(stream, sink, str(tmp_path / "checkpoint"))
    want = df.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    assert _totals(spark, sink) == {(r.event_type, r.day.isoformat()): (r.n, r.v) for r in want.collect()}
