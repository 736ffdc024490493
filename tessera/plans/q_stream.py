"""Streaming query: live daily panel from the events table as a file stream."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import panel as pnl
from tessera.plans.q_panel import _CYC6, _PROCESSED_SQL
from tessera.plans.registry import query, round_doubles
from tessera.session import shared_path
from tessera.sources import tables
from tessera.operators import features as feat
from tessera.streaming import live_features, live_panel as live
from tessera.tables import reliable


@query("stream_daily_panel", """WITH d AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS dt, count(*) AS n_events,
         sum(CAST(value AS DECIMAL(18,2))) AS amount
  FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2),
b AS (SELECT min(dt) AS lo, max(dt) AS hi FROM d),
sp AS (SELECT s.series_id, CAST(unnest(generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dt
       FROM (SELECT DISTINCT series_id FROM d) s CROSS JOIN b)
SELECT sp.series_id, sp.dt, CAST(floor(greatest(coalesce(d.amount, 0), 1000)) AS BIGINT) AS y,
       CAST(coalesce(d.n_events, 0) AS BIGINT) AS n_events
FROM sp LEFT JOIN d ON sp.series_id = d.series_id AND sp.dt = d.dt""")
def stream_daily_panel(spark, sf_dir):
    """Events as a file stream (the whole table is a backfill, so without a watermark) -> 1-day
    windows per event type -> exactly-once
    micro-batch sink -> newest aggregate per day -> gap-filled panel (y clamped as the
    batch panel, plus the event count)."""
    run = shared_path(spark, f"stream-{uuid.uuid4().hex}")
    schema = tables.read_table(spark, sf_dir, "events").schema
    stream = live.daily_stream(spark, tables.table_path(sf_dir, "events"), None, schema, "ts", "event_type", "value",
                               watermark=None)
    live.run_to_completion(stream, f"{run}/sink", f"{run}/checkpoint",
                           state_partitions=spark.sparkContext.defaultParallelism)
    daily = live.read_latest(spark, f"{run}/sink")
    panel = pnl.build_panel(daily.select(S.SERIES, S.DT, "amount"))
    counts = daily.select(S.SERIES, S.DT, "n_events")
    return (panel.join(counts, [S.SERIES, S.DT], "left")
            .select(S.SERIES, S.DT, S.Y, F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events")))


def post_observations(obs, folder: str, arrival: int, arrivals: int, lo, hi, files: int = 2) -> None:
    """The observations that a source would have posted in the ``arrival``-th of ``arrivals`` equal spans from ``lo`` to ``hi``, as files.

    A twentieth comes one span later than it should.  Every series posts a heartbeat (amount 0) on the first day of all and on
    the last day of each span.
    """
    days = -(-((hi - lo).days + 1) // arrivals)
    due = F.floor(F.datediff("dt", F.lit(lo)) / F.lit(days))
    late = (F.pmod(F.xxhash64("series_id", "dt", "amount"), F.lit(20)) == 0) & (due < arrivals - 1)
    rows = obs.where(due + late.cast("int") == arrival).select("series_id", "dt", "amount")
    ends = [min(lo + dt.timedelta(days=(arrival + 1) * days - 1), hi), *([lo] if arrival == 0 else [])]
    beats = obs.select("series_id").distinct().select("series_id", F.explode(F.array(*[F.lit(d) for d in ends])).alias("dt"),
                                                      F.lit(0).cast("decimal(18,2)").alias("amount"))
    rows.union(beats).coalesce(files).write.mode("append").parquet(folder)


@query("live_features", _PROCESSED_SQL)
def live_features_query(spark, sf_dir):
    """Orders as a stream of files: state per order priority, late rows reopen their days, the stream is stopped and
    started again after every third of the files; the newest features of every complete day."""
    run = shared_path(spark, f"live-features-{uuid.uuid4().hex}")
    obs = reliable(tables.orders_observations(spark, sf_dir).where("series_id is not null and dt is not null"))
    arrivals = 18
    lo, hi = obs.agg(F.min("dt"), F.max("dt")).first()
    for arrival in range(arrivals if lo else 0):
        post_observations(obs, f"{run}/source", arrival, arrivals, lo, hi)
        if arrival % 6 == 5:
            stream = live_features.observation_stream(spark, f"{run}/source", max_files_per_trigger=6)
            live_features.run_available(stream, f"{run}/sink", f"{run}/checkpoint", spark.sparkContext.defaultParallelism,
                                        tables.ORDER_RANK)
    return round_doubles(feat.drop_incomplete(live_features.current(spark, f"{run}/sink")), 4, _CYC6)
