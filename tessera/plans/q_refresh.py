"""The processed panel, refreshed file by file."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import refresh
from tessera.plans.q_panel import _CYC6, _PROCESSED_SQL
from tessera.plans.registry import query, round_doubles
from tessera.session import shared_path
from tessera.sources import tables
from tessera.tables import reliable


def _observations(raw):
    return raw.select(F.col("o_orderpriority").alias(S.SERIES), F.to_date("o_orderdate").alias(S.DT),
                      F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), "_file")


@query("refreshed_panel", _PROCESSED_SQL)
def refreshed_panel(spark, sf_dir):
    """Orders that arrive as files in three parts (a hundredth of them one part late): the store is refreshed after each
    part, from new files and changed months only; the panel of the last version."""
    run = shared_path(spark, f"refresh-{uuid.uuid4().hex}")
    raw = tables.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice"])
    day, late = F.to_date("o_orderdate"), (F.pmod(F.xxhash64("o_orderkey"), F.lit(100)) == 0).cast("int")
    due = F.when(day < "1998-01-01", 0).when(day < "2001-01-01", 1).otherwise(2)
    parts = reliable(raw.withColumn("part", F.least(due + late, F.lit(2))))
    for part in range(3):
        parts.where(F.col("part") == part).drop("part").coalesce(4).write.parquet(f"{run}/source/part{part}")
        refresh.refresh(spark, f"{run}/source", f"{run}/store", _observations, drop_from_name=tables.ORDER_RANK)
    return round_doubles(refresh.current(spark, f"{run}/store"), 4, _CYC6)
