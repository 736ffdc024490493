"""Readers for the driver tables and the observation streams built from them.

Every reader selects only the columns it needs so that the parquet scan
prunes columns; filters written later on these frames reach the scan as
``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schema as S

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# TPC-H dimension tables with a fixed row count (25 nations, 5 regions):
# the only tables this engine broadcasts without a runtime size check.
FIXED_SIZE_TABLES = {"nation": 25, "region": 5}


# order priorities carry a rank in front of their name ("1-URGENT")
ORDER_RANK = r"^[0-9]+-"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and modification times of the tables in a folder (two levels), as one hash."""
    import hashlib
    root = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for s in fs.listStatus(root):
        for f in fs.listStatus(s.getPath()) if s.isDirectory() else [s]:
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha1(repr(sorted(found)).encode()).hexdigest()[:16]


def orders_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: series = order priority, dt = order date, amount = total price.

    Money is summed as decimal(18,2) so totals do not depend on summation order.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority", "o_orderdate", "o_totalprice"])
    return o.select(
        F.col("o_orderpriority").alias(S.SERIES),
        F.to_date("o_orderdate").alias(S.DT),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


def events_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: series = event type, dt = event date, amount = value."""
    e = read_table(spark, sf_dir, "events", ["event_type", "ts", "value"])
    return e.select(
        F.col("event_type").alias(S.SERIES),
        F.to_date("ts").alias(S.DT),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )


def region_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders attributed to the customer's region (orders -> customer -> nation -> region).

    Orders are first reduced to one row per (customer, day) with a partial
    aggregation, so a customer holding a large share of all orders is a few
    rows per day before the join; the exact decimal sums make this
    pre-aggregation lossless.  orders x customer is data-sized and left to the
    planner (AQE turns it into a broadcast only when the measured customer
    side is below the threshold); nation and region have a fixed row count
    and are broadcast.
    """
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    per_day = (o.where(F.col("o_custkey").isNotNull() & F.col("o_orderdate").isNotNull())
               .groupBy("o_custkey", F.to_date("o_orderdate").alias(S.DT))
               .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")))
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    joined = (per_day.join(c, per_day.o_custkey == c.c_custkey)
              .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    return joined.select(F.col("r_name").alias(S.SERIES), S.DT, "amount")


OBSERVATION_SOURCES = {
    "orders": orders_observations,
    "events": events_observations,
    "region": region_observations,
}
