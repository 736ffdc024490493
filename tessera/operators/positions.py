"""Distributed running sums in a sort order (row positions without a global sort).

``exclusive_prefix_sum`` gives every row the sum of ``value`` over all rows
before it in ``order_cols`` order (optionally restarting per group):

1. range-partition the rows by (groups, order) and tag each row with its
   partition number; the tagged table is materialised once so retries see
   the same partitioning;
2. a running sum inside each (partition, group) - a window per partition;
3. the totals per (partition, group) - a table with at most
   #partitions x #groups rows - get their own running sum over the partition
   numbers, which is added back with a join.

No step puts more than one range partition into a task, so neither many
keys nor one hot key end up in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exclusive_prefix_sum(df: DataFrame, order_cols: list[str], value_col: str, out_col: str,
                         group_cols: list[str] | tuple = (), num_partitions: int | None = None) -> DataFrame:
    from tessera.tables import reliable

    group_cols = list(group_cols)
    # without an explicit count AQE may coalesce neighbouring ranges (partition
    # ids stay in range order); either way there are at most
    # spark.sql.shuffle.partitions ids
    ranged = (df.repartitionByRange(num_partitions, *group_cols, *order_cols) if num_partitions
              else df.repartitionByRange(*group_cols, *order_cols))
    tagged = reliable(ranged.withColumn("__pps_pid", F.spark_partition_id()))
    before = Window.unboundedPreceding
    local_w = Window.partitionBy("__pps_pid", *group_cols).orderBy(*order_cols).rowsBetween(before, -1)
    local = tagged.withColumn("__pps_local", F.coalesce(F.sum(value_col).over(local_w), F.lit(0)))
    totals = tagged.groupBy("__pps_pid", *group_cols).agg(F.sum(value_col).alias("__pps_tot"))
    part_w = Window.partitionBy(*group_cols).orderBy("__pps_pid").rowsBetween(before, -1)
    offsets = totals.select("__pps_pid", *group_cols,
                            F.coalesce(F.sum("__pps_tot").over(part_w), F.lit(0)).alias("__pps_off"))
    if not group_cols:
        # at most one row per partition id: a proven bound, safe to broadcast
        offsets = F.broadcast(offsets)
    return (local.join(offsets, ["__pps_pid", *group_cols])
            .withColumn(out_col, F.col("__pps_off") + F.col("__pps_local"))
            .drop("__pps_pid", "__pps_local", "__pps_off"))
