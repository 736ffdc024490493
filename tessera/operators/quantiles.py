"""Exact median per group without buffering a group in one task.

``percentile``/``median`` keep every distinct value of a group in one
aggregation buffer, so a group holding a large share of the rows lands in a
single task.  Here the median is found by bracketing, in rounds:

1. per group (over the values still in play, the "pool"): count and a grid
   of approximate quantiles (``percentile_approx``, a mergeable fixed-size
   sketch); the grid points around the wanted middle ranks give a bracket;
2. per group: exact count of pool values below the bracket and inside it,
   which verifies that the bracket holds both middle ranks;
3. a verified bracket with equal bounds is the answer; one holding at most
   ``max_bracket`` values is collected (bounded) and the middle ranks are
   picked exactly; otherwise the pool shrinks to the bracket (about
   ``grid``/3 times smaller) and the next round starts.

Each round is a few distributed aggregations; only the per-group state (one
row per group) is carried between rounds, checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _small(df: DataFrame) -> DataFrame:
    from tessera.tables import reliable
    return reliable(df)


def exact_median(df: DataFrame, keys: list[str], value: str, grid: int = 200,
                 accuracy: int = 10000, max_bracket: int = 100000, max_rounds: int = 64) -> DataFrame:
    """(keys..., median): the average of the two middle values (interpolated
    median, as numpy/pandas); nulls ignored; a group without values -> null."""
    # the narrow (keys, value) column is materialised once: every round reads it
    # instead of recomputing the upstream plan
    base = _small(df.select(*keys, F.col(value).cast("double").alias("_v")))
    v = base.where(F.col("_v").isNotNull())
    fractions = [i / grid for i in range(grid + 1)]
    state_keys = base.select(*keys).distinct()
    state = _small(v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, ((F.col("_n") - 1) / 2).cast("long").alias("_k1"),
        (F.col("_n") / 2).cast("long").alias("_k2"), F.lit(0).cast("long").alias("_below")))
    pool = v
    parts = []
    for _ in range(max_rounds):
        g = pool.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"),
                                    F.percentile_approx("_v", fractions, accuracy).alias("_g"))
        st = state.join(g, keys)
        span = F.greatest(F.col("_m") - 1, F.lit(1)).cast("double")
        p1 = (F.col("_k1") - F.col("_below")) / span
        p2 = (F.col("_k2") - F.col("_below")) / span
        i_lo = F.greatest(F.floor(p1 * grid).cast("int") - 1, F.lit(0)) + 1
        i_hi = F.least(F.ceil(p2 * grid).cast("int") + 1, F.lit(grid)) + 1
        st = _small(st.select(*keys, "_k1", "_k2", "_below", "_m",
                              F.element_at("_g", i_lo).alias("_lo"), F.element_at("_g", i_hi).alias("_hi")))
        inb = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
        cnt = pool.join(st.select(*keys, "_lo", "_hi"), keys).groupBy(*keys).agg(
            F.sum((F.col("_v") < F.col("_lo")).cast("long")).alias("_cl"),
            F.sum(inb.cast("long")).alias("_ci"))
        st = st.join(cnt, keys)
        ok = ((F.col("_below") + F.col("_cl") <= F.col("_k1"))
              & (F.col("_below") + F.col("_cl") + F.col("_ci") > F.col("_k2")))
        # a failed bracket (outside the sketch's guarantee) falls back to the whole pool
        st = _small(st.select(
            *keys, "_k1", "_k2", "_below", "_m",
            F.when(ok, F.col("_lo")).otherwise(F.lit(float("-inf"))).alias("_lo"),
            F.when(ok, F.col("_hi")).otherwise(F.lit(float("inf"))).alias("_hi"),
            F.when(ok, F.col("_cl")).otherwise(F.lit(0)).cast("long").alias("_cl"),
            F.when(ok, F.col("_ci")).otherwise(F.col("_m")).cast("long").alias("_ci")))
        flat = st.where(F.col("_lo") == F.col("_hi")).select(*keys, F.col("_lo").alias("median"))
        small = st.where((F.col("_lo") < F.col("_hi")) & (F.col("_ci") <= max_bracket))
        picked = (pool.join(small.select(*keys, "_lo", "_hi", "_cl", "_k1", "_k2", "_below"), keys)
                  .where(inb)
                  .groupBy(*keys, "_cl", "_k1", "_k2", "_below")
                  .agg(F.sort_array(F.collect_list("_v")).alias("_a")))
        base = F.col("_below") + F.col("_cl")
        picked = picked.select(*keys, ((F.element_at("_a", (F.col("_k1") - base + 1).cast("int"))
                                        + F.element_at("_a", (F.col("_k2") - base + 1).cast("int"))) / 2)
                               .alias("median"))
        parts += [flat, picked]
        open_ = st.where((F.col("_lo") < F.col("_hi")) & (F.col("_ci") > max_bracket))
        if open_.limit(1).count() == 0:
            break
        pool = pool.join(open_.select(*keys, "_lo", "_hi"), keys).where(inb).select(*keys, "_v")
        state = _small(open_.select(*keys, "_k1", "_k2", (F.col("_below") + F.col("_cl")).alias("_below")))
    else:
        raise RuntimeError(f"the median's brackets did not close in {max_rounds} rounds")
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return state_keys.join(res, keys, "left")
