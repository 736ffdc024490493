"""Are two models' losses different?  Tests for dependent losses, per series and pair of models.

* :func:`diebold_mariano`: the mean loss difference over its long-run deviation, which counts the autocovariances of the
  first ``lags`` days with Bartlett's weights, since losses of neighbouring days are not independent.
* :func:`t_two_sided`: the two-sided p-value of Student's t as an expression, by the continued fraction of the incomplete
  beta function.
* :func:`block_bootstrap`: a seeded moving-block bootstrap of the mean difference; blocks are drawn by hashes and
  summed as differences of prefix sums, so a replicate costs as many steps as it has blocks.
* :func:`holm`: Holm's correction for the several pairs of a series.

Rows where the truth or a prediction is missing are not read.  Where the long-run variance is not positive (equal or constant
losses) or a series has fewer than two days, statistic and p-values are null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera import schema as S

PAIR = ["model_a", "model_b"]
KEYS = [S.SERIES, *PAIR]


def loss_differences(wide: DataFrame, models: list[str], y: str = S.Y, suffix: str = "_prediction") -> DataFrame:
    """series_id, dt, model_a, model_b, d: squared error of a minus that of b, for every pair in the models' order."""
    def loss(m):
        e = F.col(y).cast("double") - F.col(f"{m}{suffix}").cast("double")
        return e * e
    pairs = [F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), (loss(a) - loss(b)).alias("d"))
             for i, a in enumerate(models) for b in models[i + 1:]]
    return wide.select(S.SERIES, S.DT, F.explode(F.array(*pairs)).alias("p")).select(S.SERIES, S.DT, "p.*") \
        .where(F.col("d").isNotNull() & ~F.isnan("d"))


def diebold_mariano(differences: DataFrame, lags: int = 7) -> DataFrame:
    """series_id, model_a, model_b, n, mean_diff, long_run_var, statistic."""
    own = W.partitionBy(*KEYS)
    rows = differences.withColumn("c", F.col("d") - F.avg("d").over(own))
    day = own.orderBy(S.DT)
    rows = rows.select(*KEYS, "d", "c", *[(F.col("c") * F.lag("c", k).over(day)).alias(f"c{k}") for k in range(1, lags + 1)])
    sums = rows.groupBy(*KEYS).agg(F.count("*").alias("n"), F.avg("d").alias("mean_diff"), F.sum(F.col("c") * F.col("c")).alias("c0"),
                                   *[F.coalesce(F.sum(f"c{k}"), F.lit(0.0)).alias(f"c{k}") for k in range(1, lags + 1)])
    variance = F.col("c0")
    for k in range(1, lags + 1):
        variance = variance + F.lit(2.0 * (1 - k / (lags + 1))) * F.col(f"c{k}")
    out = sums.select(*KEYS, "n", "mean_diff", (variance / F.col("n")).alias("long_run_var"))
    ok = (F.col("n") > 1) & (F.col("long_run_var") > 0)
    return out.withColumn("statistic", F.when(ok, F.col("mean_diff") / F.sqrt(F.col("long_run_var") / F.col("n"))))


# ---- Student's t ------------------------------------------------------------------------------

def log_gamma(z: Column) -> Column:
    """ln Gamma(z) for z > 0: Stirling's series at z + 10, carried back."""
    w = z + 10.0
    series = 1.0 / (12.0 * w) - 1.0 / (360.0 * F.pow(w, F.lit(3))) + 1.0 / (1260.0 * F.pow(w, F.lit(5))) - 1.0 / (1680.0 * F.pow(w, F.lit(7)))
    below = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda s, i: s + F.log(z + i))
    return (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + series - below


def _fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """The continued fraction of the incomplete beta function (modified Lentz)."""
    def safe(v):
        return F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)

    def turn(s, term):
        d = 1.0 / safe(1.0 + term * s["d"])
        c = safe(1.0 + term / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def step(s, i):
        m = i.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        first = F.transform(F.array(turn(s, even)), lambda t: turn(t, odd))
        return first[0]
    d = 1.0 / safe(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)["h"]


def incomplete_beta(a: Column, b: Column, x: Column, steps: int = 200) -> Column:
    """The regularised incomplete beta function I_x(a, b)."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1.0 - x))
    near = front * _fraction(a, b, x, steps) / a
    far = 1.0 - front * _fraction(b, a, 1.0 - x, steps) / b
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x < (a + 1.0) / (a + b + 2.0), near).otherwise(far)


def t_two_sided(t: Column, freedom: Column) -> Column:
    """Probability that Student's t with ``freedom`` degrees is at least as far from 0 as ``t``."""
    v = freedom.cast("double")
    return incomplete_beta(v / 2.0, F.lit(0.5), v / (v + t * t))


# ---- bootstrap and correction -----------------------------------------------------------------

def block_bootstrap(differences: DataFrame, block: int = 14, replicates: int = 499, seed: int = 42) -> DataFrame:
    """series_id, model_a, model_b, bootstrap_p: how often the centred mean of drawn blocks is as far from 0 as the mean.

    A replicate draws as many blocks of ``block`` days (or of all days, where there are fewer) as cover the series.
    """
    sums = differences.withColumn("upto", F.sum("d").over(W.partitionBy(*KEYS).orderBy(S.DT).rowsBetween(W.unboundedPreceding, 0)))
    held = sums.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct(S.DT, "upto"))).alias("s")) \
        .select(*KEYS, F.concat(F.array(F.lit(0.0)), F.transform("s", lambda r: r["upto"])).alias("s"))
    n = F.size("s") - 1
    held = held.withColumns({"n": n, "len": F.least(n, F.lit(block))}).withColumn("blocks", F.ceil(F.col("n") / F.col("len")).cast("int"))
    mean = F.col("s")[F.col("n")] / F.col("n")

    def replicate(r):
        def one(total, j):
            at = F.pmod(F.xxhash64(F.lit(seed), *KEYS, r, j), (F.col("n") - F.col("len") + 1).cast("long")).cast("int")
            return total + F.transform(F.array(at), lambda i: F.col("s")[i + F.col("len")] - F.col("s")[i])[0]
        drawn = F.aggregate(F.sequence(F.lit(1), F.col("blocks")), F.lit(0.0), one) / (F.col("blocks") * F.col("len"))
        return (F.abs(drawn - mean) >= F.abs(mean)).cast("int")
    hits = F.aggregate(F.sequence(F.lit(1), F.lit(replicates)), F.lit(0), lambda a, r: a + replicate(r))
    return held.select(*KEYS, ((hits + 1) / F.lit(replicates + 1)).alias("bootstrap_p"))


def holm(tests: DataFrame, p: str = "p_value", family: tuple[str, ...] = (S.SERIES,), out: str = "holm_p") -> DataFrame:
    """``tests`` with p-values corrected within each family; null p-values stay null and do not count."""
    by = W.partitionBy(*family)
    order = by.orderBy(F.col(p).asc_nulls_last(), *[c for c in KEYS if c in tests.columns])
    left = F.count(p).over(by) - F.row_number().over(order) + 1
    scaled = tests.withColumn("_scaled", F.when(F.col(p).isNotNull(), F.least(F.col(p) * left, F.lit(1.0))))
    return scaled.withColumn(out, F.when(F.col(p).isNotNull(), F.max("_scaled").over(order.rowsBetween(W.unboundedPreceding, 0)))) \
        .drop("_scaled")


def loss_tests(wide: DataFrame, models: list[str], lags: int = 7, block: int = 14, replicates: int = 499, seed: int = 42) -> DataFrame:
    """All of it: statistic, p_value, holm_p and bootstrap_p of every series and pair."""
    d = loss_differences(wide, models)
    tests = diebold_mariano(d, lags).withColumn("p_value", t_two_sided(F.col("statistic"), F.col("n") - 1))
    return holm(tests).join(block_bootstrap(d, block, replicates, seed), KEYS)
