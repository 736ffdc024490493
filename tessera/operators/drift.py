"""Drift of a panel's values: distances between months, from rows or from stored sketches, and change points.

* :func:`monthly_drift` compares each month of a series with the ``reference`` months before it: the population stability
  index over tenths of the reference, and the Kolmogorov–Smirnov distance.  A row is sent to its own month and
  to those that it is a reference of, a fixed number, and a (series, month) group holds one row per day.
* :func:`month_sketches` keeps one mergeable quantile sketch (KLL) and one distinct-count sketch (HLL) per series and month.
  They are stored, new months are added as rows, and :func:`merged`, :func:`range_quantiles` and :func:`sketch_drift` answer
  from them without raw rows, for panels whose groups are too large for the exact way (or whose raw rows are gone).
* :func:`change_points` folds a two-sided CUSUM over each series in one expression: after ``warm`` days of
  baseline the standardised deviations beyond ``slack`` add up; above ``limit`` an alarm gives the day on which the sum left
  zero, and a new baseline begins on the next day.

Rows without a value or day are not read.  Months without rows give no row; a month without any reference rows gives null
distances.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera import schema as S

TENTHS = 10
LEAST_SHARE = 1e-4  # a share below this counts as this, so that the index stays finite


def _month(c: Column) -> Column:
    return F.trunc(c, "month")


def _known(panel: DataFrame, y: str) -> DataFrame:
    return panel.select(S.SERIES, S.DT, F.col(y).cast("double").alias("y")).dropna()


def psi(shares: Column, reference: Column) -> Column:
    """Population stability index of two arrays of shares."""
    def one(p, q):
        p, q = F.greatest(p, F.lit(LEAST_SHARE)), F.greatest(q, F.lit(LEAST_SHARE))
        return (p - q) * F.log(p / q)
    return F.aggregate(F.zip_with(shares, reference, one), F.lit(0.0), lambda a, x: a + x)


def ks_limit(n: Column, m: Column) -> Column:
    """The distance that two samples of one distribution pass in one case of twenty."""
    return F.lit(1.358) * F.sqrt((n + m) / (n * m))


def monthly_drift(panel: DataFrame, y: str = S.Y, reference: int = 12) -> DataFrame:
    """series_id, month, n, ref_n, psi, ks, ks_limit of every series and month."""
    rows = _known(panel, y).withColumn("own", _month(F.col(S.DT)))
    months = rows.select(S.SERIES, F.col("own").alias("month")).distinct()
    sent = rows.withColumn("month", F.explode(F.sequence("own", F.add_months("own", reference), F.expr("interval 1 month")))) \
        .select(S.SERIES, "month", "y", (F.col("own") == F.col("month")).alias("now")).join(months, [S.SERIES, "month"], "left_semi")
    by = W.partitionBy(S.SERIES, "month")
    upto = by.orderBy("y").rangeBetween(W.unboundedPreceding, 0)
    now, ref = F.col("now").cast("long"), (~F.col("now")).cast("long")
    counted = sent.select("*", F.sum(now).over(by).alias("n"), F.sum(ref).over(by).alias("ref_n"),
                          F.sum(now).over(upto).alias("below"), F.sum(ref).over(upto).alias("ref_below"))
    # a row's tenth is that of its place among the reference: how many of the nine cuts lie below it
    place = F.col("ref_below") - F.coalesce(F.sum(ref).over(by.orderBy("y").rangeBetween(0, 0)), F.lit(0))
    tenth = F.least(F.floor(F.try_divide(place * TENTHS, F.col("ref_n"))), F.lit(TENTHS - 1))
    cut = counted.withColumn("tenth", tenth)
    shares = [F.array(*[F.sum(F.when(F.col("tenth") == k, c).otherwise(0)) / F.max(total) for k in range(TENTHS)])
              for c, total in ((now, "n"), (ref, "ref_n"))]
    gap = F.abs(F.col("below") / F.col("n") - F.try_divide(F.col("ref_below"), F.col("ref_n")))
    one = cut.groupBy(S.SERIES, "month", "n", "ref_n").agg(
        F.when(F.col("ref_n") > 0, F.max(gap)).alias("ks"), *[F.when(F.col("ref_n") > 0, s).alias(a) for s, a in zip(shares, ("p", "q"))])
    return one.select(S.SERIES, "month", "n", "ref_n", psi(F.col("p"), F.col("q")).alias("psi"), "ks",
                      F.when(F.col("ref_n") > 0, ks_limit(F.col("n"), F.col("ref_n"))).alias("ks_limit"))


# ---- stored sketches --------------------------------------------------------------------------

def month_sketches(panel: DataFrame, y: str = S.Y, k: int = 200) -> DataFrame:
    """One row per series and month: n, least, most, values (KLL sketch of ``k``), different (HLL sketch)."""
    rows = _known(panel, y).withColumn("month", _month(F.col(S.DT)))
    return rows.groupBy(S.SERIES, "month").agg(
        F.count("*").alias("n"), F.min("y").alias("least"), F.max("y").alias("most"),
        F.kll_sketch_agg_double("y", F.lit(k)).alias("values"), F.hll_sketch_agg(F.col("y").cast("string")).alias("different"))


def merged(sketches: DataFrame, *keys: str) -> DataFrame:
    """The sketches of all rows of the ``keys`` as one: n, least, most, values, different."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
                                       F.kll_merge_agg_double("values").alias("values"), F.hll_union_agg("different").alias("different"))


def range_quantiles(sketches: DataFrame, since, until, at: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per series over the months from ``since`` to ``until``: n, least, most, n_different, quantiles."""
    some = merged(sketches.where(F.col("month").between(F.lit(since).cast("date"), F.lit(until).cast("date"))), S.SERIES)
    return some.select(S.SERIES, "n", "least", "most", F.hll_sketch_estimate("different").alias("n_different"),
                       F.kll_sketch_get_quantile_double("values", F.array(*[F.lit(float(q)) for q in at])).alias("quantiles"))


def sketch_drift(sketches: DataFrame, reference: int = 12, grid: int = 200) -> DataFrame:
    """What :func:`monthly_drift` gives, from stored sketches: both sides are read at ``grid`` evenly spaced ranks, so a
    share is known to 1 / ``grid`` beside the sketches' own error."""
    ahead = sketches.withColumn("month", F.explode(F.sequence(F.add_months("month", 1), F.add_months("month", reference),
                                                              F.expr("interval 1 month"))))
    past = merged(ahead, S.SERIES, "month").select(S.SERIES, "month", F.col("n").alias("ref_n"), F.col("values").alias("past"))
    both = sketches.select(S.SERIES, "month", "n", "values").join(past, [S.SERIES, "month"], "left")
    has = F.col("ref_n").isNotNull()

    def quantiles(sketch, parts):
        return F.when(has, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / parts) for i in range(1, parts + 1)])))

    def ranks(known, points):
        return F.transform(points, lambda x: F.size(F.filter(known, lambda q: q <= x)) / F.lit(grid))
    both = both.withColumns({"a": quantiles("values", grid), "b": quantiles("past", grid),
                             "cuts": F.slice(quantiles("past", TENTHS), 1, TENTHS - 1)})

    def shares(known):
        r = F.concat(F.array(F.lit(0.0)), ranks(known, F.col("cuts")), F.array(F.lit(1.0)))
        return F.zip_with(F.slice(r, 2, TENTHS), F.slice(r, 1, TENTHS), lambda x, y: x - y)
    points = F.concat("a", "b")
    gaps = F.zip_with(ranks(F.col("a"), points), ranks(F.col("b"), points), lambda x, y: F.abs(x - y))
    return both.select(S.SERIES, "month", "n", F.coalesce("ref_n", F.lit(0)).alias("ref_n"),
                       F.when(has, psi(shares(F.col("a")), shares(F.col("b")))).alias("psi"), F.when(has, F.array_max(gaps)).alias("ks"),
                       F.when(has, ks_limit(F.col("n"), F.col("ref_n"))).alias("ks_limit"))


# ---- change points ----------------------------------------------------------------------------

CHANGE = "struct<change_dt: date, alarm_dt: date, direction: string, baseline: double, deviation: double>"
_STATE = f"struct<n: int, mean: double, m2: double, hi: double, lo: double, hi_dt: date, lo_dt: date, found: array<{CHANGE}>>"


def change_points(panel: DataFrame, y: str = S.Y, warm: int = 60, slack: float = 0.5, limit: float = 8.0) -> DataFrame:
    """series_id, change_dt, alarm_dt, direction (up or down), baseline, deviation (of the baseline before the change).

    A baseline without any deviation gives an alarm at the first other value.
    """
    def step(a, r):
        v, day = r["y"], r[S.DT]
        mean = a["mean"] + (v - a["mean"]) / (a["n"] + 1)
        learnt = F.struct((a["n"] + 1).alias("n"), mean.alias("mean"), (a["m2"] + (v - a["mean"]) * (v - mean)).alias("m2"),
                          F.lit(0.0).alias("hi"), F.lit(0.0).alias("lo"), F.lit(None).cast("date").alias("hi_dt"),
                          F.lit(None).cast("date").alias("lo_dt"), a["found"].alias("found")).cast(_STATE)
        deviation = F.sqrt(a["m2"] / (a["n"] - 1))
        z = F.when(deviation > 0, (v - a["mean"]) / deviation).otherwise(F.signum(v - a["mean"]) * (limit + slack + 1))
        hi, lo = F.greatest(a["hi"] + z - slack, F.lit(0.0)), F.greatest(a["lo"] - z - slack, F.lit(0.0))
        hi_dt = F.when(hi > 0, F.when(a["hi"] > 0, a["hi_dt"]).otherwise(day))
        lo_dt = F.when(lo > 0, F.when(a["lo"] > 0, a["lo_dt"]).otherwise(day))
        up = hi > limit
        change = F.struct(F.when(up, hi_dt).otherwise(lo_dt), day, F.when(up, F.lit("up")).otherwise(F.lit("down")), a["mean"], deviation).cast(CHANGE)
        zero = F.lit(0.0)
        fresh = F.struct(F.lit(0), zero, zero, zero, zero, F.lit(None).cast("date"), F.lit(None).cast("date"),
                         F.concat(a["found"], F.array(change))).cast(_STATE)
        on = F.struct(a["n"], a["mean"], a["m2"], hi, lo, hi_dt, lo_dt, a["found"]).cast(_STATE)
        return F.when(a["n"] < max(2, warm), learnt).when(up | (lo > limit), fresh).otherwise(on)

    days = _known(panel, y).groupBy(S.SERIES).agg(F.sort_array(F.collect_list(F.struct(S.DT, "y"))).alias("days"))
    nothing = F.lit(None).cast("date")
    start = F.struct(F.lit(0), *[F.lit(0.0)] * 4, nothing, nothing, F.array().cast(f"array<{CHANGE}>")).cast(_STATE)
    return days.select(S.SERIES, F.explode(F.aggregate("days", start, step)["found"]).alias("c")).select(S.SERIES, "c.*")


def expected_rank_error(k: int) -> float:
    """Rank error that a KLL sketch of ``k`` keeps with 99 per cent, as its authors give it."""
    return 2.296 / math.pow(k, 0.9021)
