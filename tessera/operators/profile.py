"""Profiling aggregates and chart tables over a panel.

Each function is one aggregation (partial aggregation map-side, one shuffle
on the grouping keys) or a top-k; none collects rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import schema as S


def data_summary(panel: DataFrame, y: str = S.Y, approx: bool = False) -> DataFrame:
    """Row count, date range, distinct series, y statistics and exact median.

    The list of series names is not packed into this one row (it grows with
    the number of series); it is the distributed ``series_names`` table.
    ``approx`` uses HyperLogLog for the series count and a quantile sketch for
    the median (single pass, no exact median rounds).
    """
    from tessera.operators.quantiles import exact_median
    agg = panel.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.date_format(F.min(S.DT), "yyyy-MM-dd").alias("first_dt"),
        F.date_format(F.max(S.DT), "yyyy-MM-dd").alias("last_dt"),
        (F.approx_count_distinct(S.SERIES) if approx else F.count_distinct(S.SERIES)).alias("n_series"),
        F.avg(y).alias("y_mean"),
        F.stddev_samp(y).alias("y_std"),
        F.min(y).cast("double").alias("y_min"),
        F.max(y).cast("double").alias("y_max"),
        F.lit(1).alias("_k"))
    if approx:
        med = panel.select(F.lit(1).alias("_k"), F.col(y)).groupBy("_k").agg(
            F.percentile_approx(F.col(y).cast("double"), 0.5, 10000).alias("median"))
    else:
        med = exact_median(panel.select(F.lit(1).alias("_k"), F.col(y)), ["_k"], y)
    return agg.join(med, "_k", "left").drop("_k").withColumnRenamed("median", "y_median")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column as (column_name, position, null_count), one pass."""
    cols = df.columns
    one = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', {i}, n{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, position, null_count)") \
        .withColumn("position", F.col("position").cast("int"))


def kpis(df: DataFrame, y: str = S.Y) -> DataFrame:
    return df.agg(F.avg(y).alias("y_mean"), F.max(y).cast("double").alias("y_max"),
                  F.min(y).cast("double").alias("y_min"), F.stddev_samp(y).alias("y_std"),
                  F.count(F.lit(1)).alias("n_rows"))


def profile_by(df: DataFrame, key, name: str, y: str = S.Y) -> DataFrame:
    return df.groupBy(key.alias(name) if not isinstance(key, str) else key) \
        .agg(F.avg(y).alias("y_mean"), F.count(F.lit(1)).alias("n_rows"))


def monthly_profile(panel: DataFrame) -> DataFrame:
    return profile_by(panel, F.month(S.DT), "month")


def weekday_profile(panel: DataFrame) -> DataFrame:
    return profile_by(panel, F.weekday(S.DT), "day_of_week")


def year_month_trend(panel: DataFrame) -> DataFrame:
    g = panel.groupBy(F.year(S.DT).alias("year"), F.month(S.DT).alias("month")) \
        .agg(F.avg(S.Y).alias("y_mean"))
    return g.withColumn("month_start", F.make_date("year", "month", F.lit(1)))


def trend_grouping_sets(panel: DataFrame) -> DataFrame:
    """Monthly mean overall and per series in one aggregation (GROUPING SETS)."""
    base = panel.select(S.SERIES, F.year(S.DT).alias("year"), F.month(S.DT).alias("month"), S.Y)
    g = base.groupingSets([["year", "month"], [S.SERIES, "year", "month"]], S.SERIES, "year", "month")
    return g.agg(F.avg(S.Y).alias("y_mean"), F.grouping(S.SERIES).cast("int").alias("is_overall")) \
        .withColumn("month_start", F.make_date("year", "month", F.lit(1)))


def series_profile(panel: DataFrame) -> DataFrame:
    """Mean / std / min / max of y per series, rounded half-even to whole numbers."""
    return panel.groupBy(S.SERIES, S.SERIES_NAME).agg(
        F.bround(F.avg(S.Y), 0).alias("mean_y"), F.bround(F.stddev_samp(S.Y), 0).alias("std_y"),
        F.min(S.Y).alias("min_y"), F.max(S.Y).alias("max_y"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation for every ordered column pair, long form
    (col_a, pos_a, col_b, pos_b, corr), each over the rows that have both values.

    Two passes over the narrow numeric projection (materialised once): the column means,
    then one row of centred sums per task and their total: for masks M (value present)
    and values X (0 where absent) the k x k products X'X, X'M, (X*X)'M and M'M.  Centring
    keeps the sums free of cancellation.  A pair with a constant side, or fewer than two
    rows, gets null.  Only k x k sums reach the driver, bounded by the number of columns.
    """
    import numpy as np

    from tessera.tables import reliable
    k = len(cols)
    x = reliable(df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]))
    first = x.agg(*[F.avg(F.when(~F.isnan(f"x{i}"), F.col(f"x{i}"))).alias(f"m{i}") for i in range(k)]).first()
    means = np.array([m if m is not None else 0.0 for m in first])

    def sums(batches):
        import pandas as pd
        total = np.zeros((4, k, k))
        for pdf in batches:
            v = pdf.to_numpy(dtype=float) - means
            m = np.isfinite(v).astype(float)
            v = np.where(m > 0, v, 0.0)
            total += np.stack([v.T @ v, v.T @ m, (v * v).T @ m, m.T @ m])
        yield pd.DataFrame({"part": range(4 * k), "row": list(total.reshape(4 * k, k))})

    parts = x.mapInPandas(sums, "part int, row array<double>") \
        .select("part", F.posexplode("row").alias("j", "v")).groupBy("part", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((4 * k, k))
    for part, j, v in parts.collect():
        total[part, j] = v
    xy, xm, xxm, n = total.reshape(4, k, k)
    rows = []
    for i in range(k):
        for j in range(k):
            r = None
            if n[i, j] >= 2:
                va = xxm[i, j] - xm[i, j] ** 2 / n[i, j]
                vb = xxm[j, i] - xm[j, i] ** 2 / n[i, j]
                if va > 1e-12 * xxm[i, j] and vb > 1e-12 * xxm[j, i]:
                    r = float((xy[i, j] - xm[i, j] * xm[j, i] / n[i, j]) / np.sqrt(va * vb))
            rows.append((cols[i], i, cols[j], j, 1.0 if i == j and r is not None else r))
    return df.sparkSession.createDataFrame(
        rows, "col_a string, pos_a int, col_b string, pos_b int, corr double")


def lower_triangle(corr: DataFrame) -> DataFrame:
    """Strict lower triangle (row index > column index)."""
    return corr.where(F.col("pos_a") > F.col("pos_b"))


def recent_rows_global(panel: DataFrame, k: int = 30) -> DataFrame:
    """Last ``k`` rows of the whole panel by date (ties by series): a top-k."""
    return panel.orderBy(F.col(S.DT).desc(), F.col(S.SERIES)).limit(k)


def recent_rows_series(panel: DataFrame, series: str, k: int = 30) -> DataFrame:
    return panel.where(F.col(S.SERIES) == series).orderBy(F.col(S.DT).desc()).limit(k)


def series_parameters(panel: DataFrame) -> DataFrame:
    """Per-series generator parameters estimated from the data.

    base_level     mean of y in the first calendar year
    growth_rate    compound yearly growth between first- and last-year means
    seasonal_factor amplitude of the monthly means around the overall mean
                    (sqrt(2) * population std of month-mean / overall-mean)
    All from two small aggregations (per series-year and per series-month).
    """
    yearly = panel.groupBy(S.SERIES, F.year(S.DT).alias("year")).agg(F.avg(S.Y).alias("ym"))
    first_last = yearly.groupBy(S.SERIES).agg(
        F.min("year").alias("y0"), F.max("year").alias("y1"),
        F.min_by("ym", "year").alias("base_level"), F.max_by("ym", "year").alias("last_level"))
    growth = F.when(F.col("y1") > F.col("y0"),
                    F.pow(F.col("last_level") / F.col("base_level"),
                          F.lit(1.0) / (F.col("y1") - F.col("y0"))) - 1).otherwise(F.lit(0.0))
    monthly = panel.groupBy(S.SERIES, F.month(S.DT).alias("month")).agg(F.avg(S.Y).alias("mm"))
    overall = panel.groupBy(S.SERIES, S.SERIES_NAME).agg(F.avg(S.Y).alias("overall"))
    season = monthly.join(overall, S.SERIES).groupBy(S.SERIES, S.SERIES_NAME).agg(
        (F.stddev_pop(F.col("mm") / F.col("overall")) * F.sqrt(F.lit(2.0))).alias("seasonal_factor"))
    return first_last.join(season, S.SERIES).select(
        S.SERIES, S.SERIES_NAME, F.col("y0").alias("start_year"), "base_level",
        growth.alias("growth_rate"), "seasonal_factor")


def expected_volume(panel: DataFrame, params: DataFrame) -> DataFrame:
    """Noise-free expected y per row from the series parameters (growth, season,
    weekend and holiday effects), the observed/expected ratio and the residual
    noise level per series."""
    from tessera.functions import calendar as cal
    j = panel.join(params.drop(S.SERIES_NAME), S.SERIES)
    exp = cal.expected_volume(F.col("base_level"), F.col("growth_rate"), F.col("seasonal_factor"),
                              F.year(S.DT) - F.col("start_year"))
    return j.select(S.SERIES, S.DT, S.Y, exp.alias("expected_y"),
                    F.try_divide(F.col(S.Y), exp).alias("ratio"))


def quality_checks(obs: DataFrame, value_col: str = "amount", lo: float = 0.0,
                   hi: float | None = None) -> DataFrame:
    """One-pass data-quality counts per series over raw observations
    (series_id, dt, value): rows, missing values, values below / above the
    allowed range, rows sharing a (series, day) key with an earlier row, and
    calendar days without any row between the first and last day."""
    v = F.col(value_col)
    per_key = obs.groupBy(S.SERIES, S.DT).agg(
        F.count(F.lit(1)).alias("k"),
        F.sum(v.isNull().cast("long")).alias("nulls"),
        F.sum((v < lo).cast("long")).alias("low"),
        F.sum((v > hi).cast("long") if hi is not None else F.lit(0).cast("long")).alias("high"))
    return per_key.groupBy(S.SERIES).agg(
        F.sum("k").cast("long").alias("n_rows"), F.sum("nulls").cast("long").alias("null_values"),
        F.sum("low").cast("long").alias("below_range"), F.sum("high").cast("long").alias("above_range"),
        F.sum(F.col("k") - 1).cast("long").alias("duplicate_rows"),
        (F.datediff(F.max(S.DT), F.min(S.DT)) + 1 - F.count(F.lit(1))).cast("long").alias("missing_days"))
