"""Cleaning and scaling: fill rules, label encoding, standardisation, min-max."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.tables import reliable


def null_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with at least one null, found in a single aggregation."""
    row = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def fill_rules(df: DataFrame, cols: list[str], only_null_cols: bool = True,
               rolling_fill: str = "mean") -> DataFrame:
    """Fill by column name: 'lag' -> last known value of the same series
    (forward fill), 'rolling' -> column mean, other -> 0; anything left -> 0.

    ``rolling_fill="last30"`` fills rolling columns with the mean of the last
    30 known values of the same series instead of the column mean.
    The forward fill runs per series (it never carries a value across series).
    Column means come from one aggregation of bounded size (one value per column).
    """
    df = reliable(df)  # read by the aggregation and by the fill
    # one aggregation answers both questions: which columns hold nulls, and
    # the mean of every rolling column (the upstream plan runs once for it)
    roll_all = [c for c in cols if "lag" not in c and "rolling" in c]
    aggs = [F.max(F.col(c).isNull().cast("int")).alias(f"n_{c}") for c in cols]
    if rolling_fill == "mean":
        aggs += [F.avg(c).alias(f"m_{c}") for c in roll_all]
    row = df.agg(*aggs).first()
    targets = [c for c in cols if row[f"n_{c}"]] if only_null_cols else list(cols)
    roll = [c for c in targets if c in roll_all]
    means = {c: row[f"m_{c}"] for c in roll} if rolling_fill == "mean" else {}
    w = (Window.partitionBy(S.SERIES).orderBy(S.DT)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    back = (Window.partitionBy(S.SERIES).orderBy(F.col(S.DT).desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = Window.partitionBy(S.SERIES)
    out = {}
    for c in targets:
        if "lag" in c:
            e = F.last(F.col(c), ignorenulls=True).over(w)
        elif "rolling" in c and rolling_fill == "last30":
            known_from_end = F.count(F.col(c)).over(back)
            tail_mean = F.avg(F.when(F.col(c).isNotNull() & (known_from_end <= 30), F.col(c))).over(whole)
            e = F.coalesce(F.col(c), tail_mean)
        elif "rolling" in c:
            e = F.coalesce(F.col(c), F.lit(means[c]))
        else:
            e = F.coalesce(F.col(c), F.lit(0))
        out[c] = F.coalesce(e, F.lit(0)).cast(df.schema[c].dataType)
    return df.withColumns(out) if out else df


def label_encode(df: DataFrame, col: str, out_col: str | None = None, method: str = "distributed"):
    """Sorted distinct values -> 0..k-1.

    ``distributed`` (default): the distinct values get their sorted rank from a
    distributed prefix count and are joined back, so no label list passes
    through the driver; returns (frame, code table).  ``indexer``: Spark ML
    ``StringIndexer`` (alphabetical, errors on unseen values; it collects the
    labels to the driver) for use inside ML pipelines; returns (frame, model).
    """
    out_col = out_col or f"{col}_code"
    if method == "indexer":
        from pyspark.ml.feature import StringIndexer
        model = StringIndexer(inputCol=col, outputCol=out_col, stringOrderType="alphabetAsc",
                              handleInvalid="error").fit(df)
        return model.transform(df).withColumn(out_col, F.col(out_col).cast("int")), model
    from tessera.operators.positions import exclusive_prefix_sum
    df = reliable(df)  # read by the labels and by the join
    labels = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_one", F.lit(1))
    codes = exclusive_prefix_sum(labels, [col], "_one", out_col) \
        .select(col, F.col(out_col).cast("int").alias(out_col))
    return df.join(codes, col, "left"), codes


def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population std; a constant column maps to 0."""
    df = reliable(df)  # read by the statistics and by the scaling
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return df.withColumns({
        f"{c}{suffix}": F.coalesce(
            F.try_divide(F.col(c) - F.lit(stats[f"m_{c}"]), F.lit(stats[f"s_{c}"])), F.lit(0.0))
        for c in cols})


def minmax_fit(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.min(c).cast("double").alias(f"lo_{c}") for c in cols],
                 *[F.max(c).cast("double").alias(f"hi_{c}") for c in cols]).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols}


def minmax_scale(df: DataFrame, ranges: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0 (not 0.5)."""
    return df.withColumns({
        f"{c}{suffix}": F.coalesce(F.try_divide(F.col(c) - F.lit(lo), F.lit(hi) - F.lit(lo)),
                                   F.lit(0.0))
        for c, (lo, hi) in ranges.items()})


def minmax_inverse(df: DataFrame, ranges: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({
        f"{c}{suffix}": F.col(c) * (F.lit(hi) - F.lit(lo)) + F.lit(lo)
        for c, (lo, hi) in ranges.items()})
