"""Evaluation over a long prediction table (model, series_id, dt, y, yhat).

All metrics of a model come from one grouped aggregation (partial aggregates
are combined map-side, so a model holding most rows is no hot spot).
Directional accuracy needs consecutive rows: differences inside a series use a
per-series ``lag``; the differences across series boundaries (the original
concatenates all series) come from a table with one row per (model, series),
so no window ever spans a whole model.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators.quantiles import exact_median

INF = float("inf")


def to_long(wide: DataFrame, pred_cols: dict[str, str], y: str = S.Y, keep=()) -> DataFrame:
    """Wide predictions -> long (model, series_id, dt, y, yhat, *keep); any model or column name."""
    def named(c):
        return F.col("`" + c.replace("`", "``") + "`").cast("double")
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), named(c).alias("yhat")) for m, c in pred_cols.items()])
    return wide.select(S.SERIES, S.DT, named(y).alias("y"), *keep, F.explode(pairs).alias("_p")) \
        .select("_p.model", S.SERIES, S.DT, "y", "_p.yhat", *keep)


def valid_pairs(long: DataFrame) -> DataFrame:
    """Drop rows whose truth or prediction is missing (null or NaN)."""
    ok = (F.col("y").isNotNull() & F.col("yhat").isNotNull()
          & ~F.isnan("y") & ~F.isnan("yhat"))
    return long.where(ok)


def _err() -> Column:
    return F.col("y") - F.col("yhat")


def _ape() -> Column:
    return F.abs(F.try_divide(_err(), F.col("y")))


def direction_counts(long: DataFrame, across_series: bool = True, materialise: bool = True) -> DataFrame:
    """Per model: number of consecutive pairs and of pairs whose up/down agree.

    Inside a series the previous row is ``lag`` over (model, series) by dt.
    With ``across_series`` the first row of each series is paired with the
    last row of the previous series (series in id order), as the original
    concatenated array does.
    """
    if across_series and materialise:
        # read twice below (consecutive pairs and series ends): compute it once
        from tessera.tables import reliable
        long = reliable(long)
    w = Window.partitionBy("model", S.SERIES).orderBy(S.DT)
    inside = long.select("model", S.SERIES,
                         ((F.col("y") - F.lag("y").over(w) > 0)
                          == (F.col("yhat") - F.lag("yhat").over(w) > 0)).alias("agree"))
    cnt = inside.groupBy("model").agg(F.count("agree").alias("pairs"),
                                      F.coalesce(F.sum(F.col("agree").cast("long")), F.lit(0))
                                      .alias("agree"))
    if not across_series:
        return cnt
    from tessera.operators.positions import exclusive_prefix_sum
    ends = long.groupBy("model", S.SERIES).agg(
        F.min_by(F.struct("y", "yhat"), S.DT).alias("first"),
        F.max_by(F.struct("y", "yhat"), S.DT).alias("last"),
        F.lit(1).alias("_one"))
    # series rank inside each model (distributed), then pair rank r with r - 1
    ranked = exclusive_prefix_sum(ends, [S.SERIES], "_one", "_r", group_cols=["model"])
    prev = ranked.select("model", "first", "_r").join(
        ranked.select("model", (F.col("_r") + 1).alias("_r"), F.col("last").alias("prev")),
        ["model", "_r"])
    edges = prev.select(
        "model",
        ((F.col("first.y") - F.col("prev.y") > 0) == (F.col("first.yhat") - F.col("prev.yhat") > 0))
        .alias("agree"))
    ecnt = edges.groupBy("model").agg(F.count(F.lit(1)).alias("e_pairs"),
                                      F.sum(F.col("agree").cast("long")).alias("e_agree"))
    return (cnt.join(ecnt, "model", "full")
            .select("model",
                    (F.coalesce("pairs", F.lit(0)) + F.coalesce("e_pairs", F.lit(0))).alias("pairs"),
                    (F.coalesce("agree", F.lit(0)) + F.coalesce("e_agree", F.lit(0))).alias("agree")))


def directional_accuracy(long: DataFrame, across_series: bool = True, materialise: bool = True) -> DataFrame:
    """Share of consecutive pairs with the same direction; 0.0 below two rows."""
    c = direction_counts(long, across_series, materialise)
    return c.select("model", F.when(F.col("pairs") > 0, F.col("agree").cast("double") / F.col("pairs"))
                    .otherwise(F.lit(0.0)).alias("Directional_Accuracy"))


def directional_accuracy_by_series(long: DataFrame) -> DataFrame:
    w = Window.partitionBy("model", S.SERIES).orderBy(S.DT)
    d = long.select("model", S.SERIES,
                    ((F.col("y") - F.lag("y").over(w) > 0)
                     == (F.col("yhat") - F.lag("yhat").over(w) > 0)).cast("double").alias("agree"))
    return d.groupBy("model", S.SERIES).agg(
        F.coalesce(F.avg("agree"), F.lit(0.0)).alias("Directional_Accuracy"),
        F.count("agree").alias("pairs"))


def point_metrics(long: DataFrame, median: str = "exact") -> DataFrame:
    """MSE, RMSE, MAE, MAPE, R2, Theil's U per model in one aggregation; the exact
    median APE comes from the distributed bracketing median."""
    e = _err()
    g = long.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("MSE"),
        F.avg(F.abs(e)).alias("MAE"),
        (F.avg(_ape()) * 100).alias("MAPE"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop("y") * F.count("y")).alias("_sst"),
        F.sum(F.col("y") * F.col("y")).alias("_syy"))
    r2 = (F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst")))
    theil = (F.when(F.col("_syy") == 0, F.lit(INF))
             .otherwise(F.sqrt("_sse") / F.sqrt("_syy")))
    if median == "approx":  # one mergeable sketch per model, no extra passes
        med = long.groupBy("model").agg(F.percentile_approx(_ape(), 0.5, 10000).alias("median"))
    else:
        med = exact_median(long.select("model", _ape().alias("ape")), ["model"], "ape")
    return g.join(med, "model", "left").select(
        "model", "n", "MSE", F.sqrt("MSE").alias("RMSE"), "MAE", "MAPE",
        (F.col("median") * 100).alias("MAPE_Median"), r2.alias("R2"), theil.alias("Theil_U"))


def metrics(long: DataFrame, median: str = "exact") -> DataFrame:
    """The comparison table: model + the 8 metrics (+ n).

    The long table is read by several aggregations (point metrics, median,
    directions), so it is materialised once in the shared checkpoint folder.
    """
    from tessera.tables import reliable
    long = reliable(long)
    pm = point_metrics(long, median)
    da = directional_accuracy(long, materialise=False)
    return pm.join(da, "model", "left").select(
        "model", "n", *[F.col(c) for c in S.METRIC_COLS])


def ranking(metrics_df: DataFrame) -> DataFrame:
    """Rank by RMSE ascending (ties by model name). One row per model."""
    w = Window.orderBy(F.col("RMSE").asc_nulls_last(), F.col("model"))
    return metrics_df.withColumn("rank", F.row_number().over(w))


def best_models(metrics_df: DataFrame, family: str = "lstm") -> DataFrame:
    """Best model overall, inside the family (name contains ``family``) and outside it."""
    in_fam = F.lower("model").contains(family)
    return metrics_df.agg(
        F.min_by("model", F.struct("RMSE", "model")).alias("best_model"),
        F.min_by(F.when(in_fam, F.col("model")),
                 F.when(in_fam, F.struct("RMSE", "model"))).alias("best_family_model"),
        F.min_by(F.when(~in_fam, F.col("model")),
                 F.when(~in_fam, F.struct("RMSE", "model"))).alias("best_other_model"))


def metrics_long(metrics_df: DataFrame, cols=("RMSE", "MAE", "MAPE", "R2")) -> DataFrame:
    parts = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in cols)
    return metrics_df.selectExpr("model", f"stack({len(cols)}, {parts}) AS (metric, value)")


def residuals(long: DataFrame) -> DataFrame:
    return long.withColumn("residual", F.col("y") - F.col("yhat"))


def error_histogram(long: DataFrame, bins: int = 30, materialise: bool = True) -> DataFrame:
    """Density histogram of the errors per model with ``bins`` equal-width bins.

    Bin edges come from the per-model min/max (a one-row-per-model table);
    empty bins are produced from ``sequence(1, bins)``; lo == hi puts every
    value into bin 1 with width 1.
    """
    e = long.select("model", _err().alias("e"))
    if materialise:
        # read twice (extents, then bins): compute the narrow error column once
        from tessera.tables import reliable
        e = reliable(e)
    ext = e.groupBy("model").agg(F.min("e").alias("lo"), F.max("e").alias("hi"),
                                 F.count(F.lit(1)).alias("n"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0))
    b = F.when(F.col("hi") > F.col("lo"),
               F.least(F.floor((F.col("e") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
                       F.lit(bins - 1)) + 1).otherwise(F.lit(1)).cast("int")
    # one row per model, as many as prediction columns were given: bounded
    counts = e.join(F.broadcast(ext), "model").groupBy("model", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = ext.select("model", "lo", "hi", "n", width.alias("width"),
                      F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = grid.join(counts, ["model", "bin"], "left").select(
        "model", "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_end"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))
    return out.join(ext.select("model", "n", width.alias("width")), "model").select(
        "model", "bin", "bin_start", "bin_end", "count",
        (F.col("count") / (F.col("n") * F.col("width"))).alias("density"))


def axis_extents(long: DataFrame) -> DataFrame:
    """Smallest and largest value over truth and every prediction."""
    return long.agg(F.least(F.min("y"), F.min("yhat")).alias("lo"),
                    F.greatest(F.max("y"), F.max("yhat")).alias("hi"))


def recent_per_series(long: DataFrame, k: int = 30) -> DataFrame:
    """Last ``k`` points of every (model, series) - a per-group top-k."""
    w = Window.partitionBy("model", S.SERIES).orderBy(F.col(S.DT).desc())
    return long.withColumn("recent_rank", F.row_number().over(w)).where(F.col("recent_rank") <= k)


def weighted_sum(cols: list[str], weights: dict[str, float] | None = None) -> Column:
    """sum(col * w); equal weights 1/n by default, a missing weight falls back to 1/n.
    Weights are not normalised."""
    n = len(cols)
    weights = weights or {}
    return reduce(lambda a, b: a + b,
                  [F.col(c) * F.lit(float(weights.get(c, 1.0 / n))) for c in cols])


def report_lines(metrics_df: DataFrame, title: str = "PANEL FORECASTING - MODEL EVALUATION REPORT",
                 family: str = "lstm") -> DataFrame:
    """The evaluation report as (line_no, line): header, comparison block (fixed
    width), per-model details, ranking and recommendations.

    Built from the metrics table (one row per model) with string formatting on Spark.
    ``line_no`` orders the lines by (section, rank, item): sections have room for a
    billion models of up to a thousand lines each.
    """
    ranked = ranking(metrics_df)
    spark = metrics_df.sparkSession
    rule, dash = "=" * 60, "-" * 40
    header = " ".join(f"{c:>20}" for c in ["Model"] + S.METRIC_COLS)

    def number(section, rank=0, item=0):
        rank = F.col(rank) if isinstance(rank, str) else F.lit(rank)
        return (F.lit(section).cast("long") * 10 ** 12 + rank.cast("long") * 1000 + item).alias("line_no")

    def plain(section, texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, line string")
        return rows.select((F.lit(section).cast("long") * 10 ** 12 + F.col("i")).alias("line_no"), "line")

    comparison = ranked.select(number(2, "rank"), F.concat_ws(
        " ", F.format_string("%20s", "model"),
        *[F.format_string("%20.6f", F.col(c)) for c in S.METRIC_COLS]).alias("line"))
    items = F.array(F.concat(F.lit("\n"), F.upper("model"), F.lit(":")),
                    *[F.format_string(f"  {c}: %.4f", F.col(c)) for c in S.METRIC_COLS])
    details = ranked.select("rank", F.posexplode(items).alias("i", "line")) \
        .select(number(5, "rank", F.col("i")), "line")
    order = ranked.select(number(7, "rank"),
                          F.format_string("%d. %s: RMSE = %.2f", "rank", "model", "RMSE").alias("line"))
    advice = best_models(metrics_df, family).select(F.posexplode(F.array(
        F.concat(F.lit("• Best performing model: "), "best_model"),
        F.concat(F.lit(f"• Best {family.upper()} model: "), "best_family_model"),
        F.concat(F.lit("• Best traditional ML model: "), "best_other_model"))).alias("i", "line")) \
        .where(F.col("line").isNotNull()).select(number(9, 0, F.col("i")), "line")
    parts = [plain(1, [rule, title, rule, "", "MODEL PERFORMANCE COMPARISON", dash, header]), comparison,
             plain(3, [""]), plain(4, ["DETAILED MODEL METRICS", dash]), details,
             plain(6, ["\nMODEL RANKING (by RMSE)", dash]), order,
             plain(8, ["\nRECOMMENDATIONS", dash]), advice, plain(10, ["\n" + rule])]
    return reduce(lambda a, b: a.unionByName(b), parts)
