"""Forecasting: future frame, feature recomputation, scoring, recursive
roll-forward, sequence regression and ensembles.

The future frame is built per series from its last row and a generated
array of dates (``explode(sequence)``), never from a calendar x series
product.  The recursive roll-forward keeps a per-series state array and
folds over the horizon with the ``aggregate`` higher-order function, so the
whole recursion runs inside one JVM expression per series row.
"""

from __future__ import annotations

from dataclasses import dataclass
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.functions import calendar as cal
from tessera.operators import clean, features as feat, panel as pnl
from tessera.tables import dropped, reliable


def last_date(history: DataFrame):
    """Last date of the history (a single scalar)."""
    return history.agg(F.max(S.DT)).first()[0]


def future_frame(history: DataFrame, horizon: int = S.FORECAST_DAYS, last_dt=None) -> DataFrame:
    """Per series: its last row copied to each of the ``horizon`` days after the
    global last date, with the target set to null."""
    last_dt = last_dt or last_date(history)
    latest = pnl.latest_rows(history)
    days = pnl.date_spine(F.date_add(F.lit(last_dt).cast("date"), 1), periods=horizon)
    fut = latest.withColumn(S.DT, F.explode(days)).withColumn(S.Y, F.lit(None).cast(history.schema[S.Y].dataType))
    return fut.select(*history.columns)


def history_plus_future(history: DataFrame, future: DataFrame) -> DataFrame:
    return history.unionByName(future, allowMissingColumns=True)


def future_features(panel: DataFrame, horizon: int = S.FORECAST_DAYS, parity_flags: bool = False,
                    last_dt=None) -> DataFrame:
    """Features for the future rows: append the future frame to the history,
    recompute calendar / lags / rolling windows (missing y skipped), apply the
    fill rules over history + future, keep the future rows.

    With ``parity_flags`` the weekend / holiday flags are copied from the last
    history row (as the original did) instead of being recomputed.
    """
    # read by the last date, the last rows, the union and the fill: computed once
    base = reliable(panel.select(S.SERIES, S.SERIES_NAME, S.DT, S.Y))
    last_dt = last_dt or last_date(base)
    combined = history_plus_future(base, future_frame(base, horizon, last_dt))
    f = feat.add_features(combined)
    if parity_flags:
        lw = Window.partitionBy(S.SERIES).orderBy(S.DT).rowsBetween(Window.unboundedPreceding, 0)
        for c in ("is_weekend", "is_holiday"):
            keep = F.last(F.when(F.col(S.Y).isNotNull(), F.col(c)), ignorenulls=True).over(lw)
            f = f.withColumn(c, F.when(F.col(S.Y).isNull(), keep).otherwise(F.col(c)))
    filled = clean.fill_rules(f, S.FEATURE_NAMES)
    return filled.where(F.col(S.DT) > F.lit(last_dt).cast("date"))


def score(models: dict, frame: DataFrame, keys=(S.DT, S.SERIES, S.SERIES_NAME)) -> DataFrame:
    """Apply each fitted pipeline; one ``<name>_prediction`` column per model."""
    out = frame
    for name, model in models.items():
        out = model.transform(out).withColumnRenamed("prediction", f"{name}_prediction")
        out = out.drop(*[c for c in ("features", "raw_features") if c in out.columns])
    return out.select(*keys, *[f"{n}_prediction" for n in models])


def predict_future(models: dict, panel: DataFrame, horizon: int = S.FORECAST_DAYS,
                   parity_flags: bool = False) -> DataFrame:
    return score(models, future_features(panel, horizon, parity_flags)).orderBy(S.SERIES, S.DT)


# --- recursive roll-forward ---------------------------------------------------
def _window_stats(s: Column, n: int) -> dict[str, Column]:
    """mean / sample std / min / max of the last ``n`` values of array ``s``."""
    size = F.size(s)
    part = F.slice(s, F.greatest(size - F.lit(n) + 1, F.lit(1)), F.lit(n))
    m = F.size(part).cast("double")
    total = F.aggregate(part, F.lit(0.0), lambda a, x: a + x)
    mean = F.when(m > 0, total / m)
    sq = F.aggregate(part, F.lit(0.0), lambda a, x: a + (x - total / m) * (x - total / m))  # no cancellation
    var = F.when(m > 1, sq / (m - 1))
    return {"mean": mean, "std": F.sqrt(F.greatest(var, F.lit(0.0))),
            "min": F.array_min(part), "max": F.array_max(part)}


def step_features(s: Column, d: Column) -> dict[str, Column]:
    """The 29 features of the day ``d`` from the history array ``s`` (oldest
    first, target of ``d`` unknown): lags from the tail, rolling windows over
    the previous values (the unknown current value is skipped)."""
    c = cal.calendar_columns(d)
    out = dict(c)
    out["is_weekend"] = cal.is_weekend(d)
    out["is_holiday"] = cal.is_holiday(d)
    out.update(cal.cyclic_columns(c))
    for k in S.LAGS + [S.YEAR_LAG]:
        out[f"y_lag_{k}"] = F.try_element_at(s, F.lit(-k))
    for n in S.ROLLING_WINDOWS:
        st = _window_stats(s, n - 1)
        out[f"y_rolling_mean_{n}"] = st["mean"]
        out[f"y_rolling_std_{n}"] = st["std"]
    mm = _window_stats(s, S.MINMAX_WINDOW - 1)
    out[f"y_rolling_min_{S.MINMAX_WINDOW}"] = mm["min"]
    out[f"y_rolling_max_{S.MINMAX_WINDOW}"] = mm["max"]
    return out


def linear_terms(model) -> tuple[float, dict[str, float]]:
    """Intercept and raw-scale coefficients of a fitted linear pipeline
    (assembler [+ scaler] + LinearRegression)."""
    stages = model.stages
    cols = stages[0].getInputCols()
    lr = stages[-1]
    coef = list(lr.coefficients.toArray())
    intercept = float(lr.intercept)
    if len(stages) == 3:  # standard scaler in between
        sc = stages[1]
        mean = sc.mean.toArray() if sc.getWithMean() else [0.0] * len(cols)
        std = sc.std.toArray() if sc.getWithStd() else [1.0] * len(cols)
        raw = []
        for b, mu, sd in zip(coef, mean, std):
            w = b / sd if sd else 0.0
            raw.append(w)
            intercept -= w * mu
        coef = raw
    return intercept, dict(zip(cols, [float(v) for v in coef]))


def roll_forward(panel: DataFrame, intercept: float, coefs: dict[str, float],
                 horizon: int = S.FORECAST_DAYS, history: int = S.YEAR_LAG) -> DataFrame:
    """Recursive multi-step forecast with a linear model.

    Per series the last ``history`` values form the state; each step computes
    the features of the next day from the state, predicts, and appends the
    prediction to the state (dropping the oldest value) so later lags and
    rolling windows see earlier predictions.  Missing features count as 0.
    """
    w = Window.partitionBy(S.SERIES).orderBy(F.col(S.DT).desc())
    top = panel.select(S.SERIES, S.DT, F.col(S.Y).cast("double").alias(S.Y)) \
        .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= history)
    st = top.groupBy(S.SERIES).agg(F.sort_array(F.collect_list(F.struct(S.DT, S.Y))).alias("_h"),
                                   F.max(S.DT).alias("last_dt"))
    st = st.select(S.SERIES, "last_dt", F.transform("_h", lambda r: r[S.Y]).alias("state"))

    def predict(s: Column, d: Column) -> Column:
        fs = step_features(s, d)
        total = F.lit(float(intercept))
        for name, b in coefs.items():
            if b != 0.0 and not math.isnan(b):
                total = total + F.coalesce(fs[name].cast("double"), F.lit(0.0)) * F.lit(float(b))
        return total

    init = F.struct(F.col("state").alias("s"),
                    F.array().cast("array<double>").alias("out"))

    def merge(acc, i):
        d = F.date_add(F.col("last_dt"), i)
        yhat = predict(acc["s"], d)
        nxt = F.concat(F.slice(acc["s"], F.lit(2), F.greatest(F.size(acc["s"]), F.lit(1))),
                       F.array(yhat))
        keep = F.when(F.size(acc["s"]) >= F.lit(history), nxt).otherwise(F.concat(acc["s"], F.array(yhat)))
        return F.struct(keep.alias("s"), F.concat(acc["out"], F.array(yhat)).alias("out"))

    res = st.select(S.SERIES, "last_dt",
                    F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, merge)["out"].alias("preds"))
    return res.select(S.SERIES, F.posexplode("preds").alias("step", "yhat"), "last_dt") \
        .select(S.SERIES, F.date_add("last_dt", F.col("step") + 1).alias(S.DT),
                (F.col("step") + 1).alias("step"), "yhat")


# --- sequence regression ------------------------------------------------------
def sequence_dataset(df: DataFrame, feature_cols: list[str], length: int = S.SEQUENCE_LENGTH,
                     validation_split: float = 0.2) -> tuple[DataFrame, dict]:
    """Min-max scaled features and target, ``length``-row input windows per
    series, flattened to a vector, plus a tail-validation flag (last share of
    the (series, dt) order)."""
    from pyspark.ml.functions import array_to_vector

    cols = list(feature_cols)
    ranges = clean.minmax_fit(df, cols + [S.Y])
    scaled = clean.minmax_scale(df, ranges, suffix="_s")
    # the place of the cut is found on the narrow keys; the wide windows are neither sorted nor joined
    place = F.row_number().over(Window.partitionBy(S.SERIES).orderBy(S.DT))
    keys = df.select(S.SERIES, S.DT, place.alias("_place")).where(F.col("_place") > length).select(S.SERIES, S.DT)
    keys = reliable(pnl.with_global_index(keys))
    cut = int(math.floor((1 - validation_split) * keys.count()))
    at = keys.where(F.col("global_idx") == cut).first()
    late = F.lit(False) if at is None else (
        (F.col(S.SERIES) > at[S.SERIES]) | ((F.col(S.SERIES) == at[S.SERIES]) & (F.col(S.DT) >= F.lit(at[S.DT]))))
    win = feat.sequence_windows(scaled, [f"{c}_s" for c in cols], length, target=f"{S.Y}_s")
    out = win.select(S.SERIES, S.DT, F.col("target").alias("label"),
                     array_to_vector(F.flatten("window")).alias("features"), late.alias("is_validation"))
    return out, ranges


@dataclass
class SequenceModel:
    """A fitted sequence model with all that forecasting needs: the scaling ranges of every column,
    the feature columns in order, the window length and the losses per iteration."""
    model: object
    ranges: dict[str, tuple[float, float]]
    columns: list[str]
    length: int
    losses: list[tuple[int, float, float]]

    def save(self, spark, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        rows = [("column", i, c, *map(float, self.ranges[c]), self.length) for i, c in enumerate(self.columns)]
        rows.append(("target", 0, S.Y, *map(float, self.ranges[S.Y]), self.length))
        rows += [("loss", i, "", a, b, self.length) for i, a, b in self.losses]
        spark.createDataFrame(rows, "kind string, place int, name string, lo double, hi double, length int") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark, path: str) -> "SequenceModel":
        from pyspark.ml.regression import GBTRegressionModel
        rows = sorted(spark.read.parquet(f"{path}/settings").collect())
        columns = [r for r in rows if r.kind == "column"]
        ranges = {r.name: (r.lo, r.hi) for r in rows if r.kind in ("column", "target")}
        return cls(GBTRegressionModel.load(f"{path}/model"), ranges, [r.name for r in columns], rows[0].length,
                   [(r.place, r.lo, r.hi) for r in rows if r.kind == "loss"])

    def predictions(self, df: DataFrame) -> DataFrame:
        """Fitted values of every window of ``df`` in the original scale."""
        from pyspark.ml.functions import array_to_vector
        scaled = clean.minmax_scale(df, self.ranges, suffix="_s")
        win = feat.sequence_windows(scaled, [f"{c}_s" for c in self.columns], self.length, target=f"{S.Y}_s")
        lo, hi = self.ranges[S.Y]
        x = win.select(S.SERIES, S.DT, F.col("target"), array_to_vector(F.flatten("window")).alias("features"))
        return self.model.transform(x).select(S.SERIES, S.DT, (F.col("target") * (hi - lo) + lo).alias(S.Y),
                                              (F.col("prediction") * (hi - lo) + lo).alias("yhat"))


def fitted_sequence(df: DataFrame, feature_cols: list[str], length: int = S.SEQUENCE_LENGTH, **params) -> SequenceModel:
    model, _, hist = sequence_regression(df, feature_cols, length, **params)
    return SequenceModel(model, model.tessera_ranges, list(feature_cols), length, [tuple(r) for r in hist.collect()])


def sequence_regression(df: DataFrame, feature_cols: list[str], length: int = S.SEQUENCE_LENGTH,
                        max_iter: int = 50, validation_split: float = 0.2, tol: float = 0.0,
                        seed: int = 42):
    """Predict y from the ``length`` preceding feature rows with boosted trees,
    stopping early on the validation tail; returns (model, predictions in the
    original scale, per-iteration train / validation loss)."""
    from pyspark.ml.regression import GBTRegressor

    data, ranges = sequence_dataset(df, feature_cols, length, validation_split)
    data = reliable(data)
    gbt = GBTRegressor(labelCol="label", featuresCol="features", maxIter=max_iter, maxDepth=4,
                       stepSize=0.1, seed=seed, validationIndicatorCol="is_validation",
                       validationTol=tol)
    model = gbt.fit(data)
    lo, hi = ranges[S.Y]
    pred = model.transform(data).select(
        S.SERIES, S.DT, (F.col("label") * (hi - lo) + lo).alias(S.Y),
        (F.col("prediction") * (hi - lo) + lo).alias("yhat"), "is_validation")
    train_loss = model.evaluateEachIteration(data.where(~F.col("is_validation")), "squared")
    val_loss = model.evaluateEachIteration(data.where(F.col("is_validation")), "squared")
    spark = df.sparkSession
    hist = spark.createDataFrame([(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(train_loss, val_loss))],
                                 "iter int, train_loss double, val_loss double")
    model.tessera_ranges = ranges  # scaling used in training, needed to forecast
    return model, pred, hist


def day_features(prev: Column, cur: Column, d: Column) -> dict[str, Column]:
    """Feature row of day ``d`` whose value is ``cur``, given the values before
    it (``prev``, oldest first): lags from ``prev``, rolling windows over the
    last n values including ``cur`` - the same definitions as the history."""
    c = cal.calendar_columns(d)
    out = dict(c)
    out["is_weekend"] = cal.is_weekend(d)
    out["is_holiday"] = cal.is_holiday(d)
    out.update(cal.cyclic_columns(c))
    for k in S.LAGS + [S.YEAR_LAG]:
        out[f"y_lag_{k}"] = F.try_element_at(prev, F.lit(-k))
    with_cur = F.concat(prev, F.array(cur))
    for n in S.ROLLING_WINDOWS:
        st = _window_stats(with_cur, n)
        out[f"y_rolling_mean_{n}"] = st["mean"]
        out[f"y_rolling_std_{n}"] = st["std"]
    mm = _window_stats(with_cur, S.MINMAX_WINDOW)
    out[f"y_rolling_min_{S.MINMAX_WINDOW}"] = mm["min"]
    out[f"y_rolling_max_{S.MINMAX_WINDOW}"] = mm["max"]
    out[S.Y] = cur
    return out


def sequence_forecast(model, panel: DataFrame, feature_cols: list[str], horizon: int = S.FORECAST_DAYS,
                      length: int = S.SEQUENCE_LENGTH, history: int = S.YEAR_LAG,
                      materialise_every: int = 1) -> DataFrame:
    """Multi-step forecast with the sequence model.

    Per series the state holds the last ``history`` values and the last
    ``length`` scaled feature rows.  Each step assembles the window into the
    model's input vector, predicts (inverse-scaled), computes the new day's
    feature row from the values so far plus the prediction, scales it and
    rolls the window.  The per-series state (one row per series) is
    materialised in the shared folder after every step: the step expressions
    use the previous state many times, and without the cut the plan grows
    with every step.
    """
    from pyspark.ml.functions import array_to_vector

    if isinstance(model, SequenceModel):
        model, ranges, feature_cols, length = model.model, model.ranges, model.columns, model.length
    else:
        ranges = model.tessera_ranges
    lo_y, hi_y = ranges[S.Y]

    def scaled(name: str, col: Column) -> Column:
        lo, hi = ranges[name]
        return F.coalesce(F.try_divide(col.cast("double") - F.lit(lo), F.lit(hi) - F.lit(lo)), F.lit(0.0))

    feats = feat.add_features(panel.select(S.SERIES, S.SERIES_NAME, S.DT, S.Y))
    row = F.array(*[scaled(c, F.col(c)) for c in feature_cols])
    w = Window.partitionBy(S.SERIES).orderBy(F.col(S.DT).desc())
    top = feats.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= history) \
        .select(S.SERIES, S.DT, F.col(S.Y).cast("double").alias("_y"), row.alias("_row"), "_rn")
    st = top.groupBy(S.SERIES).agg(
        F.sort_array(F.collect_list(F.struct(S.DT, "_y"))).alias("_h"),
        F.sort_array(F.collect_list(F.when(F.col("_rn") <= length, F.struct(S.DT, "_row")))).alias("_wnd"),
        F.max(S.DT).alias("last_dt"))
    state = st.where(F.size("_wnd") == length).select(
        S.SERIES, "last_dt", F.transform("_h", lambda r: r["_y"]).alias("hist"),
        F.transform("_wnd", lambda r: r["_row"]).alias("window"),
        F.array().cast("array<double>").alias("out"))
    held = None  # the written state that the next one is computed from
    for step in range(1, horizon + 1):
        d = F.date_add(F.col("last_dt"), step)
        x = state.withColumn("features", array_to_vector(F.flatten("window")))
        pred = model.transform(x).select(
            S.SERIES, "last_dt", "hist", "window", "out",
            (F.col("prediction") * (hi_y - lo_y) + lo_y).alias("_yhat"))
        # stage 1: the new day's feature values as named columns
        f = day_features(F.col("hist"), F.col("_yhat"), d)
        staged = pred.select(S.SERIES, "last_dt", "hist", "window", "out", "_yhat",
                             *[f[c].alias(f"_f_{i}") for i, c in enumerate(feature_cols)])
        # stage 2: scale, roll the window and the history
        new_row = F.array(*[scaled(c, F.col(f"_f_{i}")) for i, c in enumerate(feature_cols)])
        hist = F.concat(F.col("hist"), F.array("_yhat"))
        state = staged.select(
            S.SERIES, "last_dt",
            F.when(F.size(hist) > history, F.slice(hist, 2, history)).otherwise(hist).alias("hist"),
            F.concat(F.slice("window", 2, length - 1), F.array(new_row)).alias("window"),
            F.concat("out", F.array("_yhat")).alias("out"))
        if step % materialise_every == 0 and step < horizon:
            state, old = reliable(state), held
            if old is not None:
                dropped(old)
            held = state
    return state.select(S.SERIES, "last_dt", F.posexplode("out").alias("step", "yhat")).select(
        S.SERIES, F.date_add("last_dt", F.col("step") + 1).alias(S.DT),
        (F.col("step") + 1).alias("step"), "yhat")
