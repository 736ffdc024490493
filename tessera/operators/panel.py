"""Panel construction: daily aggregation, gap filling, spines, positions, filters.

A panel is a table keyed (series_id, dt) with one row per series and day.
The builder aggregates observations per (series, day) first (map-side partial
aggregation, so a hot series is reduced before the shuffle), then fills gaps
with a per-series ``lead`` window and ``sequence`` generator instead of a
spine x series product: two exchanges in total, and the following feature
windows reuse the series partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.functions import calendar as cal


def series_name_expr(series: str | Column = S.SERIES, drop: str | None = None) -> Column:
    """Display name of a series key: lower case, without what the pattern ``drop`` matches."""
    c = F.col(series) if isinstance(series, str) else series
    return F.lower(F.regexp_replace(c, drop, "") if drop else c)


def daily_totals(obs: DataFrame, value_col: str = "amount") -> DataFrame:
    """Sum of the value per (series, day); rows with a null key are dropped."""
    return (obs.where(F.col(S.SERIES).isNotNull() & F.col(S.DT).isNotNull())
            .groupBy(S.SERIES, S.DT).agg(F.sum(value_col).alias("y_raw")))


def fill_gaps(daily: DataFrame, start, end) -> DataFrame:
    """Dense (series, dt) rows from ``start`` to ``end`` for every observed series.

    Each observed row emits itself plus the missing days up to the next
    observation of its series (the first row also emits the days since
    ``start``, the last one the days until ``end``); missing days get a null
    ``y_raw``.
    """
    w = Window.partitionBy(S.SERIES).orderBy(S.DT)
    start_c = start if isinstance(start, Column) else F.lit(start).cast("date")
    end_c = end if isinstance(end, Column) else F.lit(end).cast("date")
    lo = F.when(F.lag(S.DT).over(w).isNull(), start_c).otherwise(F.col(S.DT))
    nxt = F.lead(S.DT).over(w)
    hi = F.when(nxt.isNull(), end_c).otherwise(F.date_sub(nxt, 1))
    spans = daily.select(S.SERIES, F.col(S.DT).alias("obs_dt"), "y_raw",
                         lo.alias("lo"), hi.alias("hi"))
    days = spans.select(S.SERIES, "obs_dt", "y_raw",
                        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(S.DT))
    return days.select(S.SERIES, S.DT,
                       F.when(F.col(S.DT) == F.col("obs_dt"), F.col("y_raw")).alias("y_raw"))


def build_panel(obs: DataFrame, start=None, end=None, value_col: str = "amount",
                floor_value: int = S.Y_FLOOR, with_raw_calendar: bool = False,
                materialise_daily: bool = False, drop_from_name: str | None = None) -> DataFrame:
    """Observations (series_id, dt, amount) -> dense daily panel (series_id, series_name, dt, y).

    Days without observations count as 0 and every value is clamped below at
    ``floor_value`` and truncated to a whole number.  ``start``/``end`` default
    to the observed global range; when given, observations outside are
    filtered before the shuffle (the filter reaches the parquet scan).
    ``materialise_daily`` writes the daily totals once (for joined sources,
    whose bounds subquery would otherwise repeat the join).  ``drop_from_name`` is a
    pattern that display names leave out.
    """
    if start is not None:
        obs = obs.where(F.col(S.DT) >= F.lit(start).cast("date"))
    if end is not None:
        obs = obs.where(F.col(S.DT) <= F.lit(end).cast("date"))
    daily = daily_totals(obs, value_col)
    if materialise_daily:
        # expensive sources (joins): compute the daily totals once; the bounds
        # and the gap filling then both read the written table
        from tessera.tables import reliable
        daily = reliable(daily)
    # missing bounds come from scalar subqueries of the same query (no separate
    # action, no driver round trip); Catalyst merges the min and max into one
    # subquery and answers it from a two-column scan of the observations
    if start is None:
        start = daily.select(F.min(S.DT)).scalar()
    if end is None:
        end = daily.select(F.max(S.DT)).scalar()
    dense = fill_gaps(daily, start, end)
    panel = dense.select(
        S.SERIES, series_name_expr(S.SERIES, drop_from_name).alias(S.SERIES_NAME), S.DT,
        cal.clamp_floor(F.coalesce(F.col("y_raw"), F.lit(0)), floor_value).alias(S.Y))
    if with_raw_calendar:
        panel = raw_calendar(panel)
    return panel


def raw_calendar(panel: DataFrame) -> DataFrame:
    """The raw-panel calendar columns: year, month, day_of_year, day_of_week, flags."""
    c = cal.calendar_columns(S.DT)
    return panel.withColumns({
        "year": c["year"], "month": c["month"], "day_of_year": c["day_of_year"],
        "day_of_week": c["day_of_week"], "is_weekend": cal.is_weekend(S.DT),
        "is_holiday": cal.is_holiday(S.DT)})


def date_spine(start, end=None, periods: int | None = None) -> Column:
    """Array of days from ``start`` to ``end`` (or ``periods`` days), for ``explode``."""
    s = F.lit(start).cast("date") if not isinstance(start, Column) else start
    if end is None:
        e = F.date_add(s, int(periods) - 1)
    else:
        e = F.lit(end).cast("date") if not isinstance(end, Column) else end
    return F.sequence(s, e, F.expr("INTERVAL 1 DAY"))


def with_lookback(panel: DataFrame, start, end, days: int = S.YEAR_LAG):
    """Rows needed to compute windows for [start, end]: pre-filter with a halo.

    Returns (padded_panel, keep_filter). Window features computed on the padded
    panel and then filtered by ``keep_filter`` equal those of the full panel
    for frames up to ``days`` rows on a dense panel.
    """
    s = F.lit(start).cast("date")
    e = F.lit(end).cast("date")
    padded = panel.where((F.col(S.DT) >= F.date_sub(s, days)) & (F.col(S.DT) <= e))
    return padded, (F.col(S.DT) >= s) & (F.col(S.DT) <= e)


def with_global_index(panel: DataFrame, order_cols=(S.SERIES, S.DT)) -> DataFrame:
    """0-based row position in the (series_id, dt) order without a global sort.

    Position = rank inside the series + number of rows of all earlier series.
    One window pass gives both the rank and the series size; that result is
    materialised once in the shared folder (the input is computed once, and
    callers that read the positions repeatedly - folds - read the table).
    The one-row-per-series sizes get a distributed exclusive running sum
    (``positions.exclusive_prefix_sum``), so a very large number of series
    never meets in one task; it is joined back on series_id.
    """
    from tessera.tables import reliable
    from tessera.operators.positions import exclusive_prefix_sum
    series_col = order_cols[0]
    w = Window.partitionBy(series_col).orderBy(*order_cols[1:])
    ranked = reliable(panel.withColumns({
        "_pos_in_series": F.row_number().over(w) - 1,
        "_n": F.count(F.lit(1)).over(Window.partitionBy(series_col))}))
    counts = ranked.where(F.col("_pos_in_series") == 0).select(series_col, "_n")
    offsets = exclusive_prefix_sum(counts, [series_col], "_n", "_offset").select(series_col, "_offset")
    return (ranked.join(offsets, series_col)
            .withColumn("global_idx", F.col("_offset") + F.col("_pos_in_series"))
            .drop("_offset", "_pos_in_series", "_n"))


def filter_series(panel: DataFrame, series: str) -> DataFrame:
    return panel.where(F.col(S.SERIES) == F.lit(series))


def filter_series_range(panel: DataFrame, series: str, start=None, end=None) -> DataFrame:
    """Series filter plus an inclusive date range; a half-given range is ignored."""
    out = filter_series(panel, series)
    if start is not None and end is not None:
        out = out.where(F.col(S.DT).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return out


def latest_rows(panel: DataFrame) -> DataFrame:
    """Last row of each series (max_by over a struct, one aggregate per series)."""
    cols = [c for c in panel.columns if c != S.SERIES]
    return (panel.groupBy(S.SERIES)
            .agg(F.max_by(F.struct(*cols), F.col(S.DT)).alias("_last"))
            .select(S.SERIES, "_last.*"))
