"""Calendar, cyclic and holiday column expressions (all JVM-side built-ins)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import schema as S


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def calendar_columns(dt: str | Column = S.DT) -> dict[str, Column]:
    """year, month, day_of_year, day_of_week (Mon=0), quarter, ISO week."""
    d = _c(dt)
    return {
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day_of_year": F.dayofyear(d).cast("int"),
        "day_of_week": F.weekday(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "week_of_year": F.weekofyear(d).cast("int"),
    }


def is_weekend(dt: str | Column = S.DT) -> Column:
    return (F.weekday(_c(dt)) >= 5).cast("int")


def holiday_effect(dt: str | Column = S.DT) -> Column:
    """Fixed-date holidays first (-0.15), then the fourth Thursday of November (-0.20)."""
    d = _c(dt)
    m, day = F.month(d), F.dayofmonth(d)
    fixed = None
    for hm, hd in S.FIXED_HOLIDAYS:
        cond = (m == hm) & (day == hd)
        fixed = cond if fixed is None else (fixed | cond)
    fourth_thursday = (m == 11) & (F.weekday(d) == 3) & (F.floor((day - 1) / 7) + 1 == 4)
    return (F.when(fixed, F.lit(S.FIXED_HOLIDAY_EFFECT))
            .when(fourth_thursday, F.lit(S.THANKSGIVING_EFFECT))
            .otherwise(F.lit(0.0)))


def is_holiday(dt: str | Column = S.DT) -> Column:
    return (holiday_effect(dt) < 0).cast("int")


def cyclic_columns(source: dict[str, Column] | None = None) -> dict[str, Column]:
    """sin / cos of 2*pi*x/period for month, day_of_year and day_of_week."""
    out = {}
    for name, period in S.CYCLIC_PERIODS:
        x = source[name] if source else F.col(name)
        angle = F.lit(2 * math.pi) * x / F.lit(period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def with_calendar(df, dt: str = S.DT, include_flags: bool = True):
    """Add the 8 calendar ints and 6 cyclic doubles in model order."""
    cal = calendar_columns(dt)
    cols = dict(cal)
    if include_flags:
        cols["is_weekend"] = is_weekend(dt)
        cols["is_holiday"] = is_holiday(dt)
    cols.update(cyclic_columns(cal))
    return df.withColumns(cols)


def expected_volume(base: Column, growth: Column, seasonal: Column, years_from_start: Column,
                    dt: str | Column = S.DT) -> Column:
    """Noise-free level: base*(1+g)^years * (1 + season + weekend + holiday)."""
    d = _c(dt)
    season = F.sin(F.lit(2 * math.pi) * F.dayofyear(d) / F.lit(S.SEASON_DAYS)) * seasonal
    weekend = F.when(F.weekday(d) >= 5, F.lit(S.WEEKEND_UPLIFT)).otherwise(F.lit(0.0))
    level = base * F.pow(F.lit(1.0) + growth, years_from_start)
    return level * (F.lit(1.0) + season + weekend + holiday_effect(d))


def clamp_floor(y: Column, floor_value: int = S.Y_FLOOR) -> Column:
    """max(y, floor) then truncate to a whole number (y >= floor > 0)."""
    return F.floor(F.greatest(y, F.lit(floor_value))).cast("long")
