"""Holidays as a table: rules, fixed days and spans of days, for all regions or one, by priority.

A row of the table is (name, region, kind, month, day, weekday, nth, start, end, days, effect, priority):

* ``yearly``: ``month`` and ``day`` of every year, ``days`` days long (29 February only in leap years);
* ``weekday``: the ``nth`` ``weekday`` (Monday is 0) of ``month`` in every year, from the end where ``nth`` is negative;
* ``span``: from ``start`` to ``end``, both included.

A null region holds everywhere, null ``days`` are one day.  Where several rows cover a day, the one with the least
priority counts, then one of the region itself before one for all, then the first name.

Days meet holidays by an equi-join: rules become spans of the years in question, spans are filed under each month that they
touch, and a day looks only into its own month.  So neither side is ever paired as a whole, and a month holds as many rows
as there are holidays in it.  Rows that name no day (null fields, an unknown kind, an end before the start) cover
nothing; days with a null date have no holiday.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schema as S

TABLE = ("name string, region string, kind string, month int, day int, weekday int, nth int, start date, end date, days int, "
         "effect double, priority int")
ALL = "*"  # files rows that hold everywhere; no region of the panel may have this name


def yearly(name: str, month: int, day: int, effect: float, priority: int = 0, days: int = 1, region: str | None = None) -> tuple:
    return name, region, "yearly", month, day, None, None, None, None, days, effect, priority


def nth_weekday(name: str, month: int, weekday: int, nth: int, effect: float, priority: int = 0, days: int = 1,
                region: str | None = None) -> tuple:
    return name, region, "weekday", month, None, weekday, nth, None, None, days, effect, priority


def span(name: str, start: dt.date, end: dt.date, effect: float, priority: int = 0, region: str | None = None) -> tuple:
    return name, region, "span", None, None, None, None, start, end, None, effect, priority


def default_rows() -> list[tuple]:
    """The fixed holidays, which come first, and the fourth Thursday of November."""
    rows = [yearly(f"{m:02d}-{d:02d}", m, d, S.FIXED_HOLIDAY_EFFECT) for m, d in S.FIXED_HOLIDAYS]
    return [*rows, nth_weekday("thanksgiving", 11, 3, 4, S.THANKSGIVING_EFFECT, priority=1)]


def table(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """A holiday table from rows; users read theirs from a file with the same columns."""
    return spark.createDataFrame(default_rows() if rows is None else rows, TABLE)


def _date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def spans(holidays: DataFrame, first_year: Column, last_year: Column) -> DataFrame:
    """name, region, start, end, effect, priority of every occurrence from the year before ``first_year``."""
    ruled = holidays.where("kind in ('yearly', 'weekday')") \
        .withColumn("year", F.explode(F.sequence(first_year.cast("int") - 1, last_year.cast("int"))))
    first = _date(F.col("year"), F.col("month"), F.lit(1))
    ahead = F.date_add(first, F.pmod(F.col("weekday") - F.weekday(first), F.lit(7)))
    last = F.last_day(first)
    back = F.date_sub(last, F.pmod(F.weekday(last) - F.col("weekday"), F.lit(7)))
    on = F.when(F.col("nth") > 0, F.date_add(ahead, (F.col("nth") - 1) * 7)).when(F.col("nth") < 0, F.date_add(back, (F.col("nth") + 1) * 7))
    on = F.when(F.trunc(on, "month") == first, on)  # some months have no fifth
    begin = F.when(F.col("kind") == "yearly", _date(F.col("year"), F.col("month"), F.col("day"))).otherwise(on)
    rules = ruled.withColumn("start", begin).withColumn("end", F.date_add("start", F.coalesce("days", F.lit(1)) - 1))
    keep = ["name", "region", "start", "end", "effect", "priority"]
    return rules.select(keep).unionByName(holidays.where("kind = 'span'").select(keep)).where("start <= end")


def of_days(days: DataFrame, holidays: DataFrame, region: str | None = None) -> DataFrame:
    """The holidays among the distinct ``days`` (dt, and ``region`` if named): dt[, region], holiday, holiday_effect."""
    place = F.coalesce(F.col(region), F.lit(ALL)) if region else F.lit(ALL)
    own = days.where(F.col(S.DT).isNotNull()).select(S.DT, place.alias("_place")).distinct()
    years = own.agg(F.min(F.year(S.DT)).alias("lo"), F.max(F.year(S.DT)).alias("hi"))
    found = spans(holidays, years.select("lo").scalar(), years.select("hi").scalar())
    filed = found.withColumn("_month", F.explode(F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month")))) \
        .withColumn("_at", F.coalesce("region", F.lit(ALL)))
    asked = own.withColumn("_month", F.trunc(S.DT, "month")).withColumn("_at", F.explode(F.array_distinct(F.array(F.lit(ALL), F.col("_place")))))
    best = F.min(F.struct("priority", (F.col("_at") == ALL).alias("general"), "name", "effect"))
    hit = asked.join(filed, ["_month", "_at"]).where(F.col(S.DT).between(F.col("start"), F.col("end"))) \
        .groupBy(S.DT, "_place").agg(best.alias("best"))
    out = [F.col(S.DT), *([F.when(F.col("_place") != ALL, F.col("_place")).alias(region)] if region else [])]
    return hit.select(*out, F.col("best.name").alias("holiday"), F.col("best.effect").alias("holiday_effect"))


def with_holidays(panel: DataFrame, holidays: DataFrame, region: str | None = None) -> DataFrame:
    """``panel`` with holiday (null on other days), holiday_effect (0) and is_holiday (0 or 1, whatever the effect)."""
    rest = panel.drop("holiday", "holiday_effect", "is_holiday")
    found = of_days(panel, holidays, region).withColumnsRenamed({S.DT: "_day", "holiday": "_name", "holiday_effect": "_effect"})
    on = F.col(S.DT) == F.col("_day")
    if region:
        found = found.withColumnRenamed(region, "_in")
        on = on & F.col(region).eqNullSafe(F.col("_in"))
    return rest.join(found, on, "left").select(
        *rest.columns, F.col("_name").alias("holiday"), F.coalesce("_effect", F.lit(0.0)).alias("holiday_effect"),
        F.col("_name").isNotNull().cast("int").alias("is_holiday"))
