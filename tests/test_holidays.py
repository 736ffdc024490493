import calendar
import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import calendar as cal
from tessera.operators import holidays as hol

DAYS = [dt.date(2019, 12, 1) + dt.timedelta(days=i) for i in range(900)]
ROWS = [
    hol.yearly("year end", 12, 29, -0.1, 5, days=6), hol.yearly("leap", 2, 29, -0.4, 1), hol.nth_weekday("first monday", 5, 0, 1, -0.2, 2),
    hol.nth_weekday("last friday", 8, 4, -1, -0.3, 2, region="n"), hol.nth_weekday("fifth sunday", 3, 6, 5, 0.1, 2, days=2),
    hol.span("festival", dt.date(2020, 4, 20), dt.date(2020, 7, 2), -0.05, 3, region="s"),
    hol.span("one day", dt.date(2020, 5, 4), dt.date(2020, 5, 4), -0.9, 2, region="s"), hol.span("for all", dt.date(2020, 5, 5), dt.date(2020, 5, 5), -0.8, 2),
    hol.span("of the region", dt.date(2020, 5, 5), dt.date(2020, 5, 5), -0.7, 2, region="n"),
    hol.span("backwards", dt.date(2020, 6, 2), dt.date(2020, 6, 1), -0.9, 0), ("unknown", None, "lunar", 1, 1, None, None, None, None, 1, -0.9, 0),
    ("no day", None, "yearly", 6, None, None, None, None, None, 1, -0.9, 0), ("open", None, "span", None, None, None, None, dt.date(2020, 6, 3), None, None, -0.9, 0),
]


def by_hand(day, region):
    hits = []
    for name, where, kind, month, d, weekday, nth, start, end, days, effect, priority in ROWS:
        if where not in (None, region):
            continue
        found = []
        for year in range(2018, 2024):
            if kind == "yearly" and d and (month != 2 or d < 29 or calendar.isleap(year)):
                found.append(dt.date(year, month, d))
            if kind == "weekday":
                own = [x for x in (dt.date(year, month, k) for k in range(1, calendar.monthrange(year, month)[1] + 1)) if x.weekday() == weekday]
                found += own[nth - 1: nth] if nth > 0 else own[nth: nth + 1 or None]
        spans = [(x, x + dt.timedelta(days=days - 1)) for x in found] + ([(start, end)] if kind == "span" and end else [])
        if any(a <= day <= b for a, b in spans):
            hits.append((priority, where is None, name, effect))
    return min(hits)[2:] if hits else (None, 0.0)


def test_rules_spans_regions_and_priorities(spark):
    rows = [(d, r, i, "old") for i, d in enumerate(DAYS) for r in ("n", "s", None)] + [(None, "n", -1, "old"), (DAYS[0], "n", 0, "old")]
    panel = spark.createDataFrame(rows, "dt date, region string, y int, holiday string").repartition(3)
    got = hol.with_holidays(panel, hol.table(spark, ROWS), "region").collect()
    assert len(got) == len(rows)
    seen = set()
    for r in got:
        want = by_hand(r.dt, r.region) if r.dt else (None, 0.0)
        assert (r.holiday, r.holiday_effect, r.is_holiday) == (*want, int(want[0] is not None)), (r.dt, r.region)
        seen.add(r.holiday)
    assert seen == {None, "year end", "leap", "first monday", "last friday", "fifth sunday", "festival", "one day", "for all", "of the region"}


def test_default_table_is_the_constant_rule(spark):
    days = spark.createDataFrame([(d,) for d in DAYS], "dt date")
    got = hol.with_holidays(days, hol.table(spark)).select("dt", "holiday_effect", "is_holiday")
    want = days.select("dt", cal.holiday_effect().alias("holiday_effect"), cal.is_holiday().alias("is_holiday"))
    assert sorted(got.collect()) == sorted(want.collect()) and got.where("is_holiday = 1").count() > 10


def test_empty_tables_and_plan(spark):
    none = spark.createDataFrame([], "dt date, region string")
    assert hol.with_holidays(none, hol.table(spark), "region").count() == 0
    days = spark.createDataFrame([(d,) for d in DAYS[:5]], "dt date")
    assert hol.with_holidays(days, hol.table(spark, [])).where(F.col("is_holiday") == 0).count() == 5
    plan = hol.with_holidays(days, hol.table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
