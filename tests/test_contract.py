import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tessera.operators import contract as ct
from tests.conftest import panel_from_rows

RULES = [
    ct.rule("amount known", "amount", "present"), ct.rule("amount sane", "amount", "range", 0.0, 100.0), ct.rule("day", "day", "range", high=86400.0 * 10),
    ct.rule("code", "code", "pattern", pattern="[A-Z]{2}|x"), ct.rule("code known", "code", "present"),
    ct.rule("state", "state", "allowed", allowed=["1", "2"]), ct.rule("order", "day", "not_after", other="due"), ct.rule("key", "key", "unique"),
]
D = [dt.date(1970, 1, 1) + dt.timedelta(days=i) for i in range(30)]
ROWS = [
    (1, 5.0, D[1], D[2], "AB", 1, set()), (2, None, D[1], D[1], "x", 2, {"amount known"}), (3, float("nan"), None, D[1], None, None, {"amount known", "code known", "amount sane"}),
    (4, -0.5, D[11], D[10], "ABC", 3, {"amount sane", "day", "order", "code", "state"}), (5, 100.0, D[10], None, " ", 1, {"code", "code known"}),
    (6, 101.0, D[0], D[0], "xx", 1, {"amount sane", "code", "key"}), (6, 1.0, D[0], D[0], "AB\n", 1, {"code", "key"}), (None, 1.0, D[0], D[0], "AB", 1, set()),
    (None, 1.0, D[0], D[0], "AB", 1, set()),
]


def marked(spark, rules=RULES, rows=ROWS):
    table = spark.createDataFrame([r[:6] for r in rows], "key int, amount double, day date, due date, code string, state int").repartition(3)
    return ct.checked(table, ct.rule_table(spark, rules))


def test_bits_name_the_broken_rules_and_no_row_is_lost(spark):
    got, names = marked(spark)
    assert names == sorted(r[0] for r in RULES)
    bad = ct.quarantined(got, names).collect()
    good = ct.accepted(got).collect()
    assert len(bad) + len(good) == len(ROWS) and "broken" not in good[0].asDict()
    want = sorted((str(r[0]), str(r[1]), sorted(r[6])) for r in ROWS if r[6])
    assert sorted((str(r.key), str(r.amount), sorted(r.broken_rules)) for r in bad) == want
    assert all(r.broken == sum(1 << names.index(n) for n in r.broken_rules) for r in bad)


def test_one_pass_without_unique_rules(spark):
    got, _ = marked(spark, [r for r in RULES if r[2] != "unique"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and "Window" not in plan


def test_bad_rule_tables(spark):
    for rules in ([ct.rule("a", "no such", "present")], [ct.rule("a", "key", "guess")], [ct.rule("a", "key", "present")] * 2,
                  [ct.rule(str(i), "key", "present") for i in range(63)], [ct.rule("a", "day", "not_after")]):
        with pytest.raises(ValueError):
            marked(spark, rules)
    got, names = marked(spark, [])
    assert names == [] and ct.accepted(got).count() == len(ROWS) and ct.quarantined(got, names).count() == 0
    assert marked(spark, rows=[])[0].count() == 0


def test_hampel_by_hand(spark):
    rng = random.Random(4)
    y = {"a": [1000 + rng.randrange(60) for _ in range(60)], "b": [2000] * 30, "c": [1500]}
    y["a"][20], y["a"][59], y["b"][11] = 5000, 90, 2001
    d0 = dt.date(2024, 1, 1)
    panel = panel_from_rows(spark, [(s, (d0 + dt.timedelta(days=i)).isoformat(), v) for s, vs in y.items() for i, v in enumerate(vs)])
    got = {(r.series_id, (r.dt - d0).days): r for r in ct.hampel(panel).collect()}
    for s, vs in y.items():
        for i, v in enumerate(vs):
            near = vs[max(0, i - 7): i + 8]
            m = statistics.median_low(near)
            mad = statistics.median_low(abs(x - m) for x in near) * ct.SCALE
            r = got[s, i]
            assert (r.median, r.deviation, r.is_outlier) == (m, pytest.approx(mad), abs(v - m) > 3 * mad)
    assert got["a", 20].is_outlier and got["a", 59].is_outlier and got["b", 11].is_outlier and not got["c", 0].is_outlier
    gone = panel.withColumn("y", F.when(F.col("dt") != "2024-01-05", F.col("y")))
    assert not ct.hampel(gone).where("dt = '2024-01-05' and is_outlier").count()
