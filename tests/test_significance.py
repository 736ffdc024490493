import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import significance as sg

# two-sided p-values of Student's t, from printed tables and to ten digits from numerical integration
TABLE = [(12.706204736, 1, 0.05), (4.302652730, 2, 0.05), (2.570581836, 5, 0.05), (2.228138852, 10, 0.05), (2.042272456, 30, 0.05),
         (3.169272673, 10, 0.01), (2.750, 30, 0.01000), (1.0, 1, 0.5), (0.0, 7, 1.0)]


def integrated(t, v):
    """The same by Simpson's rule over the density, for any t and v."""
    from math import exp, lgamma, log, pi, sqrt
    c = exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi)
    x = np.linspace(0, abs(t), 200_001)
    f = c * np.exp(-(v + 1) / 2 * np.log1p(x * x / v))
    h = x[1] - x[0] if t else 0.0
    area = h / 3 * (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum())
    assert log(c) < 1
    return 1 - 2 * area


def test_p_values(spark):
    rows = [(t, v, p) for t, v, p in TABLE] + [(t, v, integrated(t, v)) for t in (0.01, 0.7, 1.9, 3.3, 6.0) for v in (1, 4, 37, 2000, 100_000)]
    df = spark.createDataFrame([(float(t), int(v), float(p)) for t, v, p in rows], "t double, v long, p double")
    for r in df.withColumn("got", sg.t_two_sided(F.col("t"), F.col("v"))).collect():
        assert r.got == pytest.approx(r.p, abs=1e-5 if (r.t, r.v) == (2.75, 30) else 1e-8), (r.t, r.v)
    assert spark.range(1).select(sg.t_two_sided(F.lit(None).cast("double"), F.lit(3))).first()[0] is None


def frame(spark, series):
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(y), float(a), float(b), float(c))
            for s, values in series.items() for i, (y, a, b, c) in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, dt date, y double, a_prediction double, b_prediction double, c_prediction double")


@pytest.fixture(scope="module")
def tests(spark):
    rng = random.Random(3)
    good, same, carry = [], [], 0.0
    for _ in range(120):
        carry = 0.8 * carry + rng.gauss(0, 1)
        y = 100 + carry
        good.append((y, y + rng.gauss(0, 1), y + rng.gauss(0, 4), y + rng.gauss(0, 4)))
        same.append((y, 100, 100, 101))
    wide = frame(spark, {"good": good, "same": same, "one": good[:1]})
    wide = wide.union(wide.where("series_id = 'good'").limit(3).withColumn("y", F.lit(None).cast("double")).withColumn(S.DT, F.lit("2030-01-01").cast("date")))
    return {(r.series_id, r.model_a, r.model_b): r for r in sg.loss_tests(wide, ["a", "b", "c"]).collect()}, good


def test_statistic_by_hand(tests):
    got, good = tests
    assert len(got) == 9
    for i, a in enumerate("abc"):
        for b in "abc"[i + 1:]:
            d = np.array([(r[0] - r[1 + "abc".index(a)]) ** 2 - (r[0] - r[1 + "abc".index(b)]) ** 2 for r in good])
            c, n = d - d.mean(), len(d)
            v = sum((1 if k == 0 else 2) * (1 - k / 8) * (c[k:] * c[:n - k]).sum() / n for k in range(8))
            r = got["good", a, b]
            assert (r.n, r.mean_diff, r.long_run_var) == (120, pytest.approx(d.mean()), pytest.approx(v))
            assert r.statistic == pytest.approx(d.mean() / (v / n) ** 0.5)


def test_verdicts(tests):
    got, _ = tests
    assert got["good", "a", "b"].p_value < 1e-3 and got["good", "a", "b"].bootstrap_p <= 0.01
    assert got["good", "b", "c"].p_value > 0.05 and got["good", "b", "c"].bootstrap_p > 0.05
    assert got["same", "a", "b"].statistic is None and got["same", "a", "b"].holm_p is None
    assert got["one", "a", "c"].statistic is None
    own = sorted((r.p_value, r.holm_p) for (s, *_), r in got.items() if s == "good")
    want = np.minimum(1, np.maximum.accumulate([p * (3 - i) for i, (p, _) in enumerate(own)]))
    assert [h for _, h in own] == pytest.approx(want.tolist())


def test_bootstrap_is_seeded_and_by_blocks(spark, tests):
    got, good = tests
    wide = frame(spark, {"good": good}).repartition(5)
    d = sg.loss_differences(wide, ["a", "b", "c"])
    again = {(r.model_a, r.model_b): r.bootstrap_p for r in sg.block_bootstrap(d).collect()}
    assert all(again[a, b] == got["good", a, b].bootstrap_p for a, b in again)
    other = {(r.model_a, r.model_b): r.bootstrap_p for r in sg.block_bootstrap(d, seed=1).collect()}
    assert all(abs(other[k] - again[k]) < 0.1 for k in again) and other["b", "c"] != again["b", "c"]
    whole = sg.block_bootstrap(d, block=10 ** 6, replicates=9).collect()  # one block, always the whole series
    assert all(r.bootstrap_p == 0.1 for r in whole)
