import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.operators import features as feat, panel as pnl, refresh
from tessera.tables import delete_path

D0 = dt.date(2020, 1, 1)
RAW = "series_id string, dt date, amount decimal(18,2)"


def post(spark, folder, name, rows):
    spark.createDataFrame([(s, D0 + dt.timedelta(days=d), Decimal(a)) for s, d, a in rows], RAW).coalesce(1).write.parquet(f"{folder}/{name}")


def rows_of(seed, a, b):
    rng = random.Random(seed)
    return [(s, d, rng.randrange(500, 9000)) for s in ("x", "y") for d in range(a, b) if rng.random() < 0.8]


def same(raw):
    return raw.select(S.SERIES, S.DT, "amount", "_file")


def whole(spark, src):
    raw = spark.read.option("recursiveFileLookup", "true").parquet(src)
    return feat.processed_panel(pnl.build_panel(raw.select(S.SERIES, S.DT, "amount")))


def assert_current(spark, src, root):
    want, got = whole(spark, src), refresh.current(spark, root)
    assert got.columns == want.columns
    a = {(r.series_id, r.dt): r for r in got.collect()}
    b = {(r.series_id, r.dt): r for r in want.collect()}
    assert a.keys() == b.keys()
    for k, row in b.items():
        assert all(a[k][c] == (pytest.approx(row[c], rel=1e-9) if isinstance(row[c], float) else row[c]) for c in got.columns), k
    return len(b)


def test_refresh_equals_rebuild_and_touches_little(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "store")
    assert refresh.current(spark, root).count() == 0
    post(spark, src, "a", rows_of(1, 0, 700))
    first = refresh.refresh(spark, src, root, same)
    assert (first.version, first.files_read, len(first.months_written)) == (1, 1, 23)
    n = assert_current(spark, src, root)

    assert refresh.refresh(spark, src, root, same) == refresh.Report(1)  # nothing new: nothing done

    post(spark, src, "b", rows_of(2, 700, 1200))
    grown = refresh.refresh(spark, src, root, same)
    assert (grown.files_read, grown.months_written[0]) == (1, "2021-11-01")
    assert assert_current(spark, src, root) > n

    post(spark, src, "c", [("y", 1100, 77)])  # a late row: its day and what looks back on it
    late = refresh.refresh(spark, src, root, same)
    assert (late.files_read, late.changed_days) == (1, 1)
    assert late.months_written == ["2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01"]
    assert late.totals_read < 1000
    assert_current(spark, src, root)


def test_new_series_earlier_start_and_files_that_go(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "store")
    post(spark, src, "a", rows_of(3, 100, 600))
    refresh.refresh(spark, src, root, same)
    post(spark, src, "b", [("new", 580, 5000)])
    refresh.refresh(spark, src, root, same)
    assert "new" in {r.series_id for r in refresh.current(spark, root).select(S.SERIES).distinct().collect()}
    post(spark, src, "c", [("x", 40, 5000)])  # the panel begins earlier, all months are written again
    early = refresh.refresh(spark, src, root, same)
    assert early.months_written[0] == "2020-02-01"
    assert_current(spark, src, root)
    post(spark, src, "d", rows_of(4, 600, 640))
    refresh.refresh(spark, src, root, same)
    delete_path(spark, f"{src}/d")
    back = refresh.refresh(spark, src, root, same)
    assert (back.files_read, back.files_gone) == (0, 1)
    got = refresh.current(spark, root)
    assert got.agg(F.max(S.DT)).first()[0] == D0 + dt.timedelta(days=599)
    assert_current(spark, src, root)


def test_a_crash_before_the_manifest_is_harmless(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "store")
    post(spark, src, "a", rows_of(5, 0, 500))
    refresh.refresh(spark, src, root, same)
    before = sorted(refresh.current(spark, root).collect())
    post(spark, src, "b", rows_of(6, 450, 560))
    refresh.refresh(spark, src, root, same, publish=False)
    assert sorted(refresh.current(spark, root).collect()) == before  # readers see the old version
    again = refresh.refresh(spark, src, root, same)
    assert (again.version, again.files_read) == (2, 1)
    assert_current(spark, src, root)
