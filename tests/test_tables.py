import pytest

from tessera import session, tables
from tessera.operators import evaluate as ev
from tessera.operators import profile as prof
from tessera.operators.quantiles import exact_median
from tessera.sources.tables import fingerprint


class Elsewhere:
    """A session whose master is a cluster and whose checkpoint folder is not set."""
    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Elsewhere)


def test_scratch_tables_are_deleted(spark):
    long = spark.createDataFrame([("m", "s", f"2024-01-{d:02d}", float(d), d + 1.0) for d in range(1, 20)],
                                 "model string, series_id string, dt string, y double, yhat double") \
        .selectExpr("model", "series_id", "cast(dt as date) dt", "y", "yhat")
    first = len(tables._WRITTEN)
    with tables.scratch_tables(spark):
        assert ev.metrics(long).count() == 1
        made = tables._WRITTEN[first:]
        assert made and all(tables.path_exists(spark, p) for p in made)
    assert tables._WRITTEN[first:] == [] and not any(tables.path_exists(spark, p) for p in made)


def _metrics(spark, n):
    row = [(f"model_{i}", 10, *[float(i + k) for k in range(8)]) for i in range(n)]
    from tessera import schema as S
    return spark.createDataFrame(row, ["model", "n", *S.METRIC_COLS])


def test_report_holds_every_model(spark, tmp_path):
    from tessera.sources import io
    lines = ev.report_lines(_metrics(spark, 300), family="model_1")
    numbers = [r.line_no for r in lines.collect()]
    assert len(set(numbers)) == len(numbers)
    path = io.write_text_lines(lines, str(tmp_path / "report"))
    table = io.report_comparison_table(io.read_report_comparison(spark, path))
    assert table.where("column = 'Model'").select("value").distinct().count() == 300
    text = [r.line for r in lines.orderBy("line_no").collect()]
    assert text.index("DETAILED MODEL METRICS") > max(i for i, t in enumerate(text) if t.startswith(" " * 8 + "   "))


def test_correlation_takes_pairs_with_both_values(spark):
    import pandas as pd
    rows = [(1.0, 2.0, None), (2.0, 2.5, 4.0), (3.0, 5.0, None), (4.0, 4.0, 1.0), (5.0, 7.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double").withColumn("k", prof.F.lit(3.0))
    want = pd.DataFrame(rows, columns=list("abc"), dtype=float).corr()
    got = {(r.col_a, r.col_b): r["corr"] for r in prof.corr_matrix(df, list("abck")).collect()}
    for i in "abc":
        for j in "abc":
            assert got[i, j] == pytest.approx(want.loc[i, j])
    assert got["a", "k"] is None and got["k", "k"] is None


def test_names_with_quotes_and_dots(spark):
    wide = spark.createDataFrame([("s", "2024-01-01", 1, 2.0)], "series_id string, dt string, y long, `a.b'c` double")
    assert ev.to_long(wide, {"it's": "a.b'c"}).first().asDict()["yhat"] == 2.0


def test_median_takes_rounds_whatever_the_size(spark):
    df = spark.range(20_001).selectExpr("id % 2 as k", "cast((id * 7919) % 20011 as double) as v")
    got = {r.k: r["median"] for r in exact_median(df, ["k"], "v", max_bracket=50).collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(prof.F.median("v").alias("m")).collect()}
    assert got == want


def test_fingerprint_follows_the_data(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    a = fingerprint(spark, str(tmp_path))
    assert a == fingerprint(spark, str(tmp_path))
    spark.range(4).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert a != fingerprint(spark, str(tmp_path))
