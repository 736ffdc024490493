import datetime as dt
import math

from tessera.operators import evaluate as ev


def _long(spark, rows):
    data = [(m, s, dt.date(2024, 1, d), float(y), None if p is None else float(p)) for m, s, d, y, p in rows]
    return spark.createDataFrame(data, "model string, series_id string, dt date, y double, yhat double")


def test_metrics_by_hand(spark):
    rows = [("m", "a", 1, 100, 110), ("m", "a", 2, 200, 190), ("m", "a", 3, 300, 330)]
    r = ev.metrics(_long(spark, rows)).first()
    assert math.isclose(r.MSE, (100 + 100 + 900) / 3)
    assert math.isclose(r.RMSE ** 2, r.MSE)
    assert math.isclose(r.MAE, 50 / 3)
    assert math.isclose(r.MAPE, (0.1 + 0.05 + 0.1) / 3 * 100)
    assert math.isclose(r.MAPE_Median, 10.0)
    sst = sum((y - 200) ** 2 for y in (100, 200, 300))
    assert math.isclose(r.R2, 1 - 1100 / sst)
    assert math.isclose(r.Theil_U, math.sqrt(1100) / math.sqrt(100 ** 2 + 200 ** 2 + 300 ** 2))
    assert r.Directional_Accuracy == 1.0


def test_perfect_prediction(spark):
    rows = [("p", "a", d, y, y) for d, y in [(1, 5), (2, 7), (3, 6)]]
    r = ev.metrics(_long(spark, rows)).first()
    assert r.R2 == 1.0 and r.Theil_U == 0.0 and r.MSE == 0.0


def test_directional_accuracy_crosses_series_boundary(spark):
    # concatenated truth: 1 2 | 10 5 ; prediction: 1 3 | 2 1
    rows = [("m", "a", 1, 1, 1), ("m", "a", 2, 2, 3), ("m", "b", 1, 10, 2), ("m", "b", 2, 5, 1)]
    long = _long(spark, rows)
    da = ev.directional_accuracy(long).first().Directional_Accuracy
    # diffs truth: +1, +8, -5 ; pred: +2, -1, -1 -> agree, disagree, agree
    assert math.isclose(da, 2 / 3)
    per = {r.series_id: r.Directional_Accuracy for r in ev.directional_accuracy_by_series(long).collect()}
    assert per == {"a": 1.0, "b": 1.0}


def test_single_row_da_is_zero(spark):
    r = ev.metrics(_long(spark, [("m", "a", 1, 5, 4)])).first()
    assert r.Directional_Accuracy == 0.0


def test_ranking_ties_and_best(spark):
    rows = []
    for m in ("zeta", "alpha", "lstm_x"):
        off = 50 if m == "lstm_x" else 10
        rows += [(m, "a", d, 100, 100 + off) for d in (1, 2)]
    met = ev.metrics(_long(spark, rows))
    ranks = {r.model: r.rank for r in ev.ranking(met).collect()}
    assert ranks == {"alpha": 1, "zeta": 2, "lstm_x": 3}
    b = ev.best_models(met).first()
    assert (b.best_model, b.best_family_model, b.best_other_model) == ("alpha", "lstm_x", "alpha")


def test_valid_pairs_and_histogram(spark):
    rows = [("m", "a", d, d, (None if d == 3 else d + (d % 2))) for d in range(1, 11)]
    long = ev.valid_pairs(_long(spark, rows))
    assert long.count() == 9
    h = ev.error_histogram(long, 30).collect()
    assert len(h) == 30 and sum(r["count"] for r in h) == 9
    width = h[0].bin_end - h[0].bin_start
    assert math.isclose(sum(r.density * width for r in h), 1.0)


def test_weighted_sum_fallback(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0)], "a_prediction double, b_prediction double, c_prediction double")
    cols = ["a_prediction", "b_prediction", "c_prediction"]
    eq = df.select(ev.weighted_sum(cols).alias("e")).first().e
    assert math.isclose(eq, 7 / 3)
    w = df.select(ev.weighted_sum(cols, {"a_prediction": 1.0}).alias("e")).first().e
    assert math.isclose(w, 1.0 + 2 / 3 + 4 / 3)


def test_report_lines_and_parse(spark, tmp_path):
    from tessera.sources import io
    rows = [(m, "a", d, 100 + d, 100 + d + off) for m, off in (("lin", 3), ("rf", 1)) for d in (1, 2, 3)]
    lines = ev.report_lines(ev.metrics(_long(spark, rows)))
    text = [r.line for r in lines.orderBy("line_no").collect()]
    assert "MODEL PERFORMANCE COMPARISON" in text and "1. rf: RMSE = 1.00" in text
    path = str(tmp_path / "report")
    io.write_text_lines(lines, path)
    cells = io.read_report_comparison(spark, path)
    header = [r.cell for r in cells.orderBy("pos", "col_no").collect()][:9]
    assert header == ["Model", "MSE", "RMSE", "MAE", "MAPE", "MAPE_Median", "R2",
                      "Directional_Accuracy", "Theil_U"]
    assert cells.select("pos").distinct().count() == 3  # header + 2 models
    table = {(r.row_no, r.column): r.value for r in io.report_comparison_table(cells).collect()}
    assert table[(1, "Model")] == "rf" and table[(2, "Model")] == "lin"
    assert float(table[(1, "RMSE")]) == 1.0


def test_exact_median_multi_round_with_ties(spark):
    import random
    import statistics

    from tessera.operators.quantiles import exact_median
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 20))) for _ in range(20000)]
    rows += [("one", 3.5), ("two", 1.0), ("two", 2.0)]
    rows += [("u", rnd.random()) for _ in range(999)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.median for r in exact_median(df, ["g"], "x", grid=20, accuracy=500,
                                                max_bracket=50).collect()}
    exp = {}
    for g in {r[0] for r in rows}:
        exp[g] = statistics.median([x for k, x in rows if k == g])
    assert got == exp
    direct = {r.g: r.median for r in exact_median(df, ["g"], "x").collect()}
    assert direct == exp
