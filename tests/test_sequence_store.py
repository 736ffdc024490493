from tessera import schema as S
from tessera.operators import features as feat
from tessera.operators import forecast as fc
from tests.conftest import panel_from_rows


def test_saved_and_loaded_model_forecasts_the_same(spark, tmp_path):
    import datetime as dt
    rows = [(s, (dt.date(2022, 1, 1) + dt.timedelta(days=d)).isoformat(), 100 + 10 * (d % 7) + 50 * k + d % 13)
            for k, s in enumerate(["a", "b"]) for d in range(460)]
    panel = panel_from_rows(spark, rows)
    cols = [S.Y, "y_lag_1", "y_lag_7"]
    own = fc.fitted_sequence(feat.processed_panel(panel), cols, length=5, max_iter=4)
    own.save(spark, str(tmp_path / "m"))
    again = fc.SequenceModel.load(spark, str(tmp_path / "m"))
    assert (again.ranges, again.columns, again.length, again.losses) == (own.ranges, own.columns, own.length, own.losses)

    def forecast(m):
        return sorted(map(tuple, fc.sequence_forecast(m, panel, cols, horizon=3).collect()))
    assert forecast(own) == forecast(again) and len(forecast(again)) == 6
    df = feat.processed_panel(panel)
    assert again.predictions(df).count() == df.count() - 2 * 5


def test_validation_rows_are_the_tail(spark):
    import datetime as dt
    rows = [(s, (dt.date(2022, 1, 1) + dt.timedelta(days=d)).isoformat(), d) for s in "ab" for d in range(25)]
    panel = panel_from_rows(spark, rows)
    data, _ = fc.sequence_dataset(panel, [S.Y], 5, 0.2)
    got = data.orderBy(S.SERIES, S.DT).collect()
    assert len(got) == 40 and [r.is_validation for r in got] == [False] * 32 + [True] * 8
