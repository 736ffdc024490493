import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tessera.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def panel_from_rows(spark, rows):
    """rows: (series_id, 'YYYY-MM-DD', y) -> panel frame with series_name."""
    import datetime as dt

    from pyspark.sql import functions as F
    data = [(s, dt.date.fromisoformat(d), y) for s, d, y in rows]
    df = spark.createDataFrame(data, "series_id string, dt date, y long")
    return df.withColumn("series_name", F.lower("series_id")).select("series_id", "series_name", "dt", "y")
