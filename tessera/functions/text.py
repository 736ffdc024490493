"""String helpers: model labels and report formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def model_label(col: str | Column) -> Column:
    """'random_forest_prediction' -> 'Random_Forest'.

    Python's str.title() capitalises after '_' too; initcap does so only after
    spaces, so underscores are swapped to spaces around initcap.
    """
    c = F.col(col) if isinstance(col, str) else col
    base = F.regexp_replace(c, "_prediction", "")
    return F.regexp_replace(F.initcap(F.regexp_replace(base, "_", " ")), " ", "_")


def prediction_columns(df) -> list[str]:
    """Columns whose name contains 'prediction' (schema only, no job)."""
    return [f.name for f in df.schema.fields if "prediction" in f.name]
