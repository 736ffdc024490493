"""Table and text sinks / sources chosen by file suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schema as S

FORMATS = {".csv": "csv", ".parquet": "parquet"}


def _format_of(path: str) -> str:
    for suffix, fmt in FORMATS.items():
        if path.rstrip("/").endswith(suffix):
            return fmt
    raise ValueError(f"Unsupported file format: {path} (use .csv or .parquet)")


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               date_col: str | None = S.DT, cache: bool = False) -> DataFrame:
    """Read a table by suffix; CSV gets a header and, when given, an explicit schema.

    A column named ``date_col`` is coerced to DATE when present.  ``cache``
    keeps the table in executor memory/disk for repeated interactive reads
    (recomputed from the files if an executor is lost).
    """
    fmt = _format_of(path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("inferSchema", schema is None).csv(path)
    else:
        df = reader.parquet(path)
    if date_col and date_col in df.columns:
        df = df.withColumn(date_col, F.to_date(F.col(date_col)))
    if cache:
        from pyspark import StorageLevel
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
               mode: str = "overwrite") -> str:
    """Write a table by suffix (no index column); optional partitioning for pruning."""
    fmt = _format_of(path)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path


def load_or_compute(spark: SparkSession, path: str, compute, partition_by=None) -> DataFrame:
    """Reuse a materialised table, else compute it, write it and read it back."""
    try:
        return spark.read.parquet(path)
    except Exception as exc:  # missing path -> AnalysisException
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
    save_table(compute(), path, partition_by)
    return spark.read.parquet(path)


def write_text_lines(lines: DataFrame, path: str, order_col: str = "line_no",
                     text_col: str = "line") -> str:
    """Write a (line_no, line) frame as one text file, lines in order."""
    (lines.orderBy(order_col).select(text_col).coalesce(1)
     .write.mode("overwrite").text(path))
    return path


def read_report_comparison(spark: SparkSession, path: str,
                           marker: str = "MODEL PERFORMANCE COMPARISON") -> DataFrame:
    """Parse the fixed-width block after ``marker`` (up to the first blank line) of a
    report into a table of string cells: (row_no, col_no, cell).

    Lines are numbered with their byte offset order inside each file, so the
    parse is distributed over files and needs no driver-side scan.
    """
    text = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    lines = text.select("file", F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    starts = lines.where(F.col("line").contains(marker)).groupBy("file").agg(
        F.min("pos").alias("start"))
    blanks = (lines.join(starts, "file").where((F.col("pos") > F.col("start"))
                                                & (F.trim("line") == ""))
              .groupBy("file").agg(F.min("pos").alias("stop")))
    block = (lines.join(starts, "file").join(blanks, "file", "left")
             .where((F.col("pos") > F.col("start"))
                    & (F.col("stop").isNull() | (F.col("pos") < F.col("stop")))
                    & ~F.col("line").contains("---") & (F.trim("line") != "")))
    cells = block.select("file", "pos", F.posexplode(F.split(F.trim("line"), r"\s+"))
                         .alias("col_no", "cell"))
    return cells


def load_forecasts(spark: SparkSession, path: str, prediction_cols: list[str]) -> DataFrame | None:
    """Read a forecast table (CSV with header) with an explicit schema; None when missing."""
    fields = [T.StructField(S.DT, T.DateType()), T.StructField(S.SERIES, T.StringType()),
              T.StructField(S.SERIES_NAME, T.StringType())]
    fields += [T.StructField(c, T.DoubleType()) for c in prediction_cols]
    try:
        return load_table(spark, path, schema=T.StructType(fields))
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def report_comparison_table(cells: DataFrame) -> DataFrame:
    """Cells of the comparison block -> (file, row_no, column, value): the first
    line of the block is the header, the others are rows (1-based)."""
    from pyspark.sql import Window
    first = cells.groupBy("file").agg(F.min("pos").alias("hdr"))
    c = cells.join(first, "file")
    header = c.where(F.col("pos") == F.col("hdr")).select("file", "col_no", F.col("cell").alias("column"))
    body = c.where(F.col("pos") > F.col("hdr"))
    rows = body.select("file", "pos").distinct().withColumn(
        "row_no", F.row_number().over(Window.partitionBy("file").orderBy("pos")))
    return (body.join(header, ["file", "col_no"]).join(rows, ["file", "pos"])
            .select("file", "row_no", "column", F.col("cell").alias("value")))
