"""Console sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def preview(df: DataFrame, n: int = 20, truncate: bool | int = True) -> None:
    """Console table of the first ``n`` rows (the reference's only output)."""
    df.show(n=n, truncate=truncate)


def preview_written(spark: SparkSession, path: str, n: int = 20, truncate: bool | int = True) -> None:
    """Console table of the first ``n`` rows of a result written as Parquet under ``path``.

    A sorted result's files are its ranges, in the order of their names (a scan of
    the folder would start with the largest); as many of the first ones are read
    as hold ``n`` rows."""
    written = spark.read.parquet(path)
    files = sorted(written.inputFiles(), key=lambda f: f.rsplit("/", 1)[-1])
    rows: list = []
    for file in files:
        rows += spark.read.schema(written.schema).parquet(file).limit(n - len(rows)).collect()
        if len(rows) >= n:
            break
    preview(spark.createDataFrame(rows, written.schema).coalesce(1), n=n, truncate=truncate)
