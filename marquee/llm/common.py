"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go as soon as it ends (else when the driver's
    garbage is collected); what was written doesn't need them."""
    before = spark.conf.get(_CLEANUP, None)
    if before is None:  # a Spark without the setting
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextmanager
def arrow_records(spark: SparkSession, records: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for the writes within, where rows are
    large (the default is ten thousand, whatever their size)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(records))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> str:
    """The path of ``df``, written to the cluster's shared checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove written tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's shared checkpoint folder: lineage is
    cut and a lost executor costs only its running tasks."""
    path = stored(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables that are removed at the end of a ``with`` block. Its result
    must be written by then: what is read lazily from them would be gone."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, list[str]] = {}

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.done(*self.paths)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = stored(df, name)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def done(self, *names: str) -> None:
        """Remove the tables written under these names so far."""
        for name in names:
            discard(self.spark, *self.paths.pop(name, []))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column (column names differ by
    more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` and a column (its name is returned) that tells its rows apart, repeated
    ones too: a 64-bit hash of the row's place in its Parquet file, or, where rows
    have none, a number, with which the rows are written first."""
    name = free_name(df, "row_key")
    try:
        return df.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(name)), name
    except AnalysisException:
        return written(df.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with fixed names and types, whatever else ``docs`` holds;
    a null text stays null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
