"""Parquet landing: write the catalogue once, query it columnar afterwards.

``land_catalog`` / ``load_parquet``: plain Parquet folders, one per table.
Splittable and column-pruned: a question that uses two columns of
``principals`` reads two columns.

There is no layout bucketed on the join keys: a bucket is read by one task, so a
title with a third of all credits would be one task's work, and adaptive
execution splits a skewed join only where both sides are shuffled. The plain
layout's joins are, and it splits them (``tests/test_skew.py``).

Writes are plain distributed writes; nothing passes through the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..catalog import Catalog

def write_table(df: DataFrame, path: str, *, files: int | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` as balanced Parquet files.

    ``files`` given: a round-robin repartition into that many files. Otherwise
    the ``rebalance`` hint: AQE sizes the output partitions and splits skewed
    ones, so no key -- however hot -- makes one oversized file, and small
    inputs are not written as thousands of tiny files. Either way scans of the
    landed table get one task per file/row group, not one per source file."""
    df = df.repartition(files) if files is not None else df.hint("rebalance")
    df.write.mode(mode).parquet(path)


def _each_table(catalog: Catalog, write, parallel: bool) -> None:
    """Run one write per table; with ``parallel`` the seven independent jobs are
    submitted together, so a table whose scan has few splits does not leave the
    rest of the cluster idle while it runs."""
    if not parallel:
        for name, df in catalog.items():
            write(name, df)
        return
    with ThreadPoolExecutor(max_workers=len(catalog.names())) as pool:
        for f in [pool.submit(write, name, df) for name, df in catalog.items()]:
            f.result()


def land_catalog(
    catalog: Catalog,
    base_path: str,
    *,
    files: int | None = None,
    mode: str = "overwrite",
    parallel: bool = True,
) -> str:
    base = base_path.rstrip("/")
    _each_table(catalog, lambda name, df: write_table(df, f"{base}/{name}", files=files, mode=mode), parallel)
    return base


def load_parquet(spark: SparkSession, base_path: str) -> Catalog:
    base = base_path.rstrip("/")
    return Catalog(**{n: spark.read.parquet(f"{base}/{n}") for n in Catalog.names()})
