"""Batch job: run every question and write each result as Parquet.

This is the reference's run-everything script re-aimed: results are written
(distributed, one folder per question) instead of printed only. Relations that
several questions start from can be computed once, as tables that live as long as
the job: titles ⨝ ratings (Q1, Q2, Q6, Q7, Q20, Q22-Q25), and, if asked for, a narrow
credits table with each credit's rating and titles (Q9-Q11, Q16, Q18). A lost executor
only costs the tasks it ran: every stage reads files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..operators import rated_titles
from ..sources import preview, preview_written
from .registry import QUESTION_KEYS, REGISTRY


def credits_table(catalog: Catalog) -> DataFrame:
    """principals with the rating (``rated`` tells a null rating from none) and
    the titles of each credit: tconst, nconst, category, averageRating, rated,
    titles array<struct<startYear, genres>>.

    The title side is one row per tconst, so it repeats no credit: a question
    over principals ⨝ ratings keeps that join's multiplicity, one over titles
    takes the array apart and keeps that one's."""
    rated = catalog.ratings.select("tconst", "averageRating", F.lit(True).alias("rated"))
    titles = catalog.titles.groupBy("tconst").agg(F.collect_list(F.struct("startYear", "genres")).alias("titles"))
    return (
        catalog.principals.select("tconst", "nconst", "category")
        .join(rated, "tconst", "left")
        .join(titles, "tconst", "left")
    )


@contextmanager
def shared(catalog: Catalog, *, rated: bool = True, credits: bool = False) -> Iterator[Catalog]:
    """The catalogue with its shared relations as managed tables, dropped at the
    end. Results read from it must be written or shown before that.

    Opt-in: at the bench's sizes writing either table costs more than its
    questions gain (``shared_rated`` and ``shared_credits`` in ``bench.py``). It
    pays where the joins' shuffles dominate, as each is then made once."""
    spark = catalog.spark
    made: list[str] = []

    def table(df: DataFrame, name: str) -> DataFrame:
        made.append(f"marquee_{name}_{uuid.uuid4().hex[:12]}")
        df.write.saveAsTable(made[-1])
        return spark.table(made[-1])

    try:
        base = catalog.with_tables(rated=None, credits=None)
        out = base
        if rated:
            out = out.with_tables(rated=table(rated_titles(base), "rated"))
        if credits:
            out = out.with_tables(credits=table(credits_table(base), "credits"))
        yield out
    finally:
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def run_all(
    catalog: Catalog,
    out_dir: str | None,
    *,
    keys: Iterable[str] | None = None,
    reference_params: bool = True,
    share: bool = False,
    share_credits: bool = False,
    mode: str = "overwrite",
    rows: int = 0,
) -> dict[str, str]:
    """Write every question under ``out_dir/<key>``; returns key -> path. With
    ``rows``, print the first rows of each too; without ``out_dir``, only that.

    ``reference_params`` runs each question with its defaults (the reference's
    literals); otherwise with the registry's parameters for the driver's data.
    ``share`` and ``share_credits`` write the relations of ``shared`` first.
    A question that is both written and printed is computed once: what is printed
    is read from what was written."""
    if share or share_credits:
        with shared(catalog, rated=share, credits=share_credits) as cat:
            return run_all(
                cat, out_dir, keys=keys, reference_params=reference_params, mode=mode, rows=rows
            )
    from .. import operators as Q

    out = {}
    for key in keys or QUESTION_KEYS:
        spec = REGISTRY[key]
        df = Q.QUESTIONS[spec.number](catalog) if reference_params else spec.build(catalog)
        if out_dir:
            out[key] = f"{out_dir.rstrip('/')}/{key}"
            df.write.mode(mode).parquet(out[key])
        if rows:
            print(f"Q{spec.number} {key}")
            whole = key == "longest_careers"
            if out_dir:
                preview_written(catalog.spark, out[key], n=rows, truncate=not whole)
            else:
                preview(df, n=rows, truncate=not whole)
    return out
