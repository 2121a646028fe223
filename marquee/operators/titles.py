"""Questions about titles: votes, ratings, runtimes, episodes, aliases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import has_any
from .common import (
    TITLE_COLUMNS,
    finish,
    join_rated_titles,
    rated_titles,
    top_k_per_group,
    with_title,
)

RATED_COLUMNS = (*TITLE_COLUMNS, "averageRating", "numVotes")


def top_titles_by_votes(cat: Catalog, *, since_year: int = 2021, n: int = 10) -> DataFrame:
    """Q1. Rated titles (any type) starting in or after ``since_year``; the ``n``
    with most votes (ties: tconst)."""
    rated = rated_titles(cat).filter(F.col("startYear") >= since_year)
    return finish(rated, [F.desc("numVotes"), F.asc("tconst")], top_n=n, select=RATED_COLUMNS)


def titles_above_rating(
    cat: Catalog, *, after_year: int = 2020, min_rating: float = 8, top_n: int | None = None, sort: bool = False
) -> DataFrame:
    """Q2. Rated titles (any type) with ``startYear > after_year`` and
    ``averageRating > min_rating`` (both strict)."""
    rated = rated_titles(cat).filter((F.col("startYear") > after_year) & (F.col("averageRating") > min_rating))
    return finish(rated, [F.asc("tconst")], top_n=top_n, sort=sort, select=RATED_COLUMNS)


def top_titles_per_year(cat: Catalog, *, k: int = 5, top_n: int | None = None, sort: bool = True) -> DataFrame:
    """Q6. Per start year (null year is its own group) the ``k`` most voted rated
    titles, ranked 1..k (ties: tconst); newest year first."""
    ranked = top_k_per_group(
        rated_titles(cat), ["startYear"], [F.desc("numVotes"), F.asc("tconst")], k
    )
    return finish(
        ranked,
        [F.desc("startYear"), F.asc("rank")],
        top_n=top_n,
        sort=sort,
        select=(*RATED_COLUMNS, "rank"),
    )


def series_by_episode_count(cat: Catalog, *, n: int = 10) -> DataFrame:
    """Q14. Parents with the most episodes that carry an episode number
    (``count(episodeNumber)`` skips nulls); ties: tconst."""
    counts = cat.episodes.groupBy(F.col("parentTconst").alias("tconst")).agg(
        F.count("episodeNumber").alias("totalEpisodes")
    )
    named = with_title(counts, cat.titles)
    return finish(named, [F.desc("totalEpisodes"), F.asc("tconst")], top_n=n, select=("primaryTitle", "totalEpisodes"))


def shortest_titles_per_type(cat: Catalog, *, k: int = 10) -> DataFrame:
    """Q15. The ``k`` shortest titles of every titleType (null runtime skipped;
    ties: tconst). titleType is not in the output."""
    timed = cat.titles.filter(F.col("runtimeMinutes").isNotNull()).select(
        "tconst", "titleType", "primaryTitle", "runtimeMinutes"
    )
    ranked = top_k_per_group(timed, ["titleType"], [F.asc("runtimeMinutes"), F.asc("tconst")], k)
    return ranked.select("primaryTitle", "runtimeMinutes")


def titles_by_alias_count(cat: Catalog, *, n: int = 10) -> DataFrame:
    """Q17. Titles with the most non-null alternative titles; ties: tconst."""
    counts = cat.akas.groupBy(F.col("titleId").alias("tconst")).agg(F.count("title").alias("totalAdaptations"))
    named = with_title(counts, cat.titles)
    return finish(
        named, [F.desc("totalAdaptations"), F.asc("tconst")], top_n=n, select=("primaryTitle", "totalAdaptations")
    )


def titles_per_year(cat: Catalog, *, since_year: int = 2020) -> DataFrame:
    """Q24. Per start year >= ``since_year``: rated titles (any type) and their
    mean runtime (null runtimes skipped)."""
    rated = rated_titles(cat).filter(F.col("startYear") >= since_year)
    out = rated.groupBy("startYear").agg(
        F.count("tconst").alias("movies_produced"),
        F.avg("runtimeMinutes").alias("average_runtime"),
    )
    return out


def genre_rating_by_region(
    cat: Catalog,
    *,
    genre: str = "Drama",
    year_from: int = 2003,
    year_to: int = 2009,
    regions: Sequence[tuple[str, str]] = (("US", "usa"), ("UA", "ua")),
) -> DataFrame:
    """Q25. Mean rating of ``genre`` titles started in [year_from, year_to], per
    start year and alias region, one column per region.

    A title counts once per matching alias row (several US aliases weight it).
    Aliases meet the selected titles first, so only theirs are joined to ratings
    and averaged -- partially before the shuffle, a row per year and map task; the
    join's partition of a title with a third of all aliases is split by AQE. One
    conditional aggregation gives all regions (the pivot without its second
    aggregation); a region with no rows gives null."""
    codes = [code for code, _ in regions]
    aliases = cat.akas.filter(F.col("region").isin(codes)).select(F.col("titleId").alias("tconst"), "region")
    wanted = has_any("genres", [genre]) & F.col("startYear").between(year_from, year_to)
    rows = join_rated_titles(aliases, cat, wanted, ("startYear", "averageRating"))
    rating = F.col("averageRating").cast("double")
    out = rows.groupBy("startYear").agg(
        *[F.avg(F.when(F.col("region") == code, rating)).alias(name) for code, name in regions]
    )
    return out.select("startYear", *[name for _, name in regions])
