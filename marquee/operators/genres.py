"""Questions over the genre list of a title, compared as a whole array."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import decade
from .common import finish, rated_titles, top_k_per_group


def rating_vs_genre_year_mean(cat: Catalog, *, top_n: int | None = None, sort: bool = False) -> DataFrame:
    """Q7. Every rated title with the mean rating of its (genres array,
    startYear) group and its deviation from it. Null genres / null year form
    their own groups.

    Plan: a hash aggregate per group (partial sums before the shuffle, so a hot
    group costs one row per map task) joined back on the group key with
    null-safe equality. This replaces a window partitioned by the group, which
    would sort every title of a hot group inside one task.

    The group table has one row per (genre set, year). The planner, and AQE from
    its measured size, broadcast it while it is under their byte thresholds;
    above, it is a sort-merge join on the group key, where AQE splits a hot
    group's partition on the titles side."""
    rated = rated_titles(cat).select("tconst", "primaryTitle", "startYear", "genres", "averageRating")
    means = rated.groupBy(F.col("genres").alias("g_genres"), F.col("startYear").alias("g_year")).agg(
        F.avg("averageRating").alias("avg_genre_rating")
    )
    joined = rated.join(
        means,
        rated["genres"].eqNullSafe(means["g_genres"]) & rated["startYear"].eqNullSafe(means["g_year"]),
    )
    out = joined.withColumn("rating_deviation", F.col("averageRating") - F.col("avg_genre_rating"))
    return finish(
        out,
        [F.asc("tconst")],
        top_n=top_n,
        sort=sort,
        select=(
            "tconst",
            "primaryTitle",
            "startYear",
            "genres",
            "averageRating",
            "avg_genre_rating",
            "rating_deviation",
        ),
    )


def top_genre_set_per_decade(cat: Catalog) -> DataFrame:
    """Q22. Per decade (``floor(startYear/10)*10``; null is a group) the genre
    set with most rated titles, rank 1 (ties: genres ascending)."""
    counts = (
        rated_titles(cat)
        .select(decade("startYear").alias("decade"), "genres")
        .groupBy("decade", "genres")
        .count()
    )
    top = top_k_per_group(counts, ["decade"], [F.desc("count"), F.asc("genres")], 1)
    return top.select("decade", "genres", "count", "rank")


def genre_per_decade(cat: Catalog) -> DataFrame:
    """Per decade (null is a group) the single genre with most rated titles,
    rank 1 (ties: genre ascending). A title counts for each of its genres."""
    counts = (
        rated_titles(cat)
        .select(decade("startYear").alias("decade"), F.explode("genres").alias("genre"))
        .groupBy("decade", "genre")
        .count()
    )
    top = top_k_per_group(counts, ["decade"], [F.desc("count"), F.asc("genre")], 1)
    return top.select("decade", "genre", "count", "rank")
