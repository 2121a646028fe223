"""Questions about people and their credits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import ACTING_CATEGORIES, has_any
from .common import (
    acting_credits,
    finish,
    join_rated_titles,
    rated_credits,
    rated_titled_credits,
    rated_titles,
    titled_credits,
    top_k_global,
    with_names,
    with_title,
)


def credits_per_name_and_title(cat: Catalog, *, top_n: int | None = None, sort: bool = True) -> DataFrame:
    """Q4. Credit rows per (primaryName, primaryTitle), every category.
    Namesakes (people or titles) merge, as the group key is the names.

    Most frequent first (ties: the names). The result is nearly as large as
    ``principals``; it stays distributed, and the sort is a range shuffle
    (``top_n``: TakeOrdered)."""
    # title key first: on a layout bucketed by tconst that join needs no
    # exchange, so the credits are shuffled once (by nconst) before the names.
    credits = cat.principals.select("tconst", "nconst").join(cat.titles.select("tconst", "primaryTitle"), "tconst")
    named = with_names(credits, cat.people)
    counts = named.groupBy("primaryName", "primaryTitle").count()
    return finish(
        counts,
        [F.desc("count"), F.asc("primaryName"), F.asc("primaryTitle")],
        top_n=top_n,
        sort=sort,
        select=("primaryName", "primaryTitle", "count"),
    )


def profession_counts(
    cat: Catalog, *, professions: Iterable[str] = ("actor", "actress", "producer")
) -> DataFrame:
    """Q5. People listing any of ``professions``; count of every profession
    they list (so e.g. ``writer`` appears when an actress also writes)."""
    listed = cat.people.filter(has_any("primaryProfession", professions))
    counts = listed.select(F.explode("primaryProfession").alias("profession")).groupBy("profession").count()
    return counts.orderBy(F.desc("count"), F.asc("profession"))


def top_series_actors(
    cat: Catalog,
    *,
    since_year: int = 2013,
    title_type: str = "tvSeries",
    n: int = 20,
) -> DataFrame:
    """Q8. Acting credits on ``title_type`` titles started in or after
    ``since_year``, counted per person (series credits, not episodes).

    The planner broadcasts the selected titles while they are under its byte
    threshold, and shuffles by title above it."""
    series = cat.titles.filter((F.col("startYear") >= since_year) & (F.col("titleType") == title_type)).select("tconst")
    counts = acting_credits(cat.principals).select("tconst", "nconst").join(series, "tconst").groupBy("nconst").count()
    named = with_names(counts, cat.people)
    return finish(named, [F.desc("count"), F.asc("nconst")], top_n=n, select=("primaryName", "count"))


def worst_rated_actors(
    cat: Catalog, *, min_credits: int = 50, top_n: int | None = None, sort: bool = True
) -> DataFrame:
    """Q9. Actors/actresses with more than ``min_credits`` acting credits on
    rated titles, by mean rating ascending (nulls first; ties: nconst)."""
    stats = (
        acting_credits(rated_credits(cat))
        .groupBy("nconst")
        .agg(F.avg("averageRating").alias("avg_rating"), F.count("tconst").alias("num_projects"))
        .filter(F.col("num_projects") > min_credits)
    )
    named = with_names(stats, cat.people)
    return finish(
        named,
        [F.asc_nulls_first("avg_rating"), F.asc("nconst")],
        top_n=top_n,
        sort=sort,
        select=("primaryName", "avg_rating", "num_projects"),
    )


def most_improved_people(cat: Catalog, *, top_n: int | None = None, sort: bool = True) -> DataFrame:
    """Q10. Per person (every category), the best rating improvement over their
    first credit. Credits are ordered by startYear (nulls first); the last
    rating up to a year is the one of that year's last title, the first rating
    the one of the earliest year's first title (by tconst, where the reference
    leaves titles of a year in any order). So a year gives one gain, and the
    result may be negative.

    The running window is two aggregates: first and last rating per person and
    year, then per person the best last rating less the earliest year's first.
    Both are partially aggregated before their shuffle, so a person with a third
    of all credits costs a few rows per map task."""
    per_year = (
        rated_titled_credits(cat)
        .groupBy("nconst", "startYear")
        .agg(F.min_by("averageRating", "tconst").alias("first"), F.max_by("averageRating", "tconst").alias("last"))
    )
    year = F.coalesce("startYear", F.lit(-(2**31)))
    gains = per_year.groupBy("nconst").agg((F.max("last") - F.min_by("first", year)).alias("max_improvement"))
    named = with_names(gains, cat.people)
    return finish(
        named,
        [F.desc_nulls_last("max_improvement"), F.asc("nconst")],
        top_n=top_n,
        sort=sort,
        select=("primaryName", "max_improvement"),
    )


def actors_by_genre_count(cat: Catalog, *, top_n: int | None = None, sort: bool = True) -> DataFrame:
    """Q11. Distinct genres over each actor's/actress's acting credits."""
    per_genre = acting_credits(titled_credits(cat)).select("nconst", F.explode("genres").alias("genre"))
    counts = per_genre.groupBy("nconst").agg(F.count_distinct("genre").alias("genre_count"))
    named = with_names(counts, cat.people)
    return finish(
        named, [F.desc("genre_count"), F.asc("nconst")], top_n=top_n, sort=sort, select=("primaryName", "genre_count")
    )


def people_by_rating_spread(cat: Catalog, *, n: int = 10) -> DataFrame:
    """Q16. Best minus worst rating over each person's rated credits (every
    category); distinct (primaryName, difference), top ``n`` (ties: name)."""
    spread = (
        rated_credits(cat)
        .groupBy("nconst")
        .agg((F.max("averageRating") - F.min("averageRating")).alias("ratingDifference"))
    )
    pairs = with_names(spread, cat.people).select("primaryName", "ratingDifference").distinct()
    return finish(pairs, [F.desc("ratingDifference"), F.asc("primaryName")], top_n=n)


def longest_careers(cat: Catalog, *, top_n: int | None = None, sort: bool = True) -> DataFrame:
    """Q18. First and last startYear over each person's credits (every
    category) and the span; longest first, unknown spans last."""
    years = (
        titled_credits(cat)
        .groupBy("nconst")
        .agg(F.min("startYear").alias("firstFilmYear"), F.max("startYear").alias("lastFilmYear"))
    )
    named = with_names(years, cat.people).withColumn("careerLength", F.col("lastFilmYear") - F.col("firstFilmYear"))
    return finish(
        named,
        [F.desc_nulls_last("careerLength"), F.asc("nconst")],
        top_n=top_n,
        sort=sort,
        select=("primaryName", "firstFilmYear", "lastFilmYear", "careerLength"),
    )


def people_by_genre_credits(cat: Catalog, *, genre: str = "Animation", n: int = 10) -> DataFrame:
    """Q19. Credits (every category) on titles whose genres hold ``genre``, per
    person; top ``n`` (ties: nconst)."""
    titles = cat.titles.filter(has_any("genres", [genre])).select("tconst")
    counts = (
        cat.principals.select("tconst", "nconst")
        .join(titles, "tconst")
        .groupBy("nconst")
        .agg(F.count("tconst").alias("totalAnimated"))
    )
    # grouping by (nconst, primaryName) after the name join, as the reference
    # does, collapses duplicate person rows
    named = with_names(counts, cat.people).groupBy("nconst", "primaryName").agg(
        F.max("totalAnimated").alias("totalAnimated")
    )
    return finish(named, [F.desc("totalAnimated"), F.asc("nconst")], top_n=n, select=("nconst", "primaryName", "totalAnimated"))


def youngest_actors(
    cat: Catalog,
    *,
    year: int = 2020,
    n: int = 20,
    categories: Iterable[str] = ACTING_CATEGORIES,
) -> DataFrame:
    """Q23. Acting credits on rated titles started in ``year``, counted per
    (primaryName, birthYear); the ``n`` youngest (null birthYear last; ties:
    name), ranked 1..n."""
    credits = acting_credits(cat.principals, categories).select("tconst", "nconst")
    # credits per person first (partial aggregation before the shuffle, so a
    # hot person is one row per map task), then the name join sees one row
    # per person; namesakes of one birth year are summed after it
    per_person = join_rated_titles(credits, cat, F.col("startYear") == year).groupBy("nconst").count()
    counts = with_names(per_person, cat.people, cols=("primaryName", "birthYear")).groupBy(
        "primaryName", "birthYear"
    ).agg(F.sum("count").alias("count"))
    ranked = top_k_global(counts, [F.desc_nulls_last("birthYear"), F.asc("primaryName")], n)
    return ranked.select("primaryName", "birthYear", "count", "rank")


def first_last_rating_gain(cat: Catalog, *, top_n: int | None = None, sort: bool = True) -> DataFrame:
    """Rating of each person's last title less that of their first, over rated
    and dated titles of every category, by (startYear, tconst); largest first
    (nulls last; ties: nconst)."""
    order = F.struct("startYear", "tconst")
    gains = (
        rated_titled_credits(cat)
        .filter(F.col("startYear").isNotNull())
        .groupBy("nconst")
        .agg((F.max_by("averageRating", order) - F.min_by("averageRating", order)).alias("rating_gain"))
    )
    named = with_names(gains, cat.people)
    return finish(
        named,
        [F.desc_nulls_last("rating_gain"), F.asc("nconst")],
        top_n=top_n,
        sort=sort,
        select=("primaryName", "rating_gain"),
    )


def actor_episode_counts(
    cat: Catalog, *, since_year: int = 2013, title_type: str = "tvSeries", n: int = 20, credited: str = "tconst"
) -> DataFrame:
    """Episodes of one series (``title_type``, started in or after
    ``since_year``) that an actor or actress is credited for; top ``n`` of
    (person, series) (ties: nconst, series).

    ``credited`` names the episode column that credits refer to: the episode
    itself, or ``parentTconst`` where only series carry credits."""
    episodes = cat.episodes.select(F.col(credited).alias("tconst"), F.col("parentTconst").alias("series"))
    series = cat.titles.filter((F.col("startYear") >= since_year) & (F.col("titleType") == title_type))
    counts = (
        acting_credits(cat.principals)
        .select("tconst", "nconst")
        .join(episodes.join(series.select(F.col("tconst").alias("series")), "series"), "tconst")
        .groupBy("nconst", "series")
        .agg(F.count(F.lit(1)).alias("episodes"))
    )
    named = with_title(with_names(counts, cat.people), cat.titles, key="series")
    return finish(
        named,
        [F.desc("episodes"), F.asc("nconst"), F.asc("series")],
        top_n=n,
        select=("primaryName", "primaryTitle", "episodes"),
    )
