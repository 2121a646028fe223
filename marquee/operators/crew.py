"""Questions over the crew table (director / writer lists).

``directors`` and ``writers`` are comma lists kept as text. The questions group
by the *whole* list and then match it to ``people.nconst``, so only titles with
a sole director (writer) reach a name -- the reference's semantics, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import has_any
from .common import acting_credits, finish, rated_titles, with_names


def _sole(role: str) -> Column:
    """Lists of one person. A longer list can't equal a person id, as no id
    holds a comma, so dropping it before the shuffle loses no name."""
    return ~F.contains(F.col(role), F.lit(","))


def _mean_rating_per(cat: Catalog, role: str) -> DataFrame:
    return (
        cat.ratings.select("tconst", "averageRating")
        .join(cat.crew.filter(_sole(role)).select("tconst", role), "tconst")
        .groupBy(role)
        .agg(F.avg("averageRating").alias("avgRating"))
    )


def top_directors_by_rating(cat: Catalog, *, n: int = 10) -> DataFrame:
    """Q3. Mean rating per director list; sole directors named; top ``n``
    (ties: nconst). No vote weights, no minimum."""
    named = with_names(_mean_rating_per(cat, "directors"), cat.people, key="directors")
    return finish(named, [F.desc_nulls_last("avgRating"), F.asc("directors")], top_n=n, select=("primaryName", "avgRating"))


def top_deceased_writers(cat: Catalog, *, n: int = 5) -> DataFrame:
    """Q21. Q3's shape on writers, restricted to people with a death year."""
    dead = cat.people.filter(F.col("deathYear").isNotNull())
    named = with_names(_mean_rating_per(cat, "writers"), dead, key="writers")
    return finish(named, [F.desc_nulls_last("avgRating"), F.asc("writers")], top_n=n, select=("primaryName", "avgRating"))


def directors_by_rating_all(cat: Catalog, *, n: int = 10) -> DataFrame:
    """Mean rating over *all* rated titles of a director, alone or with others;
    top ``n`` (ties: nconst)."""
    means = (
        cat.ratings.select("tconst", "averageRating")
        .join(cat.crew.select("tconst", F.explode(F.split("directors", ",")).alias("nconst")), "tconst")
        .groupBy("nconst")
        .agg(F.avg("averageRating").alias("avgRating"))
    )
    named = with_names(means, cat.people)
    return finish(named, [F.desc_nulls_last("avgRating"), F.asc("nconst")], top_n=n, select=("primaryName", "avgRating"))


def _acting_with_crew(cat: Catalog, sole: bool = False) -> DataFrame:
    crew = cat.crew.filter(_sole("directors")) if sole else cat.crew
    return acting_credits(cat.principals).select("tconst", "nconst").join(crew.select("tconst", "directors"), "tconst")


def directors_by_actor_count(cat: Catalog, *, top_n: int | None = None, sort: bool = True) -> DataFrame:
    """Q12. Distinct actors/actresses per director list; sole directors named."""
    counts = _acting_with_crew(cat, sole=True).groupBy("directors").agg(F.count_distinct("nconst").alias("unique_actors_count"))
    named = with_names(counts, cat.people, key="directors")
    return finish(
        named,
        [F.desc("unique_actors_count"), F.asc("directors")],
        top_n=top_n,
        sort=sort,
        select=("primaryName", "unique_actors_count"),
    )


def actors_by_director_count(cat: Catalog, *, top_n: int | None = None, sort: bool = True) -> DataFrame:
    """Q13. Distinct director *lists* over each actor's/actress's credits."""
    counts = _acting_with_crew(cat).groupBy("nconst").agg(F.count_distinct("directors").alias("unique_directors_count"))
    named = with_names(counts, cat.people)
    return finish(
        named,
        [F.desc("unique_directors_count"), F.asc("nconst")],
        top_n=top_n,
        sort=sort,
        select=("primaryName", "unique_directors_count"),
    )


def top_writer_genre_sets(
    cat: Catalog,
    *,
    year_from: int = 1939,
    year_to: int = 1945,
    n: int = 5,
    profession: str = "writer",
) -> DataFrame:
    """Q20. Credits (any category) of people listing ``profession`` on rated
    titles started in [year_from, year_to] that have a crew row, counted per
    (primaryName, genres array); top ``n`` (ties: name, genres).

    The crew join is kept as an inner join (it multiplies if crew repeats a
    title, as in the reference); it is made on the few years' titles, before
    the credits. Credits are counted per (person, genres) before the name join,
    which then sees one row per person and genre set; namesakes are summed after
    it."""
    titles = (
        rated_titles(cat)
        .filter((F.col("startYear") >= year_from) & (F.col("startYear") <= year_to))
        .select("tconst", "genres")
        .join(cat.crew.select("tconst"), "tconst")
    )
    writers = cat.people.filter(has_any("primaryProfession", [profession])).select("nconst", "primaryName")
    per_person = cat.principals.select("tconst", "nconst").join(titles, "tconst").groupBy("nconst", "genres").count()
    counts = per_person.join(writers, "nconst").groupBy("primaryName", "genres").agg(F.sum("count").alias("count"))
    return finish(counts, [F.desc("count"), F.asc("primaryName"), F.asc("genres")], top_n=n)
