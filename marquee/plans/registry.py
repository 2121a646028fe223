"""Registry: key -> question, its parameters on the driver's tables, its oracle.

Reference defaults are useless on the driver's data (years 1995-2001, part
§7.3. Questions the reference sorts are registered sorted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .. import operators as Q
from ..catalog import Catalog
from ..functions import list_text
from ..schemas import TABLES
from ..session import scratch_path
from ..sources import read_table, write_tsv
from ..sources.testdata import load_testdata
from . import oracle as O


@dataclass(frozen=True)
class Spec:
    key: str
    number: int | None  # reference question number, None for sources and extensions
    build: Callable[[Catalog], DataFrame]
    sql: str | None
    params: dict = field(default_factory=dict)


def present(df: DataFrame) -> DataFrame:
    """Arrays as comma text, so results compare as flat rows."""
    return df.select(
        *[
            list_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _q(key: str, number: int | None, fn, sql: str, **params) -> Spec:
    return Spec(key, number, lambda cat, fn=fn, params=params: fn(cat, **params), sql, params)


def _src(table: str) -> Spec:
    return Spec(f"src_{table}", None, lambda cat, t=table: getattr(cat, t), O.source_sql(table))


def _tsv(table: str) -> Spec:
    """The table written as TSV and read back by the reader of the public files."""

    def build(cat: Catalog) -> DataFrame:
        base = scratch_path(cat.spark, "tsv")
        write_tsv(getattr(cat, table), f"{base}/{TABLES[table][1]}")
        return read_table(cat.spark, base, table)

    return Spec(f"tsv_{table}", None, build, O.source_sql(table))


ECONOMY = "ECONOMY"  # a part type standing in for a genre on the driver's data

SPECS: list[Spec] = [
    *[_src(t) for t in Catalog.names()],
    *[_tsv(t) for t in Catalog.names()],
    _q("top_titles_by_votes", 1, Q.top_titles_by_votes, O.q1(2000, 10), since_year=2000, n=10),
    _q("titles_above_rating", 2, Q.titles_above_rating, O.q2(2000, 8), after_year=2000, min_rating=8),
    _q("top_directors_by_rating", 3, Q.top_directors_by_rating, O.q3(10), n=10),
    _q("credits_per_name_and_title", 4, Q.credits_per_name_and_title, O.q4()),
    _q(
        "profession_counts",
        5,
        Q.profession_counts,
        O.q5(("actor", "actress", "producer")),
        professions=("actor", "actress", "producer"),
    ),
    _q("top_titles_per_year", 6, Q.top_titles_per_year, O.q6(5), k=5),
    _q("rating_vs_genre_year_mean", 7, Q.rating_vs_genre_year_mean, O.q7(), sort=False),
    _q(
        "top_series_actors",
        8,
        Q.top_series_actors,
        O.q8(1997, "tvSeries", 20),
        since_year=1997,
        title_type="tvSeries",
        n=20,
    ),
    _q("worst_rated_actors", 9, Q.worst_rated_actors, O.q9(50), min_credits=50),
    _q("most_improved_people", 10, Q.most_improved_people, O.q10()),
    _q("actors_by_genre_count", 11, Q.actors_by_genre_count, O.q11()),
    _q("directors_by_actor_count", 12, Q.directors_by_actor_count, O.q12()),
    _q("actors_by_director_count", 13, Q.actors_by_director_count, O.q13()),
    _q("series_by_episode_count", 14, Q.series_by_episode_count, O.q14(10), n=10),
    _q("shortest_titles_per_type", 15, Q.shortest_titles_per_type, O.q15(10), k=10),
    _q("people_by_rating_spread", 16, Q.people_by_rating_spread, O.q16(10), n=10),
    _q("titles_by_alias_count", 17, Q.titles_by_alias_count, O.q17(10), n=10),
    _q("longest_careers", 18, Q.longest_careers, O.q18()),
    _q("people_by_genre_credits", 19, Q.people_by_genre_credits, O.q19(ECONOMY, 10), genre=ECONOMY, n=10),
    _q(
        "top_writer_genre_sets",
        20,
        Q.top_writer_genre_sets,
        O.q20(1996, 1998, 5, "writer"),
        year_from=1996,
        year_to=1998,
        n=5,
        profession="writer",
    ),
    _q("top_deceased_writers", 21, Q.top_deceased_writers, O.q21(5), n=5),
    _q("top_genre_set_per_decade", 22, Q.top_genre_set_per_decade, O.q22()),
    _q("youngest_actors", 23, Q.youngest_actors, O.q23(2000, 20), year=2000, n=20),
    _q("titles_per_year", 24, Q.titles_per_year, O.q24(2000), since_year=2000),
    _q(
        "genre_rating_by_region",
        25,
        Q.genre_rating_by_region,
        O.q25(ECONOMY, 1996, 2000, (("US", "usa"), ("UA", "ua"))),
        genre=ECONOMY,
        year_from=1996,
        year_to=2000,
        regions=(("US", "usa"), ("UA", "ua")),
    ),
    _q("directors_by_rating_all", None, Q.directors_by_rating_all, O.directors_by_rating_all(10), n=10),
    _q("first_last_rating_gain", None, Q.first_last_rating_gain, O.first_last_rating_gain()),
    _q("genre_per_decade", None, Q.genre_per_decade, O.genre_per_decade()),
    # on the driver's data credits are given for series, not for episodes
    _q(
        "actor_episode_counts",
        None,
        Q.actor_episode_counts,
        O.actor_episode_counts(1997, "tvSeries", 20, "parentTconst"),
        since_year=1997,
        n=20,
        credited="parentTconst",
    ),
]

REGISTRY: dict[str, Spec] = {s.key: s for s in SPECS}
QUESTION_KEYS = [s.key for s in SPECS if s.number is not None]


def query_fn(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(REGISTRY[key].build(load_testdata(spark, sf_dir)))

    fn.__name__ = key
    return fn


def oracle_statement(key: str) -> str | None:
    sql = REGISTRY[key].sql
    return O.with_mapping(sql) if sql is not None else None
