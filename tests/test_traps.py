"""Hand-written rows for the semantics that are easy to get wrong."""

from __future__ import annotations

import pytest

from marquee import operators as Q

from .minicat import to_catalog


def title(t, year, genres=None, ttype="movie", runtime=90, name=None):
    return (t, ttype, name or f"Title {t}", f"Title {t}", 0, year, None, runtime, genres)


def person(n, name, birth=None, death=None, prof=("actor",)):
    return (n, name, birth, death, list(prof), None)


def credit(t, n, cat="actor", order=1):
    return (t, order, n, cat, None, None)


@pytest.fixture(scope="module")
def cat(spark):
    rows = {
        "titles": [
            title("t1", 2010, ["Drama"]),
            title("t2", 2011, ["Drama"]),
            title("t3", 2012, ["Drama", "Comedy"]),
            title("t4", None, ["Comedy", "Drama"]),  # same genres, other order; null year
            title("t5", 2021, ["Drama"], ttype="tvSeries"),
            title("t6", 2021, ["Drama"]),
            title("t7", 2005, ["Drama"]),
            title("t8", 2005, ["Drama"], runtime=None),
        ],
        "ratings": [
            ("t1", 5.0, 10),
            ("t2", 9.0, 30),
            ("t3", 4.0, 20),
            ("t4", 6.0, 5),
            ("t5", 8.0, 7),  # exactly 8: not above 8
            ("t6", 8.1, 7),
            ("t7", 7.0, 1),
            ("t8", 3.0, 1),
        ],
        "crew": [
            ("t1", "d1", "w1"),
            ("t2", "d1,d2", None),  # two directors: counts for no one
            ("t3", "d1", "w1,w2"),
        ],
        "principals": [
            credit("t1", "a1"),
            credit("t2", "a1"),
            credit("t3", "a1"),
            credit("t1", "a2"),
            credit("t1", "a2", order=2),  # same person twice on a title
            credit("t4", "a3", "actress"),
            credit("t2", "a3", "actress"),
            credit("t1", "ghost"),  # not in people
        ],
        "episodes": [
            ("e1", "t5", 1, None),
            ("e2", "t5", 1, None),  # only null episode numbers -> 0
            ("e3", "t1", 1, 1),
            ("e4", "t1", 1, 2),
        ],
        "akas": [
            ("t7", 1, "A", "US", None, None, None, 0),
            ("t7", 2, "B", "US", None, None, None, 0),  # two US aliases weight t7
            ("t8", 1, "C", "US", None, None, None, 0),
            ("t8", 2, None, "GB", None, None, None, 0),  # null title not counted
        ],
        "people": [
            person("a1", "Same Name", 1980),
            person("a2", "Same Name", 1980),  # namesake
            person("a3", "Other", 1990),
            person("d1", "Dir One", prof=("director",)),
            person("d2", "Dir Two", prof=("director",)),
            person("w1", "Writer One", death=2000, prof=("writer",)),
            person("w2", "Writer Two", death=2001, prof=("writer",)),
        ],
    }
    return to_catalog(spark, rows)


def test_sole_director_only(cat):
    rows = Q.top_directors_by_rating(cat).collect()
    assert [(r.primaryName, r.avgRating) for r in rows] == [("Dir One", pytest.approx(4.5))]


def test_sole_writer_and_death_year(cat):
    rows = Q.top_deceased_writers(cat).collect()
    assert [(r.primaryName, r.avgRating) for r in rows] == [("Writer One", pytest.approx(5.0))]


def test_running_improvement_not_final_minus_first(cat):
    # a1: ratings 5 (2010), 9 (2011), 4 (2012) -> best gain over first is 4, not -1
    rows = {r.primaryName: r.max_improvement for r in Q.most_improved_people(cat).collect()}
    got = sorted(r.max_improvement for r in Q.most_improved_people(cat).collect() if r.primaryName == "Same Name")
    assert got == [pytest.approx(0.0), pytest.approx(4.0)]  # a2 has only t1 (twice)
    # a3: null year sorts first: first rating 6 (t4), then 9 (t2) -> 3
    assert rows["Other"] == pytest.approx(3.0)


def _careers(spark, credits):
    """A catalogue of one person per list of (startYear, rating) titles."""
    from .minicat import to_catalog

    rows = {"titles": [], "ratings": [], "principals": [], "people": []}
    for p, titles in credits.items():
        rows["people"].append((p, p, None, None, None, None))
        for i, (year, rating) in enumerate(titles):
            t = f"{p}-{i}"
            rows["titles"].append((t, "movie", t, t, 0, year, None, None, None))
            rows["ratings"].append((t, rating, 1))
            rows["principals"].append((t, 1, p, "actor", None, None))
    return to_catalog(spark, rows)


def test_improvement_takes_a_year_as_one_step(spark):
    cat = _careers(
        spark,
        {
            "one year": [(2000, 9.0), (2000, 5.0)],  # first 9, last of the year 5
            "two years": [(2000, 6.0), (2000, 3.0), (2001, 9.0), (2001, 4.0)],  # 3-6, 4-6
            "null first": [(2001, 8.0), (None, 7.0)],
            "single": [(2003, 2.0)],
        },
    )
    got = {r.primaryName: r.max_improvement for r in Q.most_improved_people(cat).collect()}
    assert got == {
        "one year": pytest.approx(-4.0),
        "two years": pytest.approx(-2.0),
        "null first": pytest.approx(1.0),
        "single": pytest.approx(0.0),
    }
    gain = {r.primaryName: r.rating_gain for r in Q.first_last_rating_gain(cat).collect()}
    assert gain == {
        "one year": pytest.approx(-4.0),
        "two years": pytest.approx(-2.0),
        "null first": pytest.approx(0.0),  # the undated title is left out
        "single": pytest.approx(0.0),
    }


@pytest.mark.parametrize("credits, there", [(50, False), (51, True)])
def test_more_than_fifty_credits(spark, credits, there):
    cat = _careers(spark, {"busy": [(2000, 5.0)] * credits})
    assert [r.primaryName for r in Q.worst_rated_actors(cat).collect()] == ["busy"] * there


def test_strict_rating_bound(cat):
    got = {r.tconst for r in Q.titles_above_rating(cat, after_year=2020, min_rating=8).collect()}
    assert got == {"t6"}


def test_genres_compared_as_whole_arrays(cat):
    rows = {r.tconst: r for r in Q.rating_vs_genre_year_mean(cat).collect()}
    # t3 [Drama, Comedy] 2012 and t4 [Comedy, Drama] null year are separate groups
    assert rows["t3"].avg_genre_rating == pytest.approx(4.0)
    assert rows["t4"].avg_genre_rating == pytest.approx(6.0)
    # t7, t8: same genres, same year
    assert rows["t7"].avg_genre_rating == pytest.approx(5.0)
    assert rows["t7"].rating_deviation == pytest.approx(2.0)


def test_count_column_skips_nulls(cat):
    rows = {r.primaryTitle: r.totalEpisodes for r in Q.series_by_episode_count(cat).collect()}
    assert rows == {"Title t1": 2, "Title t5": 0}
    aliases = {r.primaryTitle: r.totalAdaptations for r in Q.titles_by_alias_count(cat).collect()}
    assert aliases == {"Title t7": 2, "Title t8": 1}


def test_namesakes_merge(cat):
    rows = {(r.primaryName, r.primaryTitle): r["count"] for r in Q.credits_per_name_and_title(cat).collect()}
    # a1 once + a2 twice on t1, both "Same Name"; the ghost credit has no person
    assert rows[("Same Name", "Title t1")] == 3
    spread = Q.people_by_rating_spread(cat).collect()
    assert ("Same Name", 0.0) in {(r.primaryName, r.ratingDifference) for r in spread}


def test_alias_rows_weight_the_mean_and_missing_region_is_null(cat):
    rows = Q.genre_rating_by_region(cat, year_from=2003, year_to=2009).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.startYear == 2005 and r.ua is None
    assert r.usa == pytest.approx((7.0 + 7.0 + 3.0) / 3)


def test_null_year_is_its_own_group(cat):
    per_year = {r.startYear for r in Q.top_titles_per_year(cat, k=1).collect()}
    assert None in per_year
    decades = {r.decade for r in Q.top_genre_set_per_decade(cat).collect()}
    assert None in decades and 2010 in decades


def test_category_filters_are_not_applied_where_the_question_has_none(cat):
    # Q1 has no titleType filter: the tvSeries t5 is included
    assert "t5" in {r.tconst for r in Q.top_titles_by_votes(cat, since_year=2021).collect()}


def test_shortest_skips_null_runtime(cat):
    rows = Q.shortest_titles_per_type(cat, k=10).collect()
    assert "Title t8" not in {r.primaryTitle for r in rows}
    assert len(rows) == 7


def test_youngest_rank_and_null_birth_last(cat):
    rows = Q.youngest_actors(cat, year=2011, n=5).collect()
    assert [(r.primaryName, r.birthYear, r["count"], r["rank"]) for r in rows] == [
        ("Other", 1990, 1, 1),
        ("Same Name", 1980, 1, 2),
    ]
