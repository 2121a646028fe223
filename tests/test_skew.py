"""Hot keys: one title holds a third of all credits, one person another third.

With broadcasts off (as at scale) and AQE's skew thresholds scaled down to the
fixture, the shuffle joins must be split by AQE's skew handling, and the
results must still equal the SQL forms."""

from __future__ import annotations

import random

import pytest

from marquee import operators as Q
from marquee.plans import oracle as O
from marquee.plans.registry import present
from marquee.plans.verify import _rows

from .minicat import random_rows, to_catalog, to_duck

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",  # as in session.SCALE_CONF
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
}


def skewed_rows(seed: int = 7) -> dict[str, list[tuple]]:
    rows = random_rows(seed, n_titles=60, n_people=30, n_credits=1200)
    r = random.Random(seed)
    hot_title = rows["titles"][0][0]
    hot_person = rows["people"][0][0]
    extra = []
    for i in range(800):  # a third of all credits on one title
        extra.append((hot_title, i, r.choice([p[0] for p in rows["people"]]), r.choice(["actor", "actress"]), None, None))
    for i in range(800):  # and a third by one person
        extra.append((r.choice([t[0] for t in rows["titles"]]), i, hot_person, "actor", None, None))
    rows["principals"] = rows["principals"] + extra
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    rows = skewed_rows()
    return to_catalog(spark, rows), to_duck(rows)


CASES = {
    "worst_rated_actors": (Q.worst_rated_actors, dict(min_credits=3), O.q9(3)),
    "credits_per_name_and_title": (Q.credits_per_name_and_title, {}, O.q4()),
    "most_improved_people": (Q.most_improved_people, {}, O.q10()),
    "actors_by_genre_count": (Q.actors_by_genre_count, {}, O.q11()),
    "directors_by_actor_count": (Q.directors_by_actor_count, {}, O.q12()),
    "actors_by_director_count": (Q.actors_by_director_count, {}, O.q13()),
    "people_by_rating_spread": (Q.people_by_rating_spread, dict(n=9), O.q16(9)),
    "longest_careers": (Q.longest_careers, {}, O.q18()),
}


@pytest.mark.parametrize("case", list(CASES))
def test_hot_keys_are_split_and_results_hold(spark, skewed, case):
    fn, params, sql = CASES[case]
    cat, con = skewed
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = present(fn(cat, **params))
        got = [tuple(r) for r in df.collect()]
        final_plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    assert _rows(got, df.columns) == _rows(res.fetchall(), cols)
    assert "SortMergeJoin(skew=true)" in final_plan and "AQEShuffleRead skewed" in final_plan, final_plan


# Questions that count credits per person before the name join: the hot person
# is collapsed by the partial count -- the results must hold on the skewed
# catalogue.
COLLAPSED = {
    "top_series_actors": (Q.top_series_actors, dict(since_year=2000, n=5), O.q8(2000, "tvSeries", 5)),
    "people_by_genre_credits": (Q.people_by_genre_credits, dict(genre="A", n=5), O.q19("A", 5)),
    "top_writer_genre_sets": (
        Q.top_writer_genre_sets,
        dict(year_from=1999, year_to=2003, n=4),
        O.q20(1999, 2003, 4, "writer"),
    ),
    "youngest_actors": (Q.youngest_actors, dict(year=2002, n=4), O.q23(2002, 4)),
}


def test_hot_alias_title_is_split_and_averaged_before_the_shuffle(spark):
    rows = skewed_rows()
    hot = next(t for t in rows["titles"] if t[8] and "A" in t[8] and t[5] is not None and any(r[0] == t[0] and r[1] for r in rows["ratings"]))
    rows["akas"] = rows["akas"] + [
        (hot[0], i, "aka", random.Random(i).choice(["US", "UA"]), None, None, None, 0) for i in range(20_000)
    ]
    regions = (("US", "usa"), ("UA", "ua"))
    cat, con = to_catalog(spark, rows), to_duck(rows)
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = Q.genre_rating_by_region(cat, genre="A", year_from=1990, year_to=2010, regions=regions)
        got = [tuple(r) for r in df.collect()]
        final_plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    res = con.execute(O.q25("A", 1990, 2010, regions))
    cols = [d[0] for d in res.description]
    assert _rows(got, df.columns) == _rows(res.fetchall(), cols)
    assert "SortMergeJoin(skew=true)" in final_plan, final_plan
    # a row per year leaves a map task
    assert "partial_avg" in final_plan.split("Exchange hashpartitioning(startYear")[1], final_plan


@pytest.mark.parametrize("case", list(COLLAPSED))
def test_hot_person_is_collapsed_before_the_name_join(spark, skewed, case):
    fn, params, sql = COLLAPSED[case]
    cat, con = skewed
    df = present(fn(cat, **params))
    got = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    assert _rows(got, df.columns) == _rows(res.fetchall(), cols)
