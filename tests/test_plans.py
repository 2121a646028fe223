"""Physical plan shapes the design depends on."""

from __future__ import annotations

import pytest

from marquee.plans.inspect import operator_counts, physical_plan
from marquee.plans.registry import QUESTION_KEYS, REGISTRY


def plan(cat, key):
    return physical_plan(REGISTRY[key].build(cat))


@pytest.mark.parametrize("key", ["top_titles_per_year", "shortest_titles_per_type", "top_genre_set_per_decade"])
def test_top_k_per_group_is_trimmed_before_the_exchange(small_catalog, key):
    text = plan(small_catalog, key)
    assert "WindowGroupLimit" in text
    # the partial limit sits under the exchange that feeds the window
    head, _, tail = text.partition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in head and "WindowGroupLimit" in tail


@pytest.mark.parametrize("key", ["top_titles_by_votes", "youngest_actors", "series_by_episode_count"])
def test_global_top_k_is_take_ordered(small_catalog, key):
    assert "TakeOrderedAndProject" in plan(small_catalog, key)


@pytest.mark.parametrize(
    "key",
    [
        "rating_vs_genre_year_mean",
        "most_improved_people",
        "series_by_episode_count",
        "people_by_rating_spread",
        "titles_by_alias_count",
        "longest_careers",
        "people_by_genre_credits",
        "genre_rating_by_region",
    ],
)
def test_window_forms_became_aggregates(small_catalog, key):
    counts = operator_counts(plan(small_catalog, key))
    assert counts.get("Window", 0) == 0
    assert counts.get("HashAggregate", 0) + counts.get("ObjectHashAggregate", 0) + counts.get("SortAggregate", 0) > 0


@pytest.mark.parametrize("key", QUESTION_KEYS)
def test_no_python_and_no_cartesian(small_catalog, key):
    text = plan(small_catalog, key)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "Generate json"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    from marquee.sources import land_catalog, load_parquet, load_testdata
    from marquee.session import scratch_path

    cat = load_parquet(spark, land_catalog(load_testdata(spark, "/root/testdata/sf0.001"), scratch_path(spark, "p")))
    text = physical_plan(REGISTRY["top_titles_by_votes"].build(cat))
    assert "PushedFilters: [IsNotNull(startYear), GreaterThanOrEqual(startYear,2000)" in text
    q8 = physical_plan(REGISTRY["top_series_actors"].build(cat))
    assert "ReadSchema: struct<tconst:string,nconst:string,category:string>" in q8


def test_group_means_join_is_left_to_the_planner(spark, small_catalog):
    from marquee.operators import rating_vs_genre_year_mean

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = physical_plan(rating_vs_genre_year_mean(small_catalog))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # a forced hint would broadcast even with the threshold off
    assert "SortMergeJoin [coalesce(genres" in text and "BroadcastHashJoin" not in text
    assert "Window" not in text


SELECTIVE = {
    "top_series_actors": dict(since_year=1997, n=20),
    "people_by_genre_credits": dict(genre="ECONOMY", n=10),
    "youngest_actors": dict(year=2000, n=20),
    "top_writer_genre_sets": dict(year_from=1996, year_to=1998, n=5),
    "genre_rating_by_region": dict(genre="ECONOMY", year_from=1996, year_to=2000),
}


@pytest.mark.parametrize("key", list(SELECTIVE))
def test_no_question_forces_a_broadcast(spark, small_catalog, key):
    from marquee import operators as Q

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # plan as at scale
    try:
        text = physical_plan(getattr(Q, key)(small_catalog, **SELECTIVE[key]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in text and "SortMergeJoin [tconst" in text


@pytest.mark.parametrize(
    "key, keys",
    [("youngest_actors", ["nconst"]), ("top_writer_genre_sets", ["nconst", "genres"])],
)
def test_credits_are_counted_per_person_before_the_name_join(spark, small_catalog, key, keys):
    import re

    from marquee import operators as Q

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # plan as at scale
    try:
        text = physical_plan(getattr(Q, key)(small_catalog, **SELECTIVE[key]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # a partial count keyed on the person id (collapsing a hot person per map
    # task), then the name join, then the namesakes' counts summed per name
    ids = ", ".join(rf"{k}#\d+" for k in keys)
    assert re.search(rf"HashAggregate\(keys=\[{ids}\], functions=\[partial_count\(1\)\]", text), text
    assert re.search(r"HashAggregate\(keys=\[primaryName#\d+, \w+#\d+\], functions=\[partial_sum\(count", text), text


def test_selected_titles_meet_the_large_table_before_ratings(spark, small_catalog):
    from pyspark.sql import functions as F

    from marquee.operators.common import join_rated_titles

    credits = small_catalog.principals.select("tconst", "nconst")
    df = join_rated_titles(credits, small_catalog, F.col("startYear") == 2000, ("startYear", "averageRating"))
    assert df.columns == ["tconst", "nconst", "startYear", "averageRating"]
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    left, right = (side.outputSet().toString() for side in (node.left(), node.right()))
    assert "nconst" in left and "startYear" in left and "averageRating" not in left and "averageRating" in right
    # a shared table of rated titles takes both joins' place, with the same rows
    rated = small_catalog.with_tables(rated=small_catalog.titles.join(small_catalog.ratings, "tconst"))
    other = join_rated_titles(credits, rated, F.col("startYear") == 2000, ("startYear", "averageRating"))
    assert df.count() > 0 and df.exceptAll(other).count() == 0 and other.exceptAll(df).count() == 0
