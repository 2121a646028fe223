"""The 25 questions, each ``fn(catalog, *, params) -> DataFrame``.

Defaults are the reference's literal parameters.
"""

from .common import (
    acting_credits,
    finish,
    rated_titles,
    top_k_global,
    top_k_per_group,
    with_names,
    with_title,
)
from .crew import (
    actors_by_director_count,
    directors_by_actor_count,
    directors_by_rating_all,
    top_deceased_writers,
    top_directors_by_rating,
    top_writer_genre_sets,
)
from .genres import genre_per_decade, rating_vs_genre_year_mean, top_genre_set_per_decade
from .people import (
    actor_episode_counts,
    actors_by_genre_count,
    credits_per_name_and_title,
    first_last_rating_gain,
    longest_careers,
    most_improved_people,
    people_by_genre_credits,
    people_by_rating_spread,
    profession_counts,
    top_series_actors,
    worst_rated_actors,
    youngest_actors,
)
from .titles import (
    genre_rating_by_region,
    series_by_episode_count,
    shortest_titles_per_type,
    titles_above_rating,
    titles_by_alias_count,
    titles_per_year,
    top_titles_by_votes,
    top_titles_per_year,
)

# Question number -> function, in the reference's numbering.
QUESTIONS = {
    1: top_titles_by_votes,
    2: titles_above_rating,
    3: top_directors_by_rating,
    4: credits_per_name_and_title,
    5: profession_counts,
    6: top_titles_per_year,
    7: rating_vs_genre_year_mean,
    8: top_series_actors,
    9: worst_rated_actors,
    10: most_improved_people,
    11: actors_by_genre_count,
    12: directors_by_actor_count,
    13: actors_by_director_count,
    14: series_by_episode_count,
    15: shortest_titles_per_type,
    16: people_by_rating_spread,
    17: titles_by_alias_count,
    18: longest_careers,
    19: people_by_genre_credits,
    20: top_writer_genre_sets,
    21: top_deceased_writers,
    22: top_genre_set_per_decade,
    23: youngest_actors,
    24: titles_per_year,
    25: genre_rating_by_region,
}

# What some questions ask for in words but the reference computes otherwise.
EXTENSIONS = (directors_by_rating_all, first_last_rating_gain, genre_per_decade, actor_episode_counts)

__all__ = [f.__name__ for f in (*QUESTIONS.values(), *EXTENSIONS)] + [
    "EXTENSIONS",
    "QUESTIONS",
    "acting_credits",
    "finish",
    "rated_titles",
    "top_k_global",
    "top_k_per_group",
    "with_names",
    "with_title",
]
