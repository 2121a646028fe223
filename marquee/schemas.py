"""Fixed input schemas of the seven catalogue tables.

Files are headered, tab-separated text with ``\\N`` as the null marker. The
schemas are declared, never inferred. Spark file sources read every column as
nullable whatever is declared, so the ``nullable`` flags below document the
data contract only; no code relies on them.

List-valued text columns (``genres``, ``primaryProfession``) are declared as
strings here and split into ``array<string>`` by the source layer.
"""

from __future__ import annotations

from pyspark.sql.types import (
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

S, I, F = StringType(), IntegerType(), FloatType()


def _schema(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


TITLES = _schema(
    ("tconst", S, False),
    ("titleType", S, False),
    ("primaryTitle", S, False),
    ("originalTitle", S, False),
    ("isAdult", I, False),
    ("startYear", I, True),
    ("endYear", I, True),
    ("runtimeMinutes", I, True),
    ("genres", S, True),
)

RATINGS = _schema(
    ("tconst", S, False),
    ("averageRating", F, True),
    ("numVotes", I, True),
)

CREW = _schema(
    ("tconst", S, False),
    ("directors", S, False),
    ("writers", S, True),
)

PRINCIPALS = _schema(
    ("tconst", S, False),
    ("ordering", I, False),
    ("nconst", S, False),
    ("category", S, False),
    ("job", S, True),
    ("characters", S, True),
)

EPISODES = _schema(
    ("tconst", S, False),
    ("parentTconst", S, False),
    ("seasonNumber", I, True),
    ("episodeNumber", I, True),
)

AKAS = _schema(
    ("titleId", S, False),
    ("ordering", I, False),
    ("title", S, False),
    ("region", S, True),
    ("language", S, True),
    ("types", S, True),
    ("attributes", S, True),
    ("isOriginalTitle", I, False),
)

PEOPLE = _schema(
    ("nconst", S, False),
    ("primaryName", S, False),
    ("birthYear", I, True),
    ("deathYear", I, True),
    ("primaryProfession", S, False),
    ("knownForTitles", S, False),
)

# Catalog attribute -> (raw text schema, file name in the public dataset layout,
# list columns split into arrays on load).
TABLES: dict[str, tuple[StructType, str, tuple[str, ...]]] = {
    "titles": (TITLES, "title.basics.tsv", ("genres",)),
    "ratings": (RATINGS, "title.ratings.tsv", ()),
    "crew": (CREW, "title.crew.tsv", ()),
    "principals": (PRINCIPALS, "title.principals.tsv", ()),
    "episodes": (EPISODES, "title.episode.tsv", ()),
    "akas": (AKAS, "title.akas.tsv", ()),
    "people": (PEOPLE, "name.basics.tsv", ("primaryProfession",)),
}
