"""DuckDB oracle for every registered key.

The seven catalogue tables are built from the driver's parquet views with the
fixed mapping of FIXTURES.md §3 (CTEs below), then each question is written in
plain SQL. Where the reference computes through a window (Q7, Q14, Q16-Q19) the
oracle keeps that literal window form, and Q10 looks up each year's frame, so
the check also proves our group-by rewrites equal.

Conventions (DuckDB vs Spark): explicit NULLS FIRST/LAST, ``row_number`` cast
to INTEGER, ``floor`` cast to BIGINT, arrays emitted as comma text.
"""

from __future__ import annotations

# The table mapping of FIXTURES.md §3, DuckDB dialect.
MAPPING_CTES = {
    "title_basics": """
SELECT 'tt' || o_orderkey AS tconst,
       CASE o_orderstatus WHEN 'F' THEN 'movie' WHEN 'O' THEN 'tvSeries' ELSE 'tvEpisode' END AS titleType,
       'Title ' || (o_orderkey % 5000) AS primaryTitle,
       'Title ' || o_orderkey AS originalTitle,
       0 AS isAdult,
       CAST(extract(year FROM o_orderdate) AS INT) AS startYear,
       CAST(NULL AS INT) AS endYear,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
            ELSE CAST(floor(o_totalprice / 2000) AS INT) END AS runtimeMinutes,
       g.genres AS genres
FROM orders LEFT JOIN (
       SELECT l_orderkey, list_sort(list(DISTINCT p_type)) AS genres
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) g
  ON o_orderkey = g.l_orderkey""",
    "title_ratings": """
SELECT 'tt' || l_orderkey AS tconst,
       CAST(floor(2 * avg(l_quantity)) / 10 AS FLOAT) AS averageRating,
       CAST(sum(l_quantity) AS INT) AS numVotes
FROM lineitem GROUP BY l_orderkey""",
    "title_principals": """
SELECT 'tt' || l_orderkey AS tconst, l_linenumber AS ordering,
       'nms' || l_suppkey AS nconst,
       CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'R' THEN 'actress' ELSE 'director' END AS category,
       CAST(NULL AS VARCHAR) AS job, CAST(NULL AS VARCHAR) AS characters
FROM lineitem""",
    "title_crew": """
SELECT 'tt' || o_orderkey AS tconst,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'nmc' || o_custkey || ',nms0'
            ELSE 'nmc' || o_custkey END AS directors,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            WHEN o_orderpriority = '2-HIGH' THEN 'nmc' || o_custkey || ',nms1'
            ELSE 'nmc' || o_custkey END AS writers
FROM orders""",
    "name_basics": """
SELECT 'nms' || s_suppkey AS nconst, s_name AS primaryName,
       CASE WHEN s_suppkey % 10 <> 9 THEN CAST(1940 + s_suppkey % 60 AS INT) END AS birthYear,
       CASE WHEN s_suppkey % 7 = 0 THEN 2000 END AS deathYear,
       string_split(CASE s_suppkey % 4 WHEN 0 THEN 'actor' WHEN 1 THEN 'actor,producer'
               WHEN 2 THEN 'actress,writer' ELSE 'director,writer' END, ',') AS primaryProfession,
       CAST(NULL AS VARCHAR) AS knownForTitles
FROM supplier
UNION ALL
SELECT 'nmc' || c_custkey, c_name,
       CASE WHEN c_custkey % 10 <> 9 THEN CAST(1940 + c_custkey % 60 AS INT) END,
       CASE WHEN c_custkey % 7 = 0 THEN 2000 END,
       string_split(CASE c_custkey % 3 WHEN 0 THEN 'director' WHEN 1 THEN 'writer'
               ELSE 'director,writer' END, ','),
       CAST(NULL AS VARCHAR)
FROM customer""",
    "title_episode": """
SELECT 'ep' || l_orderkey || '-' || l_linenumber AS tconst,
       'tt' || l_orderkey AS parentTconst, l_linenumber AS seasonNumber,
       CASE WHEN l_returnflag <> 'N' THEN CAST(floor(l_quantity) AS INT) END AS episodeNumber
FROM lineitem""",
    "title_akas": """
SELECT 'tt' || l_orderkey AS titleId, l_linenumber AS ordering,
       CASE WHEN l_linestatus = 'F' THEN 'aka ' || l_orderkey END AS title,
       CASE r_name WHEN 'AMERICA' THEN 'US' WHEN 'EUROPE' THEN 'UA' ELSE r_name END AS region,
       CAST(NULL AS VARCHAR) AS language, CAST(NULL AS VARCHAR) AS types,
       CAST(NULL AS VARCHAR) AS attributes, 0 AS isOriginalTitle
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}

# catalogue attribute -> mapped table name
TABLE_OF = {
    "titles": "title_basics",
    "ratings": "title_ratings",
    "crew": "title_crew",
    "principals": "title_principals",
    "episodes": "title_episode",
    "akas": "title_akas",
    "people": "name_basics",
}

_RATED_COLS = (
    "tconst, titleType, primaryTitle, originalTitle, isAdult, startYear, endYear, runtimeMinutes, "
    "array_to_string(genres, ',') AS genres, averageRating, numVotes"
)


def with_mapping(question_sql: str) -> str:
    """The full oracle statement: mapping CTEs, then the question as a subquery."""
    ctes = ",\n".join(f"{name} AS ({body.strip()})" for name, body in MAPPING_CTES.items())
    return f"WITH {ctes}\nSELECT * FROM (\n{question_sql.strip()}\n) AS q"


def source_sql(table: str) -> str:
    name = TABLE_OF[table]
    if table == "titles":
        cols = (
            "tconst, titleType, primaryTitle, originalTitle, isAdult, startYear, endYear, runtimeMinutes, "
            "array_to_string(genres, ',') AS genres"
        )
    elif table == "people":
        cols = (
            "nconst, primaryName, birthYear, deathYear, array_to_string(primaryProfession, ',') AS primaryProfession, "
            "knownForTitles"
        )
    else:
        cols = "*"
    return f"SELECT {cols} FROM {name}"


ACT = "p.category IN ('actor', 'actress')"


def q1(since_year: int, n: int) -> str:
    return f"""
SELECT {_RATED_COLS} FROM title_basics JOIN title_ratings USING (tconst)
WHERE startYear >= {since_year}
ORDER BY numVotes DESC NULLS LAST, tconst LIMIT {n}"""


def q2(after_year: int, min_rating: float) -> str:
    return f"""
SELECT {_RATED_COLS} FROM title_basics JOIN title_ratings USING (tconst)
WHERE startYear > {after_year} AND averageRating > {min_rating}"""


def q3(n: int) -> str:
    return f"""
WITH d AS (SELECT directors, avg(averageRating) AS avgRating
           FROM title_ratings JOIN title_crew USING (tconst) GROUP BY directors)
SELECT nb.primaryName, d.avgRating FROM d JOIN name_basics nb ON d.directors = nb.nconst
ORDER BY d.avgRating DESC NULLS LAST, d.directors LIMIT {n}"""


def q4() -> str:
    return """
SELECT nb.primaryName, tb.primaryTitle, count(*) AS count
FROM title_principals p JOIN name_basics nb ON p.nconst = nb.nconst
     JOIN title_basics tb ON p.tconst = tb.tconst
GROUP BY nb.primaryName, tb.primaryTitle
ORDER BY count(*) DESC, nb.primaryName, tb.primaryTitle"""


def q5(professions: tuple[str, ...]) -> str:
    cond = " OR ".join(f"list_contains(primaryProfession, '{p}')" for p in professions)
    return f"""
SELECT profession, count(*) AS count
FROM (SELECT unnest(primaryProfession) AS profession FROM name_basics WHERE {cond})
GROUP BY profession"""


def q6(k: int) -> str:
    return f"""
SELECT * FROM (
  SELECT {_RATED_COLS},
         CAST(row_number() OVER (PARTITION BY startYear ORDER BY numVotes DESC NULLS LAST, tconst) AS INTEGER) AS rank
  FROM title_basics JOIN title_ratings USING (tconst))
WHERE rank <= {k} ORDER BY startYear DESC NULLS LAST, rank"""


def q7() -> str:
    return """
SELECT tconst, primaryTitle, startYear, array_to_string(genres, ',') AS genres, averageRating,
       avg(averageRating) OVER (PARTITION BY genres, startYear ORDER BY startYear) AS avg_genre_rating,
       averageRating - avg(averageRating) OVER (PARTITION BY genres, startYear ORDER BY startYear) AS rating_deviation
FROM title_basics JOIN title_ratings USING (tconst)"""


def q8(since_year: int, title_type: str, n: int) -> str:
    return f"""
WITH c AS (SELECT p.nconst, count(*) AS count
           FROM title_principals p JOIN title_basics t ON p.tconst = t.tconst
           WHERE t.startYear >= {since_year} AND t.titleType = '{title_type}' AND {ACT}
           GROUP BY p.nconst)
SELECT nb.primaryName, c.count FROM c JOIN name_basics nb ON c.nconst = nb.nconst
ORDER BY c.count DESC, c.nconst LIMIT {n}"""


def q9(min_credits: int) -> str:
    return f"""
WITH a AS (SELECT p.nconst, avg(r.averageRating) AS avg_rating, count(p.tconst) AS num_projects
           FROM title_principals p JOIN title_ratings r ON p.tconst = r.tconst
           WHERE {ACT} GROUP BY p.nconst HAVING count(p.tconst) > {min_credits})
SELECT nb.primaryName, a.avg_rating, a.num_projects FROM a JOIN name_basics nb ON a.nconst = nb.nconst
ORDER BY a.avg_rating ASC NULLS FIRST, a.nconst"""


def q10() -> str:
    # the frame is by startYear alone: titles of a year are peers, in tconst
    # order inside the frame
    return """
WITH c AS (SELECT p.nconst, p.tconst, t.startYear, r.averageRating
           FROM title_principals p JOIN title_basics t ON p.tconst = t.tconst
                JOIN title_ratings r ON p.tconst = r.tconst),
w AS (SELECT a.nconst, a.startYear,
             (SELECT b.averageRating FROM c b
              WHERE b.nconst = a.nconst AND (b.startYear IS NULL OR b.startYear <= a.startYear)
              ORDER BY b.startYear DESC NULLS LAST, b.tconst DESC LIMIT 1)
             - (SELECT b.averageRating FROM c b WHERE b.nconst = a.nconst
                ORDER BY b.startYear ASC NULLS FIRST, b.tconst LIMIT 1) AS rating_improvement
      FROM (SELECT DISTINCT nconst, startYear FROM c) a),
m AS (SELECT nconst, max(rating_improvement) AS max_improvement FROM w GROUP BY nconst)
SELECT nb.primaryName, m.max_improvement FROM m JOIN name_basics nb ON m.nconst = nb.nconst
ORDER BY m.max_improvement DESC NULLS LAST, m.nconst"""


def q11() -> str:
    return f"""
WITH g AS (SELECT p.nconst, count(DISTINCT e.genre) AS genre_count
           FROM title_principals p
                JOIN (SELECT tconst, unnest(genres) AS genre FROM title_basics) e ON p.tconst = e.tconst
           WHERE {ACT} GROUP BY p.nconst)
SELECT nb.primaryName, g.genre_count FROM g JOIN name_basics nb ON g.nconst = nb.nconst
ORDER BY g.genre_count DESC, g.nconst"""


def q12() -> str:
    return f"""
WITH d AS (SELECT c.directors, count(DISTINCT p.nconst) AS unique_actors_count
           FROM title_principals p JOIN title_crew c ON p.tconst = c.tconst
           WHERE {ACT} GROUP BY c.directors)
SELECT nb.primaryName, d.unique_actors_count FROM d JOIN name_basics nb ON d.directors = nb.nconst
ORDER BY d.unique_actors_count DESC, d.directors"""


def q13() -> str:
    return f"""
WITH a AS (SELECT p.nconst, count(DISTINCT c.directors) AS unique_directors_count
           FROM title_principals p JOIN title_crew c ON p.tconst = c.tconst
           WHERE {ACT} GROUP BY p.nconst)
SELECT nb.primaryName, a.unique_directors_count FROM a JOIN name_basics nb ON a.nconst = nb.nconst
ORDER BY a.unique_directors_count DESC, a.nconst"""


def q14(n: int) -> str:
    return f"""
WITH e AS (SELECT parentTconst, count(episodeNumber) OVER (PARTITION BY parentTconst) AS episodeCount
           FROM title_episode),
s AS (SELECT parentTconst, max(episodeCount) AS totalEpisodes FROM e GROUP BY parentTconst)
SELECT t.primaryTitle, s.totalEpisodes FROM s JOIN title_basics t ON s.parentTconst = t.tconst
ORDER BY s.totalEpisodes DESC, s.parentTconst LIMIT {n}"""


def q15(k: int) -> str:
    return f"""
SELECT primaryTitle, runtimeMinutes FROM (
  SELECT primaryTitle, runtimeMinutes,
         row_number() OVER (PARTITION BY titleType ORDER BY runtimeMinutes, tconst) AS rank
  FROM title_basics WHERE runtimeMinutes IS NOT NULL)
WHERE rank <= {k}"""


def q16(n: int) -> str:
    return f"""
WITH w AS (SELECT p.nconst,
                  max(r.averageRating) OVER (PARTITION BY p.nconst)
                  - min(r.averageRating) OVER (PARTITION BY p.nconst) AS ratingDifference
           FROM title_principals p JOIN title_ratings r ON p.tconst = r.tconst)
SELECT DISTINCT nb.primaryName, w.ratingDifference FROM w JOIN name_basics nb ON w.nconst = nb.nconst
ORDER BY ratingDifference DESC NULLS LAST, primaryName LIMIT {n}"""


def q17(n: int) -> str:
    return f"""
WITH a AS (SELECT titleId, count(title) OVER (PARTITION BY titleId) AS adaptationsCount FROM title_akas),
m AS (SELECT titleId, max(adaptationsCount) AS totalAdaptations FROM a GROUP BY titleId)
SELECT t.primaryTitle, m.totalAdaptations FROM m JOIN title_basics t ON m.titleId = t.tconst
ORDER BY m.totalAdaptations DESC, m.titleId LIMIT {n}"""


def q18() -> str:
    return """
WITH f AS (SELECT DISTINCT p.nconst,
                  min(t.startYear) OVER (PARTITION BY p.nconst) AS firstFilmYear,
                  max(t.startYear) OVER (PARTITION BY p.nconst) AS lastFilmYear
           FROM title_principals p JOIN title_basics t ON p.tconst = t.tconst)
SELECT nb.primaryName, f.firstFilmYear, f.lastFilmYear, f.lastFilmYear - f.firstFilmYear AS careerLength
FROM f JOIN name_basics nb ON f.nconst = nb.nconst
ORDER BY careerLength DESC NULLS LAST, f.nconst"""


def q19(genre: str, n: int) -> str:
    return f"""
WITH a AS (SELECT p.nconst, count(p.tconst) OVER (PARTITION BY p.nconst) AS animatedCount
           FROM title_basics t JOIN title_principals p ON t.tconst = p.tconst
           WHERE list_contains(t.genres, '{genre}'))
SELECT nb.nconst, nb.primaryName, max(a.animatedCount) AS totalAnimated
FROM a JOIN name_basics nb ON a.nconst = nb.nconst
GROUP BY nb.nconst, nb.primaryName
ORDER BY totalAnimated DESC, nb.nconst LIMIT {n}"""


def q20(year_from: int, year_to: int, n: int, profession: str) -> str:
    return f"""
SELECT nb.primaryName, array_to_string(t.genres, ',') AS genres, count(*) AS count
FROM title_basics t JOIN title_ratings r ON t.tconst = r.tconst
     JOIN title_crew c ON t.tconst = c.tconst
     JOIN title_principals p ON t.tconst = p.tconst
     JOIN name_basics nb ON p.nconst = nb.nconst
WHERE t.startYear >= {year_from} AND t.startYear <= {year_to}
  AND list_contains(nb.primaryProfession, '{profession}')
GROUP BY nb.primaryName, t.genres
ORDER BY count DESC, nb.primaryName, t.genres ASC NULLS FIRST LIMIT {n}"""


def q21(n: int) -> str:
    return f"""
WITH w AS (SELECT writers, avg(averageRating) AS avgRating
           FROM title_ratings JOIN title_crew USING (tconst) GROUP BY writers)
SELECT nb.primaryName, w.avgRating FROM w JOIN name_basics nb ON w.writers = nb.nconst
WHERE nb.deathYear IS NOT NULL
ORDER BY w.avgRating DESC NULLS LAST, w.writers LIMIT {n}"""


def q22() -> str:
    return """
WITH c AS (SELECT CAST(floor(startYear / 10) * 10 AS BIGINT) AS decade, genres, count(*) AS count
           FROM title_basics JOIN title_ratings USING (tconst) GROUP BY 1, 2),
r AS (SELECT decade, genres, count,
             CAST(row_number() OVER (PARTITION BY decade ORDER BY count DESC, genres ASC NULLS FIRST) AS INTEGER) AS rank
      FROM c)
SELECT decade, array_to_string(genres, ',') AS genres, count, rank FROM r WHERE rank = 1"""


def q23(year: int, n: int) -> str:
    return f"""
WITH c AS (SELECT nb.primaryName, nb.birthYear, count(*) AS count
           FROM title_basics t JOIN title_ratings r ON t.tconst = r.tconst
                JOIN title_principals p ON t.tconst = p.tconst
                JOIN name_basics nb ON p.nconst = nb.nconst
           WHERE t.startYear = {year} AND (p.category = 'actor' OR p.category = 'actress')
           GROUP BY nb.primaryName, nb.birthYear),
r AS (SELECT primaryName, birthYear, count,
             CAST(row_number() OVER (ORDER BY birthYear DESC NULLS LAST, primaryName) AS INTEGER) AS rank
      FROM c)
SELECT primaryName, birthYear, count, rank FROM r WHERE rank <= {n}"""


def q24(since_year: int) -> str:
    return f"""
SELECT startYear, count(tconst) AS movies_produced, avg(runtimeMinutes) AS average_runtime
FROM title_basics JOIN title_ratings USING (tconst)
WHERE startYear >= {since_year} GROUP BY startYear"""


def q25(genre: str, year_from: int, year_to: int, regions: tuple[tuple[str, str], ...]) -> str:
    codes = " OR ".join(f"k.region = '{code}'" for code, _ in regions)
    pivots = ", ".join(f"max(CASE WHEN region = '{code}' THEN avg_rating END) AS {name}" for code, name in regions)
    return f"""
WITH a AS (SELECT t.startYear, k.region, avg(r.averageRating) AS avg_rating
           FROM title_basics t JOIN title_akas k ON t.tconst = k.titleId
                JOIN title_ratings r ON t.tconst = r.tconst
           WHERE list_contains(t.genres, '{genre}') AND t.startYear BETWEEN {year_from} AND {year_to}
             AND ({codes})
           GROUP BY t.startYear, k.region)
SELECT startYear, {pivots} FROM a GROUP BY startYear"""


def directors_by_rating_all(n: int) -> str:
    return f"""
WITH d AS (SELECT c.nconst, avg(r.averageRating) AS avgRating
           FROM (SELECT tconst, unnest(string_split(directors, ',')) AS nconst FROM title_crew) c
                JOIN title_ratings r ON c.tconst = r.tconst GROUP BY c.nconst)
SELECT nb.primaryName, d.avgRating FROM d JOIN name_basics nb ON d.nconst = nb.nconst
ORDER BY d.avgRating DESC NULLS LAST, d.nconst LIMIT {n}"""


def first_last_rating_gain() -> str:
    return """
WITH c AS (SELECT DISTINCT p.nconst, p.tconst, t.startYear, r.averageRating
           FROM title_principals p JOIN title_basics t ON p.tconst = t.tconst
                JOIN title_ratings r ON p.tconst = r.tconst
           WHERE t.startYear IS NOT NULL),
w AS (SELECT nconst, averageRating,
             row_number() OVER (PARTITION BY nconst ORDER BY startYear, tconst) AS up,
             row_number() OVER (PARTITION BY nconst ORDER BY startYear DESC, tconst DESC) AS down FROM c)
SELECT nb.primaryName, l.averageRating - f.averageRating AS rating_gain
FROM w f JOIN w l ON f.nconst = l.nconst AND f.up = 1 AND l.down = 1
     JOIN name_basics nb ON f.nconst = nb.nconst
ORDER BY rating_gain DESC NULLS LAST, f.nconst"""


def genre_per_decade() -> str:
    return """
WITH c AS (SELECT decade, genre, count(*) AS count
           FROM (SELECT CAST(floor(startYear / 10) * 10 AS BIGINT) AS decade, unnest(genres) AS genre
                 FROM title_basics JOIN title_ratings USING (tconst)) GROUP BY decade, genre),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY decade ORDER BY count DESC, genre) AS INTEGER) AS rank FROM c)
SELECT decade, genre, count, rank FROM r WHERE rank = 1"""


def actor_episode_counts(since_year: int, title_type: str, n: int, credited: str) -> str:
    return f"""
WITH c AS (SELECT p.nconst, e.parentTconst, count(*) AS episodes
           FROM title_episode e JOIN title_principals p ON e.{credited} = p.tconst
                JOIN title_basics s ON e.parentTconst = s.tconst
           WHERE {ACT} AND s.startYear >= {since_year} AND s.titleType = '{title_type}'
           GROUP BY p.nconst, e.parentTconst)
SELECT nb.primaryName, t.primaryTitle, c.episodes
FROM c JOIN name_basics nb ON c.nconst = nb.nconst JOIN title_basics t ON c.parentTconst = t.tconst
ORDER BY c.episodes DESC, c.nconst, c.parentTconst LIMIT {n}"""
