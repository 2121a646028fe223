"""Building blocks several questions share.

Scale notes that apply to all of them:

* every join is an inner equi-join on one key and carries no hint; the planner
  broadcasts a side only when its (estimated, then measured by AQE) size is
  under the configured threshold, and falls back to a sort-merge join, where
  AQE splits skewed partitions;
* per-key results are aggregated *before* they are joined to ``people`` /
  ``titles`` for names, so the name join sees one row per key;
* top-k is ``orderBy().limit()`` (TakeOrderedAndProject: a per-partition
  top-k, then a merge of k rows per partition), never a global sort;
* top-k per group is ``row_number() <= k`` which Spark plans as a
  WindowGroupLimit *before* the exchange, so a hot group is trimmed to k rows
  per map task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import ACTING_CATEGORIES, is_acting

TITLE_COLUMNS = (
    "tconst",
    "titleType",
    "primaryTitle",
    "originalTitle",
    "isAdult",
    "startYear",
    "endYear",
    "runtimeMinutes",
    "genres",
)


def rated_titles(cat: Catalog) -> DataFrame:
    """titles ⨝ ratings on tconst (title columns, then averageRating, numVotes);
    the catalogue's materialised copy when it carries one."""
    if cat.rated is not None:
        return cat.rated
    return cat.titles.join(cat.ratings, "tconst")


def join_rated_titles(rows: DataFrame, cat: Catalog, condition: Column, columns: Sequence[str] = ()) -> DataFrame:
    """``rows`` (keyed by tconst) ⨝ the titles that meet ``condition`` ⨝ ratings,
    with ``columns`` of both (``averageRating``, ``numVotes`` are of ratings).

    ``rows`` meet the selection first, so ratings join what is left of them; both
    joins are on tconst, and beyond the broadcast threshold share its shuffle."""
    if cat.rated is not None:
        return rows.join(cat.rated.filter(condition).select("tconst", *columns), "tconst")
    own = [c for c in columns if c in ("averageRating", "numVotes")]
    selected = cat.titles.filter(condition).select("tconst", *[c for c in columns if c not in own])
    return rows.join(selected, "tconst").join(cat.ratings.select("tconst", *own), "tconst")


def rated_credits(cat: Catalog) -> DataFrame:
    """principals ⨝ ratings: tconst, nconst, category, averageRating; from the
    catalogue's shared credits when it carries them."""
    if cat.credits is not None:
        return cat.credits.filter("rated").select("tconst", "nconst", "category", "averageRating")
    return cat.principals.select("tconst", "nconst", "category").join(
        cat.ratings.select("tconst", "averageRating"), "tconst"
    )


def titled_credits(cat: Catalog) -> DataFrame:
    """principals ⨝ titles: tconst, nconst, category, startYear, genres."""
    if cat.credits is not None:
        return cat.credits.select("tconst", "nconst", "category", F.inline("titles"))
    return cat.principals.select("tconst", "nconst", "category").join(
        cat.titles.select("tconst", "startYear", "genres"), "tconst"
    )


def rated_titled_credits(cat: Catalog) -> DataFrame:
    """principals ⨝ titles ⨝ ratings: tconst, nconst, startYear, averageRating."""
    if cat.credits is not None:
        rows = cat.credits.filter("rated").select("tconst", "nconst", "averageRating", F.inline("titles"))
        return rows.select("tconst", "nconst", "startYear", "averageRating")
    return (
        cat.principals.select("tconst", "nconst")
        .join(cat.titles.select("tconst", "startYear"), "tconst")
        .join(cat.ratings.select("tconst", "averageRating"), "tconst")
    )


def acting_credits(principals: DataFrame, categories: Iterable[str] = ACTING_CATEGORIES) -> DataFrame:
    return principals.filter(is_acting("category", categories))


def with_names(
    df: DataFrame,
    people: DataFrame,
    *,
    key: str = "nconst",
    cols: Sequence[str] = ("primaryName",),
) -> DataFrame:
    """Attach person columns to rows keyed by ``key`` (matched against
    ``nconst``; rows without a person drop out, as with the inner join)."""
    p = people.select(F.col("nconst").alias(key), *cols)
    return df.join(p, key)


def with_title(df: DataFrame, titles: DataFrame, *, key: str = "tconst", cols: Sequence[str] = ("primaryTitle",)) -> DataFrame:
    t = titles.select(F.col("tconst").alias(key), *cols)
    return df.join(t, key)


def finish(
    df: DataFrame,
    order: Sequence[Column],
    *,
    top_n: int | None = None,
    sort: bool = True,
    select: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Order (with tie keys), optionally cut to ``top_n``, then project.

    With ``top_n`` this is TakeOrderedAndProject. Without it the full relation is
    returned, globally sorted only if ``sort`` (a range shuffle; skip it when
    the consumer does not need order)."""
    if top_n is not None:
        df = df.orderBy(*order).limit(top_n)
    elif sort:
        df = df.orderBy(*order)
    return df.select(*select) if select is not None else df


def top_k_per_group(
    df: DataFrame,
    partition: Sequence[str | Column],
    order: Sequence[Column],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Rows ranked 1..k inside each group (``row_number``, ties broken by the
    order's trailing keys)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_k_global(df: DataFrame, order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """The first k rows overall with their 1-based rank.

    ``limit`` first, so only k rows reach the single-partition ranking window."""
    head = df.orderBy(*order).limit(k)
    return head.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
