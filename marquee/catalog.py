"""The catalogue: seven DataFrames that every question reads."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

TABLE_NAMES = ("titles", "ratings", "crew", "principals", "episodes", "akas", "people")


@dataclass(frozen=True)
class Catalog:
    titles: DataFrame
    ratings: DataFrame
    crew: DataFrame
    principals: DataFrame
    episodes: DataFrame
    akas: DataFrame
    people: DataFrame
    # Optional derived relations, already materialised (see ``plans.job.shared``):
    # titles ⨝ ratings, used through ``rated_titles``; and the credits with their
    # rating and titles, used through ``rated_credits`` and its like.
    rated: DataFrame | None = field(default=None, compare=False, repr=False)
    credits: DataFrame | None = field(default=None, compare=False, repr=False)

    @classmethod
    def names(cls) -> tuple[str, ...]:
        return TABLE_NAMES

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(n, getattr(self, n)) for n in self.names()]

    def with_tables(self, **tables: DataFrame) -> "Catalog":
        return replace(self, **tables)

    @property
    def spark(self):
        return self.titles.sparkSession
