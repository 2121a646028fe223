"""Small hand-made or seeded random catalogues, loaded into Spark and DuckDB."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from marquee.catalog import Catalog
from marquee.plans.oracle import TABLE_OF
from marquee.schemas import TABLES

_ARROW = {"string": pa.string(), "int": pa.int32(), "float": pa.float32()}


def spark_schema(table: str) -> StructType:
    schema, _, lists = TABLES[table]
    return StructType(
        [
            StructField(f.name, ArrayType(StringType()) if f.name in lists else f.dataType, True)
            for f in schema.fields
        ]
    )


def arrow_schema(table: str) -> pa.Schema:
    schema, _, lists = TABLES[table]
    return pa.schema(
        [
            pa.field(f.name, pa.list_(pa.string()) if f.name in lists else _ARROW[f.dataType.simpleString()])
            for f in schema.fields
        ]
    )


def to_catalog(spark, rows: dict[str, list[tuple]]) -> Catalog:
    return Catalog(**{t: spark.createDataFrame(rows.get(t, []), spark_schema(t)) for t in Catalog.names()})


def to_duck(rows: dict[str, list[tuple]]):
    import duckdb

    con = duckdb.connect()
    for t in Catalog.names():
        schema = arrow_schema(t)
        cols = list(zip(*rows.get(t, []))) or [[] for _ in schema]
        table = pa.Table.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(cols, schema)], schema=schema)
        con.register(f"_{t}", table)
        con.execute(f"CREATE VIEW {TABLE_OF[t]} AS SELECT * FROM _{t}")
    return con


GENRES = ["A", "B", "C", "D"]
CATEGORIES = ["actor", "actress", "director", "writer", "producer"]
PROFESSIONS = ["actor", "actress", "producer", "writer", "director"]


def random_rows(seed: int, n_titles: int = 40, n_people: int = 20, n_credits: int = 220) -> dict[str, list[tuple]]:
    r = random.Random(seed)

    def maybe(v, p_null=0.1):
        return None if r.random() < p_null else v

    def genres():
        x = r.random()
        if x < 0.1:
            return None
        if x < 0.15:
            return []
        g = r.sample(GENRES, r.randint(1, 3))
        return g if r.random() < 0.2 else sorted(g)  # some unsorted: compared as whole arrays

    tconsts = [f"t{i:03d}" for i in range(n_titles)]
    nconsts = [f"n{i:03d}" for i in range(n_people)]
    titles = [
        (
            t,
            r.choice(["movie", "tvSeries", "tvEpisode"]),
            f"Title {i % 15}",  # namesake titles
            f"Original {i}",
            0,
            maybe(r.randint(1998, 2005), 0.12),
            None,
            maybe(r.randint(1, 12) * 10, 0.15),
            genres(),
        )
        for i, t in enumerate(tconsts)
    ]
    rated = [t for t in tconsts if r.random() < 0.85]
    ratings = [(t, maybe(r.randint(2, 100) / 10.0, 0.05), r.randint(1, 6)) for t in rated]  # vote ties

    def person_list(p_multi=0.3):
        ids = nconsts + ["n999"]  # n999 is not in people
        one = r.choice(ids)
        return f"{one},{r.choice(ids)}" if r.random() < p_multi else one

    crew = [(t, person_list(), maybe(person_list(), 0.2)) for t in tconsts if r.random() < 0.9]
    principals = [
        (r.choice(tconsts), r.randint(1, 5), r.choice(nconsts + ["n999"]), r.choice(CATEGORIES), None, None)
        for _ in range(n_credits)
    ]
    principals += principals[:15]  # repeated credits
    episodes = [
        (f"e{i}", r.choice(tconsts), r.randint(1, 3), maybe(r.randint(1, 20), 0.3)) for i in range(120)
    ]
    akas = [
        (r.choice(tconsts), i, maybe(f"aka {i}", 0.3), r.choice(["US", "UA", "GB", None]), None, None, None, 0)
        for i in range(150)
    ]
    people = [
        (
            n,
            f"Person {i % 16}",  # namesakes
            maybe(r.randint(1950, 2000), 0.15),
            maybe(2010, 0.6),
            maybe(r.sample(PROFESSIONS, r.randint(1, 3)), 0.05),
            None,
        )
        for i, n in enumerate(nconsts)
    ]
    return {
        "titles": titles,
        "ratings": ratings,
        "crew": crew,
        "principals": principals,
        "episodes": episodes,
        "akas": akas,
        "people": people,
    }
