from .parquet import land_catalog, load_parquet, write_table
from .sinks import preview, preview_written
from .testdata import load_testdata
from .tsv import (
    load_tsv,
    read_akas,
    read_crew,
    read_episodes,
    read_people,
    read_principals,
    read_ratings,
    read_table,
    read_titles,
    read_tsv,
    save_tsv,
    write_tsv,
)

__all__ = [
    "land_catalog",
    "load_parquet",
    "write_table",
    "preview",
    "preview_written",
    "load_testdata",
    "load_tsv",
    "read_akas",
    "read_crew",
    "read_episodes",
    "read_people",
    "read_principals",
    "read_ratings",
    "read_table",
    "read_titles",
    "read_tsv",
    "save_tsv",
    "write_tsv",
]
