"""marquee: film and television catalogue analytics on Spark.

Sources turn the seven catalogue tables into DataFrames (``sources``), the 25
questions are functions ``fn(catalog, *, params) -> DataFrame``
(``operators``), and ``plans`` holds the registry, the DuckDB oracle and the
batch job that runs everything.
"""

from .catalog import Catalog

__all__ = ["Catalog"]
