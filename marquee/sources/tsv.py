"""Headered TSV sources with fixed schemas.

Rules (one place for all seven tables):

* ``\\N`` and the empty field are null; the header line is skipped and columns
  bind by position.
* Parse mode is PERMISSIVE: a non-integer in an int column becomes null and the
  row stays.
* Quoting is off by default (``quote=""``). The raw dataset is not CSV-quoted, and
  with ``"`` as the quote char a field that opens a quote without closing it
  swallows the following tabs. ``quote='"'`` restores Spark's CSV default.
* ``genres`` and ``primaryProfession`` are split on commas into
  ``array<string>``; the other list columns (``directors``, ``writers``,
  ``knownForTitles``) stay text, because the questions compare them as a whole.

Gzipped TSV is not splittable; land it once as Parquet (``sources.parquet``) and
run the questions on the landed copy.

``write_tsv`` / ``save_tsv`` are the readers' inverse: what they write reads back
as the same rows. The format has no escapes, so values it can't carry -- tabs, line
ends and NUL, the empty text and ``\\N`` (both read as null), list elements that are
null or empty or hold commas, empty lists -- are errors, or, with
``on_unsafe="null"``, nulls (a list loses such elements; tabs, line ends and commas become blanks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..catalog import Catalog
from ..schemas import TABLES

NULL_MARKER = "\\N"


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    quote: str = "",
) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", NULL_MARKER)
        .option("quote", quote)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def split_lists(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Comma lists -> ``array<string>``; a null field stays null."""
    if not columns:
        return df
    return df.withColumns({c: F.split(F.col(c), ",") for c in columns})


def read_table(spark: SparkSession, base_path: str, table: str, *, quote: str = "") -> DataFrame:
    schema, file_name, lists = TABLES[table]
    path = f"{base_path.rstrip('/')}/{file_name}"
    return split_lists(read_tsv(spark, path, schema, quote=quote), lists)


def read_titles(spark, base_path, **kw):
    return read_table(spark, base_path, "titles", **kw)


def read_ratings(spark, base_path, **kw):
    return read_table(spark, base_path, "ratings", **kw)


def read_crew(spark, base_path, **kw):
    return read_table(spark, base_path, "crew", **kw)


def read_principals(spark, base_path, **kw):
    return read_table(spark, base_path, "principals", **kw)


def read_episodes(spark, base_path, **kw):
    return read_table(spark, base_path, "episodes", **kw)


def read_akas(spark, base_path, **kw):
    return read_table(spark, base_path, "akas", **kw)


def read_people(spark, base_path, **kw):
    return read_table(spark, base_path, "people", **kw)


def _field(df: DataFrame, name: str, on_unsafe: str) -> Column:
    """A column as the text of its field; null where the reader is to read null."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if not isinstance(kind, (StringType, ArrayType)):
        return c.cast("string")
    breaks = "[\\t\\n\\r\\x00]" if isinstance(kind, StringType) else "[\\t\\n\\r\\x00,]"
    lost = lambda x: (x == "") | (x == NULL_MARKER) | x.rlike(breaks)
    if on_unsafe == "null":
        clean = lambda x: F.nullif(F.nullif(F.regexp_replace(x, breaks, " "), F.lit("")), F.lit(NULL_MARKER))
        if isinstance(kind, StringType):
            return clean(c)
        return F.nullif(F.array_join(F.array_compact(F.transform(c, clean)), ","), F.lit(""))
    if isinstance(kind, StringType):
        bad, text = lost(c), c
    else:
        bad = (F.size(c) == 0) | F.exists(c, lambda x: x.isNull() | lost(x))
        text = F.array_join(c, ",")
    problem = F.concat(F.lit(f"{name}: a value that tab-separated text can't carry: "), c.cast("string"))
    return F.when(F.coalesce(bad, F.lit(False)), F.raise_error(problem)).otherwise(text)


def write_tsv(df: DataFrame, path: str, *, on_unsafe: str = "error", mode: str = "overwrite") -> None:
    """``df`` (texts, numbers, lists of texts) as headered TSV files under ``path``,
    one for each partition; ``read_tsv`` with ``split_lists`` reads the same rows."""
    if on_unsafe not in ("error", "null"):
        raise ValueError("on_unsafe is 'error' or 'null'")
    fields = [_field(df, name, on_unsafe).alias(name) for name in df.columns]
    (
        df.select(*fields)
        .write.mode(mode)
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", NULL_MARKER)
        .option("quote", "")
        .option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", "\n")
        .csv(path)
    )


def save_tsv(catalog: Catalog, base_path: str, *, on_unsafe: str = "error", mode: str = "overwrite") -> str:
    """All seven tables in the public file layout (each file a folder of parts);
    ``load_tsv`` reads the same catalogue."""
    base = base_path.rstrip("/")
    for name, df in catalog.items():
        write_tsv(df, f"{base}/{TABLES[name][1]}", on_unsafe=on_unsafe, mode=mode)
    return base


def load_tsv(spark: SparkSession, base_path: str, *, quote: str = "") -> Catalog:
    """All seven tables from ``base_path`` in the public file layout."""
    return Catalog(**{t: read_table(spark, base_path, t, quote=quote) for t in Catalog.names()})
