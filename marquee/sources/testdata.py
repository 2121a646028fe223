"""The driver's TPC-H-style tables, shaped as the seven catalogue tables.

An order plays a title, a line item a credit / episode / alias, a supplier or a
customer a person. The mapping is fixed (the DuckDB oracle builds the same rows
from the same parquet files, see ``plans.oracle``), so every value rule below is
part of the contract.

Everything is lazy: a question that reads only ``ratings`` scans only the two
``lineitem`` columns it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Catalog


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _key(prefix: str, c: str | Column) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    base = sf_dir.rstrip("/")
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    return {n: spark.read.parquet(f"{base}/{n}.parquet") for n in names}


def order_genres(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Sorted distinct part types of an order's line items (orders without a
    matching part get no row, hence null genres after the left join)."""
    parts = part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return (
        lineitem.select("l_orderkey", "l_partkey")
        .join(parts, "l_partkey")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sort_array(F.collect_set("p_type")).alias("genres"))
    )


def titles(t: dict[str, DataFrame]) -> DataFrame:
    o = t["orders"]
    prio = F.col("o_orderpriority")
    return o.join(order_genres(t["lineitem"], t["part"]), "o_orderkey", "left").select(
        _key("tt", "o_orderkey").alias("tconst"),
        F.when(F.col("o_orderstatus") == "F", "movie")
        .when(F.col("o_orderstatus") == "O", "tvSeries")
        .otherwise("tvEpisode")
        .alias("titleType"),
        F.concat(F.lit("Title "), (F.col("o_orderkey") % 5000).cast("string")).alias("primaryTitle"),
        _key("Title ", "o_orderkey").alias("originalTitle"),
        F.lit(0).alias("isAdult"),
        F.year("o_orderdate").cast("int").alias("startYear"),
        _null("int").alias("endYear"),
        F.when(prio == "4-NOT SPECIFIED", _null("int"))
        .otherwise(F.floor(F.col("o_totalprice") / 2000).cast("int"))
        .alias("runtimeMinutes"),
        "genres",
    )


def ratings(t: dict[str, DataFrame]) -> DataFrame:
    q = F.col("l_quantity")
    return t["lineitem"].groupBy("l_orderkey").agg(
        (F.floor(2 * F.avg(q)) / 10).cast("float").alias("averageRating"),
        # integral-valued sums; round like a SQL numeric -> int cast
        F.round(F.sum(q)).cast("int").alias("numVotes"),
    ).select(_key("tt", "l_orderkey").alias("tconst"), "averageRating", "numVotes")


def principals(t: dict[str, DataFrame]) -> DataFrame:
    rf = F.col("l_returnflag")
    return t["lineitem"].select(
        _key("tt", "l_orderkey").alias("tconst"),
        F.col("l_linenumber").alias("ordering"),
        _key("nms", "l_suppkey").alias("nconst"),
        F.when(rf == "A", "actor").when(rf == "R", "actress").otherwise("director").alias("category"),
        _null("string").alias("job"),
        _null("string").alias("characters"),
    )


def crew(t: dict[str, DataFrame]) -> DataFrame:
    prio = F.col("o_orderpriority")
    cust = _key("nmc", "o_custkey")
    return t["orders"].select(
        _key("tt", "o_orderkey").alias("tconst"),
        F.when(prio == "1-URGENT", F.concat(cust, F.lit(",nms0"))).otherwise(cust).alias("directors"),
        F.when(prio == "5-LOW", _null("string"))
        .when(prio == "2-HIGH", F.concat(cust, F.lit(",nms1")))
        .otherwise(cust)
        .alias("writers"),
    )


def _person_cols(prefix: str, key: str, name: str, professions: Column) -> list[Column]:
    k = F.col(key)
    return [
        _key(prefix, key).alias("nconst"),
        F.col(name).alias("primaryName"),
        F.when(k % 10 != 9, (1940 + k % 60).cast("int")).alias("birthYear"),
        F.when(k % 7 == 0, F.lit(2000)).alias("deathYear"),
        F.split(professions, ",").alias("primaryProfession"),
        _null("string").alias("knownForTitles"),
    ]


def people(t: dict[str, DataFrame]) -> DataFrame:
    s = F.col("s_suppkey") % 4
    supplier_prof = (
        F.when(s == 0, "actor")
        .when(s == 1, "actor,producer")
        .when(s == 2, "actress,writer")
        .otherwise("director,writer")
    )
    c = F.col("c_custkey") % 3
    customer_prof = F.when(c == 0, "director").when(c == 1, "writer").otherwise("director,writer")
    return t["supplier"].select(*_person_cols("nms", "s_suppkey", "s_name", supplier_prof)).unionByName(
        t["customer"].select(*_person_cols("nmc", "c_custkey", "c_name", customer_prof))
    )


def episodes(t: dict[str, DataFrame]) -> DataFrame:
    return t["lineitem"].select(
        F.concat(F.lit("ep"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "tconst"
        ),
        _key("tt", "l_orderkey").alias("parentTconst"),
        F.col("l_linenumber").alias("seasonNumber"),
        F.when(F.col("l_returnflag") != "N", F.floor("l_quantity").cast("int")).alias("episodeNumber"),
    )


def akas(t: dict[str, DataFrame]) -> DataFrame:
    # supplier -> region name is a dimension chain; resolve it before touching
    # the line items so the big side joins once, on l_suppkey.
    supplier_region = (
        t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        .join(t["nation"].select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), "n_nationkey")
        .join(t["region"].select("r_regionkey", "r_name"), "r_regionkey")
        .select("l_suppkey", "r_name")
    )
    r = F.col("r_name")
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_linestatus", "l_suppkey").join(
        supplier_region, "l_suppkey"
    ).select(
        _key("tt", "l_orderkey").alias("titleId"),
        F.col("l_linenumber").alias("ordering"),
        F.when(F.col("l_linestatus") == "F", _key("aka ", "l_orderkey")).alias("title"),
        F.when(r == "AMERICA", "US").when(r == "EUROPE", "UA").otherwise(r).alias("region"),
        _null("string").alias("language"),
        _null("string").alias("types"),
        _null("string").alias("attributes"),
        F.lit(0).alias("isOriginalTitle"),
    )


def load_testdata(spark: SparkSession, sf_dir: str) -> Catalog:
    t = _tables(spark, sf_dir)
    return Catalog(
        titles=titles(t),
        ratings=ratings(t),
        crew=crew(t),
        principals=principals(t),
        episodes=episodes(t),
        akas=akas(t),
        people=people(t),
    )
