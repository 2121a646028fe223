"""Loader rules: null marker, permissive ints, quoting, list splitting, layouts."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.catalog import Catalog
from marquee.schemas import TABLES
from marquee.sources import (
    land_catalog,
    load_parquet,
    load_tsv,
    preview_written,
    read_table,
    read_titles,
    read_tsv,
    save_tsv,
    write_tsv,
)
from marquee.sources.tsv import split_lists

TITLES_TSV = "\n".join(
    [
        "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres",
        "t1\tmovie\t\"open only\t\"open only\t0\t2020\t\\N\t90\tDrama,Comedy",
        "t2\tmovie\t\"Quoted\" start\tx\t0\t2021\t\\N\t\\N\tDrama",
        "t3\tmovie\t\"Quoted\"\tx\t0\tbad\t\\N\t100\t\\N",
        "t4\tmovie\tmid \"q\" x\tx\t0\t\t\\N\t5\tAnimation",
        "t5\tshort\t\tx\t0\t1999\t\\N\t7\t",
    ]
)


def _write(tmp: str, name: str, text: str) -> str:
    with open(os.path.join(tmp, name), "w", encoding="utf-8") as f:
        f.write(text + "\n")
    return tmp


def test_titles_loader_rules(spark):
    tmp = tempfile.mkdtemp(prefix="tsv-")
    _write(tmp, "title.basics.tsv", TITLES_TSV)
    rows = {r.tconst: r for r in read_titles(spark, tmp).collect()}
    assert len(rows) == 5
    # quotes are data: an unclosed quote does not swallow the tab
    assert rows["t1"].primaryTitle == '"open only' and rows["t1"].runtimeMinutes == 90
    assert rows["t2"].primaryTitle == '"Quoted" start'
    assert rows["t3"].primaryTitle == '"Quoted"'
    assert rows["t4"].primaryTitle == 'mid "q" x'
    # \N and the empty field are null; a bad int is null and the row stays
    assert rows["t2"].runtimeMinutes is None and rows["t1"].endYear is None
    assert rows["t3"].startYear is None and rows["t4"].startYear is None
    assert rows["t5"].primaryTitle is None
    # genres split into arrays; null stays null
    assert rows["t1"].genres == ["Drama", "Comedy"]
    assert rows["t3"].genres is None and rows["t5"].genres is None


def test_quote_option_restores_csv_default(spark):
    tmp = tempfile.mkdtemp(prefix="tsv-")
    _write(tmp, "title.basics.tsv", TITLES_TSV)
    quoted = {r.tconst: r for r in read_titles(spark, tmp, quote='"').collect()}
    # with CSV quoting the unclosed quote swallows the following fields
    assert quoted["t1"].runtimeMinutes is None


def test_all_tables_declared_and_typed(spark):
    assert set(TABLES) == set(Catalog.names())
    tmp = tempfile.mkdtemp(prefix="tsv-")
    for name, (schema, file_name, lists) in TABLES.items():
        _write(tmp, file_name, "\t".join(schema.fieldNames()))
        df = read_table(spark, tmp, name)
        for c in lists:
            assert df.schema[c].dataType.simpleString() == "array<string>"
        assert df.count() == 0


def test_tsv_round_trip_of_mapped_testdata(spark, small_catalog):
    back = load_tsv(spark, save_tsv(small_catalog, tempfile.mkdtemp(prefix="rt-")))
    for name, df in small_catalog.items():
        other = getattr(back, name)
        assert other.dtypes == df.dtypes, name
        assert df.exceptAll(other).count() == 0, name
        assert other.exceptAll(df).count() == 0, name


ODD = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("list", T.ArrayType(T.StringType())),
        T.StructField("real", T.FloatType()),
    ]
)


def _read_odd(spark, path):
    flat = T.StructType([f if f.name != "list" else T.StructField("list", T.StringType()) for f in ODD])
    return split_lists(read_tsv(spark, path, flat), ("list",))


def test_what_tsv_can_carry_reads_back(spark):
    texts = [
        '"', '"open', '"closed"', "a\"b", " lead", "trail ", "  ", "\\", "\\n", "back\\slash\\", "\\N2", "N", "#x", "null", "é 日本 \U0001f600",
        "'", ",", "a,b", "\u00a0", "\u0085", "\u2028", "\ufeff", "x" * 100_000, "0", "-", None,
    ]
    rows = [(i, t, None if t is None or "," in t else [t, "z", t], 0.1 * i) for i, t in enumerate(texts)]
    rows += [(None, None, None, None), (-(2**31), "x", ["one"], 1e-30), (7, "x", ["\"a", "b\""], 3.4e38)] * 2
    df = spark.createDataFrame(rows, ODD).repartition(3)
    path = tempfile.mkdtemp(prefix="tsv-odd-")
    write_tsv(df, path)
    back = _read_odd(spark, path)
    assert back.count() == len(rows)
    assert df.exceptAll(back).count() == 0 and back.exceptAll(df).count() == 0


@pytest.mark.parametrize("text", ["tab\there", "line\nend", "cr\rhere", "", "\\N", "nul\x00"])
def test_what_tsv_cannot_carry_is_an_error_or_null(spark, text):
    for row in ((1, text, None, 1.0), (1, None, ["ok", text], 1.0)):
        df = spark.createDataFrame([row], ODD)
        with pytest.raises(Exception, match="tab-separated text can't carry"):
            write_tsv(df, tempfile.mkdtemp(prefix="tsv-bad-"))
        path = tempfile.mkdtemp(prefix="tsv-null-")
        write_tsv(df, path, on_unsafe="null")
        (back,) = _read_odd(spark, path).collect()
        blank = text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x00", " ")
        kept = None if text in ("", "\\N") else blank
        assert (back.text, back.list) == ((kept, None) if row[1] is not None else (None, ["ok"] + ([kept] if kept else [])))


@pytest.mark.parametrize("value", [[], ["a,b"], ["a", None], [""]])
def test_lists_that_tsv_cannot_carry(spark, value):
    df = spark.createDataFrame([(1, "x", value, 1.0)], ODD)
    with pytest.raises(Exception, match="tab-separated text can't carry"):
        write_tsv(df, tempfile.mkdtemp(prefix="tsv-bad-"))
    path = tempfile.mkdtemp(prefix="tsv-null-")
    write_tsv(df, path, on_unsafe="null")
    want = {"a,b": ["a b"], "a": ["a"], "": None}.get(value[0]) if value else None
    assert _read_odd(spark, path).first()["list"] == want


def test_on_unsafe_is_checked(spark):
    with pytest.raises(ValueError, match="on_unsafe"):
        write_tsv(spark.range(1), tempfile.mkdtemp(prefix="tsv-"), on_unsafe="drop")


def test_preview_of_a_written_result_keeps_its_order(spark, capsys):
    path = tempfile.mkdtemp(prefix="sorted-")
    # later files are larger: a scan of the folder would begin with them
    df = spark.range(0, 3000).withColumn("pad", F.repeat(F.lit("x"), (F.col("id") / 300).cast("int"))).orderBy("id")
    df.repartitionByRange(7, "id").sortWithinPartitions("id").write.mode("overwrite").parquet(path)
    preview_written(spark, path, n=900, truncate=False)
    shown = [int(line.split("|")[1]) for line in capsys.readouterr().out.splitlines() if line.startswith("|") and "id" not in line]
    assert shown == list(range(900))
    df.filter("id < 0").write.mode("overwrite").parquet(path)
    preview_written(spark, path)
    assert "id" in capsys.readouterr().out


def test_parquet_layout_equals_source(spark, small_catalog):
    from marquee.session import scratch_path

    plain = load_parquet(spark, land_catalog(small_catalog, scratch_path(spark, "plain")))
    for name, df in small_catalog.items():
        other = getattr(plain, name)
        assert df.exceptAll(other).count() == 0 and other.exceptAll(df).count() == 0, name


# table: file lines after the header, and the rows expected from its reader
FILES = {
    "ratings": (["t1\t7.5\t10", "t2\t\\N\tbad"], [("t1", 7.5, 10), ("t2", None, None)]),
    "crew": (["t1\tn1,n2\t\\N", "t2\tn3\tn3"], [("t1", "n1,n2", None), ("t2", "n3", "n3")]),
    "principals": (
        ['t1\t1\tn1\tactor\t\\N\t["A"]', "t1\tx\tn2\tdirector\tjob\t\\N"],
        [("t1", 1, "n1", "actor", None, '["A"]'), ("t1", None, "n2", "director", "job", None)],
    ),
    "episodes": (["e1\tt1\t1\t\\N", "e2\tt1\t\\N\t4"], [("e1", "t1", 1, None), ("e2", "t1", None, 4)]),
    "akas": (
        ["t1\t1\t\"Name\tUS\t\\N\t\\N\t\\N\t0", "t1\t2\t\\N\t\\N\ten\ttype\tattr\t1"],
        [("t1", 1, '"Name', "US", None, None, None, 0), ("t1", 2, None, None, "en", "type", "attr", 1)],
    ),
    "people": (
        ["n1\tAnn\t1950\t\\N\tactress,writer\tt1,t2", "n2\tBob\t\\N\t2000\t\\N\t\\N"],
        [("n1", "Ann", 1950, None, ["actress", "writer"], "t1,t2"), ("n2", "Bob", None, 2000, None, None)],
    ),
}


@pytest.mark.parametrize("table", list(FILES))
def test_each_reader_gives_its_rows(spark, table):
    import marquee.sources.tsv as tsv

    schema, name, _ = TABLES[table]
    lines, want = FILES[table]
    tmp = tempfile.mkdtemp(prefix="tsv-")
    _write(tmp, name, "\n".join(["\t".join(schema.names), *lines]))
    rows = getattr(tsv, f"read_{table}")(spark, tmp).collect()
    assert [tuple(r) for r in rows] == want
