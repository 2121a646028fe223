from __future__ import annotations

import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from marquee.llm import queries
from marquee.llm.quality_rules import CHAIN, RULES, binomial_tail, cutoffs, keep_good, quality_verdicts, with_measures

from .conftest import LABELS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_shouts": text.count("!"),
        "n_distinct_words": len(set(words)),
    }


def test_measures_equal_brute_force(spark, make_docs, odd_docs, sample):
    texts = dict(sample)
    texts |= {
        10_000: "a b c d e f g h " * 5, 10_001: "x " * 30, 10_002: "one two\none two\n\n \nthree\x0bfour\x85five",
        10_003: "# * $$ %% & | <> !!", 10_004: "a b c d e f g h i a b c d e f g h j k b c d e f g h i a",
    }
    rows = with_measures(make_docs(texts.items())).collect()
    assert {r.doc_id: r["__measures"].asDict() for r in rows} == {d: measures(t) for d, t in texts.items()}
    assert all(r["__measures"].asDict() == measures(r.text) for r in with_measures(odd_docs).collect())


@pytest.mark.parametrize("p", [0.01, 0.05])
def test_binomial_tail_is_exact(spark, p):
    cases = [(n, k) for n in (1, 10, 500, 3000, 200_000) for k in (0, 1, 3, 20, int(n * p * 0.8)) if k < n * p]
    df = spark.createDataFrame(cases, "n long, k long").withColumn("tail", binomial_tail(F.col("n"), F.col("k"), p))
    for r in df.collect():
        terms = (
            math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(p) + (r.n - i) * math.log1p(-p)
            for i in range(r.k + 1)
        )
        assert r.tail == pytest.approx(sum(map(math.exp, terms)), rel=1e-6)
    at_mean = spark.createDataFrame([(100, 50)], "n long, k long").select(binomial_tail(F.col("n"), F.col("k"), p)).first()[0]
    assert at_mean == 1.0


def graded(spark, n_good, n_over, lang="en"):
    """Good documents of which ``n_over`` have a symbol rate of 0.4."""
    zero = {m: 0 for m in measures("")}
    rows = [(i, lang, {**zero, "n_words": 100, "word_chars": 500, "n_distinct_words": 90, "n_symbols": 40 if i < n_over else 0}) for i in range(n_good)]
    schema = "doc_id long, stratum string, measures struct<" + ",".join(f"{k}:bigint" for k in zero) + ">"
    return spark.createDataFrame([(d, s, tuple(m.values())) for d, s, m in rows], schema)


def test_cutoffs_follow_the_labels(spark):
    n = 3000
    labels = spark.createDataFrame([(i, 1, 0) for i in range(n)], LABELS)
    few = cutoffs(graded(spark, n, 3), labels).first()
    assert few["symbol_rate"] == 0.05  # 3 of 3000 is well under 1 %
    many = cutoffs(graded(spark, n, 300), labels).first()
    assert many["symbol_rate"] == 0.5  # the grid stops before 0.35 rejects 10 %
    assert many["shout_rate"] == 0.05
    none = cutoffs(graded(spark, 100, 0), labels).first()
    assert all(none[r] is None for r in RULES)  # too few labels to guarantee 1 %


def test_chain_needs_fewer_labels(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], LABELS)
    assert sorted(CHAIN) == sorted(RULES)
    # 0.99 ** 400 = 0.018, under 0.05 / 2 but over 0.05 / 7
    clean = cutoffs(graded(spark, 400, 0), labels).first()
    assert all(clean[r] == RULES[r][3][-1] for r in RULES)
    # 1 % break 0.35: the chain ends there, after the most lenient cutoff of each rule
    stopped = cutoffs(graded(spark, 400, 4), labels).first()
    assert all(stopped[r] == (0.5 if r == "symbol_rate" else RULES[r][3][0]) for r in RULES)


def test_false_rejection_is_limited(spark):
    """Cutoffs learned on one sample reject at most the risk of fresh good ones."""
    import random

    r = random.Random(1)
    zero = {m: 0 for m in measures("")}
    make = lambda: {**zero, "n_words": 100, "word_chars": 500, "n_distinct_words": 90, "n_symbols": int(r.expovariate(1 / 4))}
    schema = "doc_id long, stratum string, measures struct<" + ",".join(f"{k}:bigint" for k in zero) + ">"
    docs = spark.createDataFrame([(i, "en", tuple(make().values())) for i in range(4000)], schema)
    cut = cutoffs(docs, spark.createDataFrame([(i, 1, 0) for i in range(4000)], LABELS)).first()["symbol_rate"]
    fresh = [make()["n_symbols"] / 100 for _ in range(20_000)]
    assert sum(x > cut for x in fresh) / len(fresh) <= 0.01


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0)], LABELS)
    rows = quality_verdicts(odd_docs, labels).collect()
    assert len(rows) == 13
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1].base_failed and not by[1].kept and by[1].n_words == 0 and by[5].kept and not by[10].kept
    kept = keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 4, 5, 6, 7]
    empty = spark.createDataFrame([], LABELS)
    assert quality_verdicts(no_docs, empty).count() == 0
    assert quality_verdicts(odd_docs, empty).filter("kept").count() == 5


def test_sql_agrees_where_cutoffs_are_certified(spark, tmp_path):
    """Labels enough for both halves of the error in one language, for the chain
    only in a second and for nothing in a third; documents on both sides of the cutoffs."""
    r = random.Random(4)
    docs, labels = [], []

    def text(kind):
        words = [f"{r.choice('abcdefg')}ord{r.randint(0, 999)}" for _ in range(40)]
        if kind == "symbols":
            words = [w + r.choice(["", "#", "*$"]) for w in words]
        if kind == "shouts":
            words = [w + "!" * r.randint(0, 1) for w in words]
        if kind == "long":
            words = [w * 3 for w in words]
        if kind == "few":
            words = [r.choice(words[:5]) + str(i % 2) for i in range(40)]
        if kind == "lines":
            words = [*words, "\nsame line", "\nsame line", "\nsame line"]
        if kind == "repeats":
            words = words + words[:9]
        return " ".join(words)

    for lang, n in (("aa", 900), ("bb", 640), (None, 60)):
        for _ in range(n):
            labels.append((len(docs), 1, 0))
            docs.append((len(docs), text("long" if lang == "bb" and r.random() < 0.3 else "plain"), lang, "s", 1))
        for kind in ("symbols", "shouts", "long", "few", "lines", "repeats", "plain"):
            for _ in range(25):
                docs.append((len(docs), text(kind), lang, "s", 1))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    df = queries.QUERIES["op2_risk_controlled_rules"](spark, str(tmp_path))
    got = sorted(map(tuple, df.collect()))
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    found = con.execute(queries.SQL["op2_risk_controlled_rules"])
    assert [c[0] for c in found.description] == df.columns and sorted(found.fetchall()) == got

    measured = with_measures(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    measured = measured.select("doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), F.col("__measures").alias("measures"))
    limits = {x.stratum: x.asDict() for x in cutoffs(measured, spark.createDataFrame(labels, LABELS)).collect()}
    certified = {lang: sum(limits[lang][rule] is not None for rule in RULES) for lang in limits}
    assert certified["aa"] >= 5 and 1 <= certified["bb"] <= certified["aa"] and certified[""] == 0
    kept, base = df.columns.index("kept"), df.columns.index("base_failed")
    assert sum(not x[kept] and not x[base] for x in got) > 100
    # what the pipeline's first stage keeps is the same
    rows = keep_good(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert {x.doc_id for x in rows.collect()} == {x[0] for x in got if x[kept]}
