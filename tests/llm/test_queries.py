"""The registered queries: SQL where there is one, and the pipeline's stages."""

from __future__ import annotations

import re
import zlib

import pytest

import corpus_pipeline
from marquee.llm import queries
from marquee.plans.verify import _rows, duck

from .conftest import LABELS, SF_SMALL
from .test_decontamination import least_edits, normalised
from .test_minhash import brute
from .test_pii import brute_finder


@pytest.mark.parametrize("key", list(queries.SQL))
def test_query_equals_its_sql(spark, key):
    df = queries.QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SF_SMALL).execute(queries.SQL[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert _rows(rows, df.columns) == _rows(res.fetchall(), cols)


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES] == list(range(1, 14))


def test_contract_of_the_sharding_query(spark):
    df = queries.QUERIES["op3_histogram_sort"](spark, SF_SMALL)
    assert dict(df.dtypes)["grown_shard"] == "int"
    rows = df.collect()
    assert {r.law for r in rows} == {"bytes"} and all(r.grown_shard is None for r in rows)
    assert {r.shard for r in rows} <= set(range(16))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts.items()
    }


def test_pipeline_stages(spark, sample):
    """Each stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "surrogates", "packing"]
    columns = docs.columns

    def step(name, df):
        out = stages[name](spark, df, SF_SMALL)
        assert out.columns == columns or name == "packing"
        from marquee.llm.common import written

        out = written(out, f"test-{name}")
        return out, {r["doc_id"]: r["text"] for r in out.collect()} if name != "packing" else out.collect()

    df, kept = step("quality_rules", docs)
    verdicts = duck(SF_SMALL).execute(queries.SQL["op2_risk_controlled_rules"])
    at = [c[0] for c in verdicts.description].index("kept")
    assert kept == {r[0]: sample[r[0]] for r in verdicts.fetchall() if r[at]}
    df, first = step("near_duplicates", df)
    assert set(first) == {d for d, (_, c) in brute(kept, 80).items() if c == d}
    df, clean = step("decontamination", df)
    bench = [normalised(r.text)[0] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    flat = {d: normalised(t)[0] for d, t in first.items()}
    leaking = {d for d, t in flat.items() if any(least_edits(b, t) <= len(b) * 8 // 100 for b in bench)}
    assert leaking and set(clean) == set(first) - leaking
    df, private = step("surrogates", df)
    assert set(private) == set(clean)
    found = {d: brute_finder(t) for d, t in clean.items()}
    assert sum(map(len, found.values())) > 5
    for d, entities in found.items():
        assert [k for k, _ in brute_finder(private[d])] == [k for k, _ in entities]
        assert not any(old in private[d] for _, old in entities)
    _, pieces = step("packing", df)
    assert {p.doc_id for p in pieces} == set(private)


def test_pipeline_on_empty_documents(spark, no_docs, tmp_path):
    for name, schema in (("labels", LABELS), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
