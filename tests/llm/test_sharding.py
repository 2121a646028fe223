from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marquee.llm.sharding import histogram_sort


def held(rows, shards):
    by = {k: [] for k in range(shards)}
    for r in rows:
        by[r.shard].append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    return by


def size(text):
    return len((text or "").encode()) + 1


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_bytes_are_even_with_a_hot_text(make_docs, shards):
    r = random.Random(3)
    hot = "hot " * 20
    pairs = [(i, hot if i % 3 == 0 else "x" * r.randint(0, 300)) for i in range(3000)]
    rows = histogram_sort(make_docs(pairs), shards=shards).select("doc_id", "text", "size", "shard", "slot").collect()
    assert sorted((x.doc_id, x.text) for x in rows) == sorted(pairs)
    assert all(x.size == size(x.text) for x in rows)
    sizes = [sum(x.size for x in part) for part in held(rows, shards).values()]
    mean = sum(sizes) / shards
    assert max(abs(s - mean) for s in sizes) <= 0.001 * mean + 2 * 301


def test_shards_are_ranges_of_the_order(make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(i, f"text {i % 40}") for i in range(500)])
    rows = histogram_sort(docs, shards=4).withColumn("h", F.xxhash64("text")).select("h", "doc_id", "shard", "slot").collect()
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [(r.h, r.doc_id) for r in order] == sorted((r.h, r.doc_id) for r in rows)


def test_odd_rows(odd_docs, no_docs):
    out = histogram_sort(odd_docs, shards=4)
    rows = out.collect()
    assert len(rows) == 13 and "label" in out.columns and out.columns.count("size") == 1
    held(rows, 4)
    assert all(r["size"] == size(r["text"]) for r in rows)
    assert histogram_sort(no_docs, shards=4).count() == 0


def test_repeated_identical_rows_stay_together(make_docs):
    rows = histogram_sort(make_docs([(1, "same")] * 200 + [(2, "other")]), shards=4).collect()
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    held(rows, 4)


def test_hot_rows_without_ids_are_cut(make_docs, spark, tmp_path):
    """A third of all rows has neither a doc_id nor a text; columns have the names used inside."""
    pairs = [(None, None) if i % 3 == 0 else (i, f"text {i}") for i in range(3000)]
    docs = make_docs(pairs)
    for name in ("sort_hash", "sort_id", "sort_slice", "sort_rank", "sort_place", "row_key", "__h", "__d"):
        docs = docs.withColumn(name, F.col("lang"))
    docs.write.parquet(f"{tmp_path}/docs")
    for source in (docs, spark.read.parquet(f"{tmp_path}/docs")):
        out = histogram_sort(source, shards=4)
        assert [c for c in out.columns if c not in ("size", "shard", "slot")] == [c for c in docs.columns if c != "size"]
        rows = out.collect()
        assert sorted(map(str, ((x.doc_id, x.text) for x in rows))) == sorted(map(str, pairs))
        sizes = [sum(x.size for x in part) for part in held(rows, 4).values()]
        assert max(sizes) - min(sizes) <= 0.002 * sum(sizes) / 4 + 20
        assert all(x["__h"] == x.lang == x.sort_rank for x in rows)


def test_probes_grow_with_the_slices_only(monkeypatch):
    """10 TB of even keys in 16 shards, slices of 64 MB: the driver's probes."""
    from marquee.llm import sharding

    total, top = 10 * 10**12, 1 << 128

    def even(_, probes):
        edges = [0, *probes, top]
        return [
            {"at": i, "bytes": (b - a) * total // top, "n": (b - a) * 10**9 // top, "least": parts(a), "most": parts(b - 1)}
            for i, (a, b) in enumerate(zip(edges, edges[1:]))
        ]

    parts = lambda k: ((k >> 64) - (1 << 63), (k & ((1 << 64) - 1)) - (1 << 63))
    monkeypatch.setattr(sharding, "_histogram", even)
    cuts, known = sharding.splitters(None, 16, 0.001, 64 << 20, 64)
    assert len(cuts) == 15 and len(known.below) < 600_000
    sizes = [known.below[c][0] for c in cuts]
    assert all(abs(s - total * (k + 1) / 16) <= 0.001 * total / 16 for k, s in enumerate(sizes))
    edges = sorted(v[0] for v in known.below.values())
    assert max(b - a for a, b in zip(edges, edges[1:])) <= 64 << 20
