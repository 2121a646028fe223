from __future__ import annotations

import numpy as np
import pytest

from marquee.llm import queries, whitening
from marquee.llm.whitening import whitened

from .conftest import SF_SMALL

EMBEDDINGS = "vec_id long, embedding array<float>, label string, n string, component string, part string, block string"


def brute(vectors, components=16, scale=64, shift=1_000_000):
    """{component: (explained, {row: whitened})} and per row the deviation, by numpy."""
    x = np.floor(scale * np.asarray(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + shift
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    v = (u - s / n).T @ (u - s / n) / n
    e, w = np.linalg.eigh(v)
    order = [i for i in np.argsort(-e) if e[i] > 1e-12 * e.max()][:components]
    z = (x - s / n) @ w[:, order] / np.sqrt(e[order])
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x], z, e[order] / np.trace(v)


def compare(rows, ids, vectors, components=16):
    n, deviation, z, explained = brute(vectors, components)
    assert len(rows) == z.size and {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-4
    at = {i: k for k, i in enumerate(ids)}
    got = np.full(z.shape, np.nan)
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    assert np.abs(got * np.sign((got * z).sum(axis=0)) - z).max() < 1e-7


def table(spark, pairs):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x", "x") for i, v in pairs], EMBEDDINGS).repartition(3)


def test_query_equals_numpy(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    pairs = [(r.vec_id, r.embedding) for r in df.collect()]
    compare(queries.QUERIES["op13_block_whitening"](spark, SF_SMALL).collect(), *zip(*pairs))


@pytest.mark.parametrize("slices", [1, 4096])
def test_copies_are_fitted_once_and_blocks_and_slices_add_up(spark, monkeypatch, slices):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 30)
    monkeypatch.setattr(whitening, "SLICE", slices)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(23, 6)) * [9, 4, 2, 1, 0.5, 3]
    vectors = [base[min(k, 22) if k < 30 else 0].tolist() for k in range(45)]  # a hot vector
    out = whitened(table(spark, enumerate(vectors)), components=4).collect()
    compare(out, list(range(45)), vectors, 4)


def test_odd_vectors(spark):
    rng = np.random.default_rng(6)
    good = [rng.normal(size=4).tolist() for _ in range(12)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [1.0, None, 0.0, 0.0], [nan, 0.0, 0.0, 0.0], [inf, 0.0, 0.0, 0.0], [-inf, 0.0, 0.0, 0.0], [1e30, 0.0, 0.0, 0.0], [1.0], []]
    pairs = [*enumerate(good), *((100 + k, v) for k, v in enumerate(bad)), (2**62 + 1, good[0]), (3, good[3])]
    rows = whitened(table(spark, [*pairs, (None, good[1])])).collect()
    assert {r.vec_id for r in rows} == {*range(12), 2**62 + 1, None} and len(rows) == 15 * 4
    assert sorted(r.whitened for r in rows if r.vec_id is None) == sorted(r.whitened for r in rows if r.vec_id == 1)
    n, deviation, _, explained = brute(good)
    assert {r.n for r in rows} == {n} and {r.deviation for r in rows if r.vec_id == 5} == {deviation[5]}
    assert [r.explained for r in rows if r.vec_id == 5] == pytest.approx(explained.tolist())


def test_large_entries_keep_exact_deviations(spark):
    vectors = [[1e6, 0.0], [-1e6, 1.0], [0.0, 3.0]]
    _, deviation, _, _ = brute(vectors)
    rows = whitened(table(spark, enumerate(vectors))).collect()
    assert {r.vec_id: r.deviation for r in rows} == dict(enumerate(deviation))
    huge = whitened(table(spark, enumerate([[1e12, 0.0], [-1e12, 1.0], [0.0, 3.0]]))).collect()
    assert {r.deviation for r in huge if r.vec_id < 2} == {None}


def test_flat_and_empty_tables(spark):
    assert whitened(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitened(table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitened(table(spark, [(1, None), (2, [])])).count() == 0
    none = whitened(table(spark, []).filter("false"))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = whitened(table(spark, [(k, [float(k), 1.0]) for k in range(5)])).collect()
    assert {r.component for r in flat} == {1} and flat[0].explained == pytest.approx(1.0)
