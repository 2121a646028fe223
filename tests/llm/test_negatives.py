from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import negatives
from marquee.llm.common import Scratch
from marquee.llm.negatives import Codebooks, MultiIndex, _codebook, cells_to_visit, hard_negatives, multi_sequence
from marquee.llm.vectors import integer_vectors

EMBEDDINGS = "vec_id long, embedding array<float>, label int, cell string, block string, score string, i string"
ANCHOR = "vec_id % 10 = 0"


def brute(rows, positives=5, count=5, low=80):
    """rows: (vec_id, label, integer vector)."""
    out = []
    for a, label, z in rows:
        if a % 10:
            continue
        scored = sorted(((-int(np.dot(z.astype(object), y.astype(object))), i, l) for i, l, y in rows if i != a))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            window = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= 100 * -s]
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(window[:count])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(v), l, "x", "x", "x", "x") for i, l, v in rows], EMBEDDINGS).repartition(3)


def integers(rows, scale=256):
    return [(i, l, np.floor(scale * np.asarray(v, dtype=np.float32).astype(np.float64)).astype(np.int64)) for i, l, v in rows]


def clustered(rng, n, d=8):
    centres = rng.normal(size=(6, d))
    return [(i, int(rng.integers(0, 4)), (centres[i % 6] + 0.3 * rng.normal(size=d)).tolist()) for i in range(n)]


def found(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("shape", ["usual", "small"])
def test_equals_brute_force_with_a_hot_vector(spark, monkeypatch, shape):
    if shape == "small":  # many cells, blocks, batches, groups and rounds
        for name, value in dict(CELL_ROWS=4, BLOCK=5, BATCH=3, GROUP=2, FIRST_ROUND=16, GROWTH=3).items():
            monkeypatch.setattr(negatives, name, value)
    rows = clustered(np.random.default_rng(1), 260)
    rows = [(i, l, rows[7][2] if i % 3 == 0 else v) for i, l, v in rows]  # a third has one vector: ties
    want = brute(integers(rows))
    assert want and found(hard_negatives(table(spark, rows), ANCHOR)) == want


def test_odd_rows(spark):
    rows = clustered(np.random.default_rng(2), 60)
    nan, inf = float("nan"), float("inf")
    bad = [(1000, 1, None), (1010, 1, [nan] * 8), (1020, 1, [1.0, None, *[0.0] * 6]), (1030, 1, [inf] * 8), (1040, 1, [1.0]),
           (1050, 1, []), (1060, 1, [1e30] * 8), (1070, None, [0.1] * 8), (None, 1, [0.1] * 8), (20, 9, [5.0] * 8), (7, rows[7][1], rows[7][2])]
    lonely = [(500, 77, [1.0] * 8), (510, 78, [-1.0] * 8), (511, 78, [1.0] * 8)]  # no positive; a negative positive score
    assert found(hard_negatives(table(spark, rows + bad + lonely), ANCHOR)) == brute(integers(rows + lonely))


def test_large_entries_are_scored_exactly(spark):
    rows = [(i, i % 2, [16000.0 + i, 16000.0 - i, 0.001 * i]) for i in range(40)]
    assert found(hard_negatives(table(spark, rows), ANCHOR)) == brute(integers(rows))


@pytest.mark.parametrize("rows", [[], [(0, 1, [1.0, 2.0])], [(0, 1, None)], [(0, None, [1.0])], [(0, 1, [1.0]), (1, 1, [1.0])]])
def test_tables_without_results(spark, rows):
    assert found(hard_negatives(table(spark, rows) if rows else table(spark, [(0, 1, [1.0])]).filter("false"), ANCHOR)) == []


def test_one_dimension(spark):
    rows = [(i, i % 3, [i / 7.0]) for i in range(30)]
    assert found(hard_negatives(table(spark, rows), ANCHOR)) == brute(integers(rows))


def test_heap_gives_all_pairs_by_falling_sum():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-9, 9, 13).astype(float), rng.integers(-9, 9, 7).astype(float)
    got = list(multi_sequence(a, b))
    assert sorted((i, j) for _, i, j in got) == [(i, j) for i in range(13) for j in range(7)]
    assert [s for s, _, _ in got] == sorted((a[:, None] + b).ravel(), reverse=True)
    assert all(s == a[i] + b[j] for s, i, j in got)


def test_bounds_hold_all_scores_and_stop_early():
    """On separated clusters the certified stop leaves most cells unvisited."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(2, 8, 4)) * 400
    z = np.concatenate([centres[0][rng.integers(0, 8, 2000)], centres[1][rng.integers(0, 8, 2000)]], axis=1)
    z = np.floor(z + rng.normal(size=z.shape) * 4)
    books = Codebooks(_codebook(z[:, :4], 8), _codebook(z[:, 4:], 8))
    (i, r1), (j, r2) = books.assigned(z)
    books.radii = [np.array([r[own == k].max(initial=0) for k in range(8)]) for own, r in ((i, r1), (j, r2))]
    books.rows = np.zeros((8, 8), dtype=np.int64)
    np.add.at(books.rows, (i, j), 1)
    anchors = z[:20]
    (low1, high1), (low2, high2) = books.bounds(anchors)
    visited = 0
    for a in range(20):
        scores = z @ anchors[a]
        assert (scores <= high1[a][i] + high2[a][j]).all() and (scores >= low1[a][i] + low2[a][j]).all()
        need = np.sort(scores)[-5]
        cells = set(cells_to_visit(books, [low1[a], low2[a]], [high1[a], high2[a]], need, np.inf, 0, 10**9))
        assert {(i[k], j[k]) for k in np.flatnonzero(scores >= need)} <= cells
        in_rounds = [cells_to_visit(books, [low1[a], low2[a]], [high1[a], high2[a]], need, np.inf, d, b) for d, b in ((0, 100), (100, 300), (300, 10**9))]
        assert len(sum(in_rounds, [])) == len(cells) and set(sum(in_rounds, [])) == cells
        visited += len(cells)
    assert visited < 0.4 * 20 * (books.rows > 0).sum()


def test_every_row_is_indexed(spark):
    rows = clustered(np.random.default_rng(5), 200)
    usable, d = integer_vectors(table(spark, rows), key="vec_id", vector="embedding", scale=256, shift=0, below=1e9, keep=("label",))
    index = MultiIndex(usable, d, Scratch(spark))
    assert index.blocks.agg(F.sum("n")).first()[0] == 200 == index.books.rows.sum()
    ids = [i for r in index.blocks.collect() for i in np.frombuffer(r.ids, "<i8").tolist()]
    assert sorted(ids) == list(range(200))
