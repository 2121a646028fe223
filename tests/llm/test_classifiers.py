from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from marquee.llm import ranking, toxicity
from marquee.llm.ranking import ranked_quality
from marquee.llm.toxicity import present, ratios, toxicity_scores

from .conftest import LABELS

SF = "/root/testdata/sf0.01"


def auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    a, b = s[y == 1], s[y == 0]
    return ((a[:, None] > b).sum() + 0.5 * (a[:, None] == b).sum()) / (len(a) * len(b))


def held(docs_rows, labels, column, folds, remainder):
    y = {r.doc_id: r[column] for r in labels.collect()}
    for r in docs_rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == remainder)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    rows = [r for r in docs_rows if r.held_out and r.doc_id in y]
    return [y[r.doc_id] for r in rows], [r.score for r in rows]


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = ranked_quality(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()
    assert len(rows) == 1000
    assert auc(*held(rows, labels, "quality", 5, 0)) > 0.95


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity_scores(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()
    assert len(rows) == 1000
    assert auc(*held(rows, labels, "toxic", 4, 2)) > 0.8  # some 30 toxic rows to learn from


def test_held_out_labels_play_no_part(spark, make_docs):
    r = random.Random(0)
    docs = make_docs([(i, " ".join(r.choice(["good", "fine", "bad##", "###"]) for _ in range(30 + i % 7))) for i in range(200)])
    rows = [(i, i % 2, (i // 2) % 2) for i in range(200)]
    flip = lambda folds, k: [(i, q if zlib.crc32(str(i).encode()) % folds != k else 1 - q, t if zlib.crc32(str(i).encode()) % folds != k else 1 - t) for i, q, t in rows]
    key = lambda r: r.doc_id
    for score, folds, k in ((ranked_quality, 5, 0), (toxicity_scores, 4, 2)):
        a = sorted(score(docs, spark.createDataFrame(rows, LABELS)).collect(), key=key)
        b = sorted(score(docs, spark.createDataFrame(flip(folds, k), LABELS)).collect(), key=key)
        assert [x.score for x in a] == pytest.approx([x.score for x in b])


def test_bradley_terry_prefers_and_cuts_at_the_quantile():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(ranking.FEATURES)))
    y = (x[:, 3] + 0.3 * rng.normal(size=400) > -0.8).astype(int)
    model = ranking.fit(x, y, share0=float((y == 0).mean()))
    s = model.strength(x)
    assert auc(y, s) > 0.95 and np.corrcoef(s, x[:, 3])[0, 1] > 0.8
    assert (s < model.cut).mean() == pytest.approx((y == 0).mean(), abs=0.01)


def every_pair(x, y, ridge=1e-3):
    """Design and weights from a list of all preference pairs."""
    scale = x.std(axis=0)
    z = np.clip((x - x.mean(axis=0)) / np.where(scale > 1e-9, scale, 1.0), -8, 8)
    d = np.hstack([z, z * z / 8])
    diff = (d[y == 1][:, None] - d[y == 0][None]).reshape(-1, d.shape[1])
    w = np.zeros(d.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-diff @ w))
        w += np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(w)), diff.T @ (1 - p) / len(diff) - ridge * w)
    return d, w, float(np.logaddexp(0, -diff @ w).sum())


@pytest.mark.parametrize("bad", [0.05, 0.5])
def test_weights_and_loss_are_those_of_every_pair(bad):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(ranking.FEATURES)))
    x[:, 5] = 1.0  # says nothing
    x[200:260] = x[100]  # copies, with both labels
    y = (x[:, 3] + rng.normal(size=400) > np.quantile(x[:, 3], bad)).astype(int)
    d, w, loss = every_pair(x, y)
    model = ranking.fit(x, y, share0=float((y == 0).mean()))
    assert np.abs(model.weights - w).max() < 1e-6
    assert model.cut == np.sort(model.strength(x))[(y == 0).sum() - 1]
    model.weights = w
    assert ranking.Cells(ranking.Cells.measure(model)(x, y), len(w)).loss == pytest.approx(loss, rel=1e-12)


def test_quality_is_learned_from_every_labelled_document(spark, make_docs):
    r = random.Random(4)
    words = ["good", "fine", "Bad##", "longer-words-here", "a,", "7"]
    rows = []  # (doc_id, text, label): more good ones than the 6000 once looked at
    for i in range(8600):
        label = int(i % 25 > 0)
        rows.append((i, " ".join(r.choice(words[: 4 + label * (i % 3)] if r.random() < 0.9 else words) for _ in range(4 + i % 9)), label))
    docs = make_docs([row[:2] for row in rows])
    labels = spark.createDataFrame([(i, label, 0) for i, _, label in rows], LABELS)
    x = np.array([ranking.features(t) for _, t, _ in rows])
    y = np.array([label for *_, label in rows])
    known = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i, *_ in rows])
    assert (y[known] == 1).sum() > 6000
    model = ranking.fit(x[known], y[known], share0=float((y[known] == 0).mean()))
    want = model.strength(x) - model.cut + math.log(0.3 / 0.7)
    got = {row.doc_id: row for row in ranked_quality(docs, labels).collect()}
    logit = np.array([math.log(got[i].score / (1 - got[i].score)) for i in range(len(rows))])
    assert np.abs(logit - want).max() < 1e-6
    # at the quantile: as many below the cut as there are documents of label 0, but for ties
    below = sum(1 - got[i].predicted for i in np.flatnonzero(known))
    at = (np.abs(want[known] - math.log(0.3 / 0.7)) < 1e-9).sum()
    assert below < (y[known] == 0).sum() <= below + at


def test_present_equals_a_plain_set_of_ngrams():
    text = "Straße ABC abc \U0001f600" * 5
    low = text.lower()
    grams = {low[i : i + n] for n in toxicity.ORDERS for i in range(len(low) - n + 1)}
    assert len(present(text, 24)) == len(grams)  # no collision at 24 bits here
    assert (present(text, 24, block=7) == present(text, 24)).all()
    assert len(present("ab", 20)) == 0 and len(present(None, 20)) == 0


def test_ratios_are_log_count_ratios_beyond_noise(spark):
    counts = spark.createDataFrame([(0, 100, 100), (1, 0, 60), (2, 5, 1), (3, 0, 1), (4, 900, 2)], "feature long, n0 long, n1 long")
    r = {x.feature: x.r for x in ratios(counts, 1000, 100).collect()}
    assert set(r) == {0, 1, 4}  # 2 and 3 are within the noise of their counts
    assert r[0] == pytest.approx(math.log(101 / 102) - math.log(101 / 1002)) and r[1] > 3 and r[4] < -3


def test_fit_is_the_ridge_penalised_minimum():
    rng = np.random.default_rng(1)
    x = rng.random((60, 8)) < 0.4
    x[5] = False  # a document without features
    r = np.concatenate([rng.normal(size=8), [0.0]])
    y = (x @ r[:8] + 0.5 * rng.normal(size=60) > 0).astype(float)
    weight, b = toxicity.fit([np.flatnonzero(row).astype(np.uint32) for row in x], y, r, ridge=1.0, steps=3000)
    design = x * r[:8]
    w = weight[:8] / r[:8]
    p = 1 / (1 + np.exp(-(design @ w + b)))
    assert np.abs(design.T @ (p - y) + w).max() < 1e-4 and abs((p - y).sum()) < 1e-4


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 1), (None, 1, 1), (9, None, None), (4, 1, 0)], LABELS)
    nothing = spark.createDataFrame([], LABELS)
    for score in (ranked_quality, toxicity_scores):
        for known in (labels, nothing):
            rows = score(odd_docs, known).collect()
            assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
            assert not any(r.held_out for r in rows if r.doc_id is None)
        assert len({r.score for r in score(odd_docs, nothing).collect()}) == 1
        assert score(no_docs, labels).count() == 0
