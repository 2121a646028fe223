"""The two classifiers' whole queries against plain versions that share no code with them."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from marquee.llm import queries
from marquee.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return docs, labels


def logistic(x, y, ridge, steps=60):
    """Weights and unpenalised bias of the ridge-penalised logistic regression, by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-9)
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ w))
        hess = (design * (p * (1 - p) + 1e-12)[:, None]).T @ design + np.diag(penalty)
        w -= np.linalg.solve(hess, design.T @ (p - y) + penalty * w)
    return w[:-1], w[-1]


def test_toxicity_equals_a_plain_version(spark, given):
    docs, labels = given
    grams = {d: {t.lower()[i : i + n] for n in (3, 4, 5, 6) for i in range(len(t) - n + 1)} if (t := docs[d]) else set() for d in docs}
    train = sorted(d for d, r in labels.items() if d in docs and r.toxic is not None and zlib.crc32(str(d).encode()) % 4 != 2)
    y = np.array([labels[d].toxic for d in train], dtype=float)
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    c0, c1 = Counter(), Counter()
    for d, label in zip(train, y):
        (c1 if label else c0).update(grams[d])
    ratio = {}
    for g in {*c0, *c1}:
        a, b = c0[g], c1[g]
        if a + b > 2:
            r = math.log((b + 1) / (n1 + 2)) - math.log((a + 1) / (n0 + 2))
            if abs(r) >= 4 * math.sqrt(1 / (b + 1) + 1 / (a + 1)):
                ratio[g] = r
    names = sorted(ratio)
    at = {g: k for k, g in enumerate(names)}
    row = lambda d: np.array([ratio[g] if g in grams[d] else 0.0 for g in names])
    assert len(at) > 20
    w, bias = logistic(np.stack([row(d) for d in train]), y, 1.0)
    want = {d: 1 / (1 + math.exp(-max(-60.0, min(60.0, float(row(d) @ w) + bias)))) for d in docs}
    # at 24 bits, where hashed n-grams hardly meet; the query's 20 are compared by what they decide
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    rows = toxicity_scores(read("documents"), read("labels"), folds=4, held=2, threshold=0.3, bits=24).collect()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3)
    gap = np.array([abs(r.score - want[r.doc_id]) for r in rows])
    # the fit's steps end a little before the minimum
    assert np.quantile(gap, 0.95) < 0.03 and gap.mean() < 0.01
    assert sum((want[r.doc_id] >= 0.3) == bool(r.predicted) for r in rows) >= 0.99 * len(rows)
    query = queries.QUERIES["op6_char_ngram_toxicity"](spark, SF).collect()
    assert sum((want[r.doc_id] >= 0.3) == bool(r.predicted) for r in query) >= 0.95 * len(rows)


def plain_features(text):
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * 24
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = [c / len(raw) for c in Counter(raw).values()]
    of = lambda keep: sum(1 for b in raw if keep(b))
    upper, wide = of(lambda b: 65 <= b < 91), of(lambda b: b > 127)
    letters = upper + of(lambda b: 97 <= b < 123) + wide
    mark = lambda b: 33 <= b < 127 and not chr(b).isalnum()
    kinds = Counter(words)
    return [
        math.log1p(n), math.log1p(len(raw)), sum(map(len, words)) / n, sum(len(w) > 12 for w in words) / n, sum(len(w) < 3 for w in words) / n,
        len(kinds) / n, len({tuple(words[i : i + 3]) for i in range(n - 2)}) / max(1, n - 2), sum(words[i] == words[i + 1] for i in range(n - 1)) / n,
        max(kinds.values()) / n, 1 - len(set(lines)) / len(lines), math.log1p(n / len(lines)), upper / max(1, letters),
        of(lambda b: 48 <= b < 58) / len(raw), wide / len(raw), raw.count(b".") / n, raw.count(b",") / n, raw.count(b"!") / n, raw.count(b"|") / n,
        of(lambda b: b in b"#*$%&|<>=~^_@/\\{}[]") / n, of(mark) / len(raw), -sum(s * math.log(s) for s in share),
        sum(mark(b) and b == a for a, b in zip(raw, raw[1:])) / n,
        sum(1 for w in kinds if not w[-1:].isalnum() and w[-1] < 128) / len(kinds), raw.count(b" ") / len(raw),
    ]


def test_quality_equals_all_pairs(spark, given):
    docs, labels = given
    x = {d: np.array(plain_features(t)) for d, t in docs.items()}
    train = sorted(d for d, r in labels.items() if d in docs and r.quality is not None and zlib.crc32(str(d).encode()) % 5 != 0)
    y = np.array([labels[d].quality for d in train])
    base = np.stack([x[d] for d in train])
    mean, scale = base.mean(axis=0), base.std(axis=0)
    scale[scale <= 1e-9] = 1.0

    def design(rows):
        z = np.clip((rows - mean) / scale, -8, 8)
        return np.hstack([z, z * z / 8])

    d = design(base)
    diff = (d[y == 1][:, None] - d[y == 0][None]).reshape(-1, d.shape[1])  # every preference pair
    w = np.zeros(d.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        w += np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + 1e-3 * np.eye(len(w)), diff.T @ (1 - p) / len(diff) - 1e-3 * w)
    strength = {k: float((design(v[None]) @ w)[0]) for k, v in x.items()}
    cut = float(np.quantile(d @ w, (y == 0).mean()))
    rows = queries.QUERIES["op10_pairwise_quality"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    logit = np.array([math.log(r.score / (1 - r.score)) if 1e-12 < r.score < 1 - 1e-12 else math.copysign(27, r.score - 0.5) for r in rows])
    plain = np.array([strength[r.doc_id] for r in rows])
    order = lambda v: np.argsort(np.argsort(v))
    assert np.corrcoef(order(logit), order(plain))[0, 1] > 0.95
    assert sum((strength[r.doc_id] >= cut) == bool(r.predicted) for r in rows) >= 0.97 * len(rows)
    assert all(r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
