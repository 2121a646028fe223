"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios (Wang and Manning, "Baselines and Bigrams", 2012).

n-grams of lower-cased code points are hashed to ``2**bits`` features; a feature
is present or not in a document. Its ratio is the log of its smoothed share in
toxic against other documents; those whose ratio is within the noise of its
counts are left out. The classifier is a ridge-penalised logistic regression on
presence times ratio.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import texts, written
from .labelled import class_shares, fold, labelled_sample

ORDERS = (3, 4, 5, 6)
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)


def _hashed(code: np.ndarray, order: int, bits: int) -> np.ndarray:
    n = len(code) - order + 1
    h = np.full(max(n, 0), order * 0x632BE5AB & 0xFFFFFFFF, dtype=np.uint32)
    for k in range(order if n > 0 else 0):
        h += code[k : k + n] * np.uint32(_FACTORS[k])
        h ^= h >> np.uint32(15)
        h *= np.uint32(_FACTORS[(k + 3) % 6])
    return h >> np.uint32(32 - bits)


def present(text: str | None, bits: int, wanted: np.ndarray | None = None, block: int = 1 << 20) -> np.ndarray:
    """Sorted distinct features of a whole text (of the ``wanted`` ones), taken
    in overlapping blocks so that a long text needs no more memory."""
    if not text:
        return np.empty(0, dtype=np.uint32)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = []
    for at in range(0, len(code), block):
        for order in ORDERS:
            h = _hashed(code[at : at + block + order - 1], order, bits)
            found.append(np.unique(h[wanted[h]] if wanted is not None else h))
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.uint32)


class Model:
    def __init__(self, bits: int, wanted: np.ndarray, weight: np.ndarray, bias: float):
        self.bits, self.wanted, self.weight, self.bias = bits, wanted, weight, bias

    def logit(self, text: str | None) -> float:
        return float(self.weight[present(text, self.bits, self.wanted)].sum()) + self.bias


def ratios(counts: DataFrame, docs0: int, docs1: int, noise: float = 4.0) -> DataFrame:
    """(feature, r) of document counts (feature, n0, n1): naive Bayes log-count
    ratios, add-one smoothed, of at least ``noise`` of their standard errors."""
    r = F.log((F.col("n1") + 1) / F.lit(docs1 + 2)) - F.log((F.col("n0") + 1) / F.lit(docs0 + 2))
    error = F.sqrt(1 / (F.col("n1") + 1) + 1 / (F.col("n0") + 1))
    return counts.select("feature", r.alias("r"), error.alias("error")).filter(F.abs("r") >= noise * F.col("error")).drop("error")


def _sums(values: np.ndarray, starts: np.ndarray, n: int, owner: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values``; ``owner`` tells whose each run is."""
    out = np.zeros(n)
    if len(values):
        out[owner] = np.add.reduceat(values, starts)
    return out


def fit(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, *, ridge: float = 1.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ratio by accelerated gradients;
    returns weights times ratio per feature, and the bias. The presence matrix
    is held as two 32-bit index lists, by row and by column."""
    used = np.flatnonzero(r)
    n, width, scale = len(rows), len(used), r[used]
    column = np.zeros(len(r), dtype=np.int32)
    column[used] = np.arange(width, dtype=np.int32)
    lengths = np.array([len(x) for x in rows], dtype=np.int64)
    col = column[np.concatenate(rows)] if n else np.empty(0, dtype=np.int32)
    row = np.repeat(np.arange(n, dtype=np.int32), lengths)
    by_row = (np.cumsum(lengths) - lengths)[lengths > 0], n, np.flatnonzero(lengths)
    times = np.bincount(col, minlength=width) if width else np.empty(0, dtype=np.int64)
    by_col = (np.cumsum(times) - times)[times > 0], width, np.flatnonzero(times)
    row = row[np.argsort(col, kind="stable")]

    def apply(w: np.ndarray, b: float) -> np.ndarray:
        return _sums((scale * w)[col], *by_row) + b

    def back(e: np.ndarray) -> np.ndarray:
        return scale * _sums(e[row], *by_col)

    v = np.ones(width)
    top = 1.0
    for _ in range(20 if width else 0):  # the largest eigenvalue of X'X
        v = back(apply(v, 0.0))
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    rate = 1 / (0.25 * top + 0.25 * n + ridge)
    w = yw = np.zeros(width)
    b = yb = 0.0
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(apply(yw, yb), -30, 30)))
        e = p - y
        nw = yw - rate * (back(e) + ridge * yw)
        nb = yb - rate * e.sum()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        yw, yb = nw + (t - 1) / t2 * (nw - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = nw, nb, t2
    weight = np.zeros(len(r))
    weight[used] = w * scale
    return weight, b


def train(docs: DataFrame, labels: DataFrame, *, folds: int, held: int, bits: int = 20, per_class: int = 5000) -> Model:
    """Fit on at most ``per_class`` documents of each label outside the held-out
    fold. Feature counts are added up on Spark; the driver gets the features
    whose ratio is beyond its noise (at most 2**bits) and which of them each
    document of the sample has."""
    sample = written(labelled_sample(docs, labels, "toxic", folds, held, per_class).repartition(12), "toxicity-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((2, 1 << bits), dtype=np.int32)
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["label"]):
                n[label][present(text, bits)] += 1
        at = np.flatnonzero(n[0] + n[1])
        for k in range(0, len(at), 50_000):
            part = at[k : k + 50_000]
            yield pd.DataFrame({"feature": part, "n0": n[0][part], "n1": n[1][part]})

    counted = (
        sample.mapInPandas(count, "feature long, n0 long, n1 long")
        .groupBy("feature")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .filter("n0 + n1 > 2")
    )
    size = {x["label"]: x["count"] for x in sample.groupBy("label").count().collect()}
    r = np.zeros(1 << bits)
    if len(size) == 2:
        kept = ratios(counted, size[0], size[1]).toPandas()
        r[kept["feature"].to_numpy(dtype=np.int64)] = kept["r"].to_numpy(dtype=np.float64)
    wanted = r != 0

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "label": pdf["label"], "x": [present(t, bits, wanted).tobytes() for t in pdf["text"]]}
            )

    rows = sample.mapInPandas(chosen, "doc_id long, label int, x binary").collect()
    rows.sort(key=lambda row: (row["doc_id"], bytes(row["x"])))
    y = np.array([row["label"] for row in rows], dtype=np.float64)
    weight, bias = fit([np.frombuffer(bytes(row["x"]), dtype=np.uint32) for row in rows], y, r)
    n0, n1 = class_shares(labels, "toxic", folds, held)
    if len(size) == 2:  # the sample's label shares against all labels'
        bias += np.log(n1 / n0) - np.log(size[1] / size[0])
    else:  # nothing to tell the labels apart by
        bias = 60.0 if n1 else -60.0
    return Model(bits, wanted, weight, float(bias))


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held: int = 2, threshold: float = 0.3, bits: int = 20, per_class: int = 5000) -> DataFrame:
    """doc_id, held_out, score (the modelled chance of label 1), predicted
    (score >= threshold) for every row of ``docs``, from its whole text.

    Cases: null and empty texts have no n-grams and score the bias; with labels
    of one kind only every score is that label, without any it is 0; rows that repeat a doc_id are scored one by one; a null doc_id
    isn't held out; other columns are ignored; no documents give no rows."""
    model = train(docs, labels, folds=folds, held=held, bits=bits, per_class=per_class)
    shared = docs.sparkSession.sparkContext.broadcast(model.__dict__)  # 2**bits weights

    @pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        m = Model(**shared.value)
        return pd.Series([1 / (1 + np.exp(-np.clip(m.logit(t), -60, 60))) for t in text], dtype="float64")

    held_out = F.coalesce(fold("doc_id", folds) == held, F.lit(False))
    scored = texts(docs).select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
