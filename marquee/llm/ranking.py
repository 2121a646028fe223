"""Quality by Bradley-Terry pairwise ranking.

A document's strength is linear in measures of its text. The weights minimise the
logistic loss over every preference pair (a labelled document of label 1 is
preferred to one of label 0) of all labelled documents outside the held-out fold.
Scores are cut at the quantile of these documents' strengths that equals the share
of label 0.

Pairs are never listed. A document's loss against all of the other label is a
smooth function of its strength alone, the potential of the other label. Strengths
are dealt to cells of width ``CELL``; a cell's power sums give the potentials as
Taylor series around the cells, to about 1e-13 of a pair's loss. So loss and
gradient are those of all pairs, from sums that Spark adds up; the Hessian takes a
pair's curvature at its cells' centres and only steers the steps.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.polynomial import polynomial
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import Scratch, texts, written
from .labelled import class_shares, fold, known_labels

FEATURES = (
    "log_words", "log_chars", "word_length", "long_words", "short_words", "distinct_words", "distinct_triples",
    "adjacent_repeats", "top_word", "duplicate_lines", "line_words", "upper", "digit", "non_ascii", "sentence_end",
    "comma", "exclamation", "pipe", "symbol", "other_mark", "char_entropy", "repeated_marks", "mark_words", "blank",
)
_SYMBOLS = np.frombuffer(b"#*$%&|<>=~^_@/\\{}[]", dtype=np.uint8)


def features(text: str | None) -> list[float]:
    """Measures of a whole text; an empty or blank one has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    buf = np.frombuffer(raw, dtype=np.uint8)
    counts = np.bincount(buf, minlength=256)
    size = len(buf)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = counts[counts > 0] / size
    letters = counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    is_mark = ((buf > 32) & (buf < 48)) | ((buf > 57) & (buf < 65)) | ((buf > 90) & (buf < 97)) | ((buf > 122) & (buf < 127))
    per_word: dict[bytes, int] = {}
    for w in words:
        per_word[w] = per_word.get(w, 0) + 1
    return [
        math.log1p(n),
        math.log1p(size),
        float(lengths.mean()),
        float((lengths > 12).mean()),
        float((lengths < 3).mean()),
        len(per_word) / n,
        len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2),
        sum(map(eq, words, words[1:])) / n,
        max(per_word.values()) / n,
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        float(counts[65:91].sum() / max(1, letters)),
        float(counts[48:58].sum() / size),
        float(counts[128:].sum() / size),
        float(counts[46] / n),
        float(counts[44] / n),
        float(counts[33] / n),
        float(counts[124] / n),
        float(counts[_SYMBOLS].sum() / n),
        float(marks / size),
        float(-(share * np.log(share)).sum()),
        float((is_mark[1:] & (buf[1:] == buf[:-1])).sum() / n),
        sum(1 for w in per_word if not w[-1:].isalnum() and w[-1] < 128) / len(per_word),
        float(counts[32] / size),
    ]


class Model:
    """Weights on standardised features (and their squares), the cut and the
    slope of the score's logistic; plain numbers, sent with the scoring code."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, z * z / 8], axis=1)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self._sum(self.design(x))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Design, number of the strength's cell, and strength from that cell's centre."""
        d = self.design(x)
        s = self._sum(d)
        cell = np.floor(s / CELL).astype(np.int64)
        return d, cell, s - (cell + 0.5) * CELL

    def _sum(self, d: np.ndarray) -> np.ndarray:
        # not a matrix product, whose last bits depend on the number of rows
        return (d * self.weights).sum(axis=1)


CELL = 1 / 8
ORDER = 8  # of the Taylor series
_CELLS = 1 << 20  # cells of either sign; the ridge bounds strengths far below

Sums = tuple[np.ndarray, np.ndarray]  # places and what to add there
Measure = Callable[[np.ndarray, np.ndarray], Sums]  # of rows' features and labels
Total = Callable[[Measure], Sums]  # a measure added up over all rows


def _added(at: np.ndarray, value: np.ndarray) -> Sums:
    at, which = np.unique(at, return_inverse=True)
    return at, np.bincount(which, weights=value, minlength=len(at))


def _filled(sums: Sums, size: int) -> np.ndarray:
    out = np.zeros(size)
    out[sums[0]] = sums[1]
    return out


def _per_label(values: np.ndarray, y: np.ndarray) -> Sums:
    both = np.stack([values[y == k].sum(axis=0) for k in (0, 1)])
    return np.arange(both.size), both.ravel()


def _softplus(t: np.ndarray, orders: int) -> Iterator[np.ndarray]:
    """log(1 + exp(t)) and its derivatives of the next orders."""
    yield np.logaddexp(0, t)
    p = 1 / (1 + np.exp(-np.clip(t, -700, 700)))
    of_p = np.array([0.0, 1.0])  # a derivative as a polynomial in p, whose own is p - p^2
    for _ in range(orders):
        yield polynomial.polyval(p, of_p)
        of_p = polynomial.polymul(polynomial.polyder(of_p), [0.0, 1.0, -1.0])


class Cells:
    """Power sums and sums of designs of the occupied cells of each label (0, 1),
    the potentials of the other label around them, and the loss of all pairs."""

    def __init__(self, sums: Sums, width: int):
        size = ORDER + 1 + width
        keys, which = np.unique(sums[0] // size, return_inverse=True)
        table = np.zeros((len(keys), size))
        table[which, sums[0] % size] = sums[1]
        self.keys = [keys[keys % 2 == k] // 2 - _CELLS for k in (0, 1)]
        self.powers, self.designs = ([table[keys % 2 == k, part] for k in (0, 1)] for part in (slice(0, ORDER + 1), slice(ORDER + 1, size)))
        self.series, self.curvature = zip(self._potential(0), self._potential(1))
        self.loss = float((self.series[0] * self.powers[0]).sum())

    @staticmethod
    def measure(model: Model) -> Measure:
        def run(x: np.ndarray, y: np.ndarray) -> Sums:
            d, cell, off = model.cells(x)
            key = (cell + _CELLS) * 2 + y
            values = np.hstack([off[:, None] ** np.arange(ORDER + 1), d])
            order = np.argsort(key, kind="stable")
            keys, first = np.unique(key[order], return_index=True)
            sums = np.add.reduceat(values[order], first, axis=0) if len(keys) else values
            return (keys[:, None] * values.shape[1] + np.arange(values.shape[1])).ravel(), sums.ravel()

        return run

    def _potential(self, label: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Around each cell of the label, the Taylor series of the summed loss of a
        strength against all of the other label, and its curvature with the other
        label at its cells' centres."""
        sign = 1 - 2 * label  # a pair loses softplus(strength of 0 - strength of 1)
        factorial = np.array([math.factorial(k) for k in range(ORDER + 1)], dtype=float)
        moments = self.powers[1 - label] * (-1.0) ** np.arange(ORDER + 1) / factorial
        series = np.zeros((len(self.keys[label]), ORDER + 1))
        curvature = np.zeros(len(series))
        for at in range(0, len(series), rows):
            gap = sign * CELL * (self.keys[label][at : at + rows, None] - self.keys[1 - label][None])
            for n, f in enumerate(_softplus(gap, 2 * ORDER)):
                low, high = max(0, n - ORDER), min(n, ORDER)
                part = f @ moments[:, low : high + 1]  # other's power k goes with own power n - k
                for k in range(low, high + 1):
                    series[at : at + rows, n - k] += sign**n * part[:, k - low] / factorial[n - k]
                if n == 2:
                    curvature[at : at + rows] = f @ self.powers[1 - label][:, 0]
        return series, curvature

    def slopes(self, model: Model) -> Measure:
        """Gradient of the loss, and the part of its Hessian that rows have alone."""
        keys, series, curvature = self.keys, self.series, self.curvature

        def run(x: np.ndarray, y: np.ndarray) -> Sums:
            d, cell, off = model.cells(x)
            slope, bend = np.zeros(len(x)), np.zeros(len(x))
            for k in (0, 1):
                own = y == k
                at = np.searchsorted(keys[k], cell[own])
                slope[own] = (series[k][at, 1:] * np.arange(1, ORDER + 1) * off[own, None] ** np.arange(ORDER)).sum(axis=1)
                bend[own] = curvature[k][at]
            sums = np.concatenate([d.T @ slope, ((d * bend[:, None]).T @ d).ravel()])
            return np.arange(len(sums)), sums

        return run

    def crossed(self) -> np.ndarray:
        """The part of the Hessian from products of a pair's two designs."""
        out = np.zeros((self.designs[0].shape[1],) * 2)
        for at in range(0, len(self.keys[0]), 256):
            gap = CELL * (self.keys[0][at : at + 256, None] - self.keys[1][None])
            *_, bend = _softplus(gap, 2)
            out += self.designs[0][at : at + 256].T @ (bend @ self.designs[1])
        return out + out.T


def _weights(total: Total, model: Model, pairs: float, ridge: float) -> None:
    """Newton steps to the minimum of the mean loss of all pairs plus the ridge;
    a step that doesn't lower it is halved."""
    width = len(model.weights)
    w, step, least = model.weights, np.zeros(width), math.inf
    reach = 2 * math.log(2) / ridge  # w'w beyond it costs more than no weights at all
    for _ in range(100):
        model.weights = w + step
        own = float(model.weights @ model.weights)
        if own <= reach:
            cells = Cells(total(Cells.measure(model)), width)
            loss = cells.loss / pairs + ridge / 2 * own
            if loss <= least + 1e-12:
                w, least = model.weights, loss
                sums = _filled(total(cells.slopes(model)), width + width * width) / pairs
                hess = sums[width:].reshape(width, width) - cells.crossed() / pairs + ridge * np.eye(width)
                step = -np.linalg.solve(hess, sums[:width] + ridge * w)
                if np.abs(step).max() < 1e-8:
                    break
                continue
        step = step / 2
    model.weights = w


def _ordered(s: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles."""
    bits = (s + 0.0).view(np.int64)  # without a negative zero
    return (bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(np.uint64) ^ np.uint64(1 << 63)


def _double(key: int) -> float:
    bits = key - (1 << 63)
    return float(np.array([bits if bits >= 0 else bits ^ (2**63 - 1)], dtype=np.int64).view(np.float64)[0])


def _quantile(total: Total, model: Model, n: np.ndarray, share0: float) -> float:
    """The least strength up to which the labels' rows, weighed as their shares,
    come to ``share0``; its 64 bits are found 16 at a time from counts of all rows."""
    weight = np.array([share0, 1 - share0]) / n
    known, below = 0, np.zeros(2)
    for shift in (48, 32, 16, 0):

        def count(x: np.ndarray, y: np.ndarray, known=np.uint64(known), shift=np.uint64(shift)) -> Sums:
            key = _ordered(model.strength(x)) >> shift
            own = key >> np.uint64(16) == known
            digit = (key[own] & np.uint64(0xFFFF)).astype(np.int64)
            return _added(digit * 2 + y[own], np.ones(len(digit)))

        counts = _filled(total(count), 2 << 16).reshape(-1, 2)
        upto = below + counts.cumsum(axis=0)
        there = np.flatnonzero(counts.any(axis=1))
        reached = there[upto[there] @ weight >= share0 - 1e-12]
        digit = int(reached[0] if len(reached) else there[-1])
        known, below = known << 16 | digit, upto[digit] - counts[digit]
    return _double(known)


def learn(total: Total, share0: float, *, ridge: float = 1e-3) -> Model:
    """The model of the rows that ``total`` adds up over. With one label only, all
    weights are 0."""
    width = len(FEATURES)
    sums = _filled(total(lambda x, y: _per_label(np.hstack([np.ones((len(x), 1)), x]), y)), 2 * (width + 1)).reshape(2, -1)
    n = sums[:, 0]
    mean = sums[:, 1:].sum(axis=0) / max(1.0, n.sum())
    squares = _filled(total(lambda x, y: _per_label((x - mean) ** 2, y)), 2 * width).reshape(2, -1)
    scale = np.sqrt(squares.sum(axis=0) / max(1.0, n.sum()))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(2 * width), 0.0)
    if n.all():
        _weights(total, model, float(n[0] * n[1]), ridge)
        model.cut = _quantile(total, model, n, share0)
    return model


def fit(x: np.ndarray, y: np.ndarray, share0: float, *, ridge: float = 1e-3) -> Model:
    """The model of rows at hand."""
    return learn(lambda measure: measure(x, y), share0, ridge=ridge)


def over(rows: DataFrame) -> Total:
    """Adds measures up over a table (label, x) on Spark."""

    def total(measure: Measure) -> Sums:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, value = np.empty(0, dtype=np.int64), np.empty(0)
            for batch in batches:
                x = batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))
                more = measure(x, batch.column("label").to_numpy().astype(np.int64))
                at, value = _added(np.concatenate([at, more[0]]), np.concatenate([value, more[1]]))
            yield pa.RecordBatch.from_pydict({"at": at, "value": value})

        made = rows.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        return made["at"].to_numpy(), made["value"].to_numpy()

    return total


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row of ``docs``: the features of its whole text, written."""

    @pandas_udf("array<double>")
    def measures(text: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in text], dtype=object)

    return written(texts(docs).select("doc_id", measures("text").alias("x")), "quality-features")


def train(measures: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0) -> Model:
    """Fit on all labelled documents outside the held-out fold; what is joined are
    their features, not texts, and the driver gets sums over cells."""
    spark = measures.sparkSession
    rows = measures.join(known_labels(labels, "quality", folds, held), "doc_id").select("label", "x")
    n0, n1 = class_shares(labels, "quality", folds, held)
    with Scratch(spark) as scratch:
        # read once a step: dealt out evenly, over as many tasks whatever the join made
        rows = scratch.written(rows.repartition(2 * spark.sparkContext.defaultParallelism), "quality-labelled")
        return learn(over(rows), n0 / max(1, n0 + n1))


def ranked_quality(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    The score is a logistic of the strength that equals ``threshold`` at the
    quantile, so predicted (score >= threshold) is strength >= quantile.

    Cases: null, empty and blank texts have zero features and are scored;
    without labels of both kinds every score is ``threshold``; rows that repeat a
    doc_id are scored one by one; a null doc_id isn't held out; other columns
    are ignored; no documents give no rows. The features, from which the scores are
    read, stay in the checkpoint folder."""
    known = measured(docs)
    model = train(known, labels, folds=folds, held=held)
    shift = math.log(threshold / (1 - threshold))

    @pandas_udf("double")
    def score(measures: pd.Series) -> pd.Series:
        x = np.array(measures.tolist(), dtype=np.float64).reshape(len(measures), len(FEATURES))
        z = model.strength(x) - model.cut + shift
        s = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        return pd.Series(np.where(z >= shift, np.maximum(s, threshold), s))

    held_out = F.coalesce(fold("doc_id", folds) == held, F.lit(False))
    scored = known.select("doc_id", held_out.alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
