"""Benchmark decontamination by the q-gram lemma.

An item of m characters that occurs in a text with at most e edits keeps at
least m - q + 1 - q e of its q-grams, all within e diagonals (text place less
item place). Shared q-grams are counted in diagonal bands of 2 (e + 1) that
overlap by half, so one band holds them all; a band that reaches the bound is a
region, and is verified by a banded alignment of the whole item.

The bound must be positive, so q is chosen for each item: ``Q``, or less for short
items (q <= m / (e + 1)), which keep their full edit budget; items too short for an
edit are found verbatim. Items of one q have an index of their own.

Texts are compared as UTF-8 with ASCII and Latin-1 case folded and every run of
ASCII blanks and punctuation as one blank; characters are its bytes.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts, written
from .shingles import odd_constants

Q = 10
EDIT_PERCENT = 8
INDEX_BYTES = 4 << 20  # of benchmark text that one pass broadcasts; its index takes up to a hundred times that while it is built
_LEAK = ("doc_id", "item_id", "start", "end", "edits")
_COMMON = 4  # q-grams with more places than this may be left out of a count
_BITS = 22


def _fold_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    for b in (*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)):
        table[b] = 32
    return table


_FOLD = _fold_table()


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes without blanks at the ends, and each one's place in the
    UTF-8 of the text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = _FOLD[raw]
    if len(raw) > 1:  # U+00C0..U+00DE to lower case
        upper = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        out[1:][upper] += 32
    keep = out != 32
    blank_after = np.zeros(len(out), dtype=bool)
    blank_after[1:] = ~keep[1:] & keep[:-1]
    at = np.flatnonzero(keep | blank_after)
    if len(at) and out[at[-1]] == 32:
        at = at[:-1]
    return out[at], at


def grams(b: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of all q-grams (polynomial, by doubling)."""
    n = len(b) - q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base = int(odd_constants(1, "gram-base")[0])
    h, width = odd_constants(256, "gram")[b], 1
    out, done = None, 0
    while True:
        if q & width:
            if out is None:
                out, done = h, width
            else:  # append h to what is there
                m = len(b) - done - width + 1
                out = out[:m] * np.uint64(pow(base, width, 1 << 64)) + h[done : done + m]
                done += width
        if done == q:
            return out
        m = len(h) - width
        h, width = h[:m] * np.uint64(pow(base, width, 1 << 64)) + h[width:], width * 2


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)


def edits_of(m: int, percent: int) -> int:
    return m * percent // 100


def q_of(m: int, percent: int, q: int = Q) -> int:
    """The largest q up to ``q`` at which an item of m characters keeps a q-gram."""
    return min(q, m // (edits_of(m, percent) + 1))


class Index:
    """q-grams of the items whose normalised text is given: sorted hashes, their
    places, and each item's edit budget and bound."""

    def __init__(self, items: list[tuple[int, np.ndarray]], q: int, percent: int):
        self.q = q
        self.ids = [item for item, _ in items]
        self.texts = [b for _, b in items]
        sizes = np.array([len(b) for b in self.texts], dtype=np.int64)
        self.edits = sizes * percent // 100
        self.bound = sizes - q + 1 - q * self.edits
        h = np.concatenate([grams(b, q) for b in self.texts])
        o = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes - q + 1)
        p = np.arange(len(h), dtype=np.int64) - np.repeat(np.cumsum(sizes - q + 1) - (sizes - q + 1), sizes - q + 1)
        order = np.argsort(h, kind="stable")
        h, o, p = h[order], o[order], p[order].astype(np.int32)
        del order
        # an item may do without its commonest q-grams if its bound falls by as many
        new = np.concatenate(([True], h[1:] != h[:-1]))
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(h))).astype(np.int32)[np.cumsum(new) - 1]
        common = np.flatnonzero(times > _COMMON)
        common = common[np.lexsort((-times[common], o[common]))]
        rank = np.arange(len(common)) - np.searchsorted(o[common], o[common])
        drop = common[rank < (self.bound[o[common]] - 1) // 2]
        self.bound -= np.bincount(o[drop], minlength=len(sizes))
        keep = np.ones(len(h), dtype=bool)
        keep[drop] = False
        h, self.owner, self.place = h[keep], o[keep], p[keep]
        self.hashes, self.first, self.times = np.unique(h, return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[_slot(self.hashes)] = True


def indexes(items: list[tuple[int, str]], q: int, percent: int) -> list[Index]:
    """An index for each q that the items need; texts without characters need none."""
    by_q: dict[int, list[tuple[int, np.ndarray]]] = {}
    for item, text in items:
        b, _ = normalised(text or "")
        if len(b):
            by_q.setdefault(q_of(len(b), percent, q), []).append((item, b))
    return [Index(own, k, percent) for k, own in sorted(by_q.items())]


def _banded(a: np.ndarray, b: np.ndarray, low: int, width: int, budget: int, free: bool) -> tuple[int, int] | None:
    """(edits, end): the fewest edits between all of ``a`` and some b[start:end] on the
    diagonals (place in b less place in a) low .. low + width - 1, and the least such
    end; start is any place, or 0 unless ``free``. None above ``budget``."""
    far = budget + 1
    at = np.arange(width)
    place = low + at  # in b, before the first character of a
    row = np.where((place >= 0) & (place <= len(b)), 0 if free else np.abs(place), far)
    if not free:
        row[place < 0] = far
    # b[place] for all diagonals of a row is a slice of this
    before, after = max(0, -low), max(0, low + width + len(a) - len(b))
    padded = np.concatenate([np.zeros(before, np.int16) - 1, b.astype(np.int16), np.zeros(after, np.int16) - 1])
    for i, c in enumerate(a.tolist()):
        same = padded[low + before + i : low + before + i + width] == c
        step = np.minimum(row + ~same, np.append(row[1:], far) + 1)  # a character of both; one of a alone
        j = place + i + 1
        step[(j < 0) | (j > len(b))] = far
        row = np.minimum(np.minimum.accumulate(step - at) + at, far)  # characters of b alone
        row[(j < 0) | (j > len(b))] = far
        if row.min() > budget:
            return None
    best = int(row.argmin())
    return int(row[best]), int(place[best] + len(a))


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of the whole item in the text on the
    diagonals low .. low + width - 1, if within budget."""
    found = _banded(item, text, low, width, budget, True)
    if found is None:
        return None
    edits, end = found
    back = text[max(0, end - len(item) - budget) : end][::-1]
    length = _banded(item[::-1], back, -budget, 2 * budget + 1, budget, False)[1]
    return edits, end - length, end


def _shared(g: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Items and bands of a text's q-grams that reach the bound."""
    none = np.empty(0, dtype=np.int64)
    at = np.flatnonzero(index.seen[_slot(g)])
    if not len(at):
        return none, none
    h = g[at]
    k = np.searchsorted(index.hashes, h)
    k[k == len(index.hashes)] = 0
    ok = index.hashes[k] == h
    at, k = at[ok], k[ok]
    if not len(at):
        return none, none
    times = index.times[k]
    which = np.repeat(index.first[k] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
    owner, place = index.owner[which], index.place[which]
    diagonal = np.repeat(at, times) - place
    stride = index.edits[owner] + 1
    band = diagonal // stride
    # a q-gram counts once for each of the two bands it lies in
    owner, band, place = np.tile(owner, 2), np.concatenate([band, band - 1]), np.tile(place, 2)
    order = np.lexsort((place, band, owner))
    owner, band, place = owner[order], band[order], place[order]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (band[1:] != band[:-1])))
    distinct = new | np.concatenate(([True], place[1:] != place[:-1]))
    start = np.flatnonzero(new)
    counts = np.add.reduceat(distinct.astype(np.int64), start)
    start = start[counts >= index.bound[owner[start]]]
    return owner[start], band[start]


def search(text: str | None, index: Index) -> list[tuple[int, int, int, int]]:
    """(item, start, end, edits) of the items found, in bytes of the text. Of
    places of an item that overlap, the one with the fewest edits."""
    if not text:
        return []
    b, origin = normalised(text)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for item, band in zip(*(x.tolist() for x in _shared(grams(b, index.q), index))):
        body, e = index.texts[item], int(index.edits[item])
        low, width = band * (e + 1) - e, 4 * e + 3  # q-grams in the band, and e diagonals around
        lo, hi = max(0, low), min(len(b), low + width + len(body))
        exact = b[lo:hi].tobytes().find(body.tobytes())
        if exact >= 0:
            got = (0, exact, exact + len(body))
        else:
            got = align(body, b[lo:hi], low - lo, width, e) if e else None
        if got:
            found.setdefault(item, []).append((got[0], lo + got[1], lo + got[2]))
    out = []
    for item, places in sorted(found.items()):
        taken: list[tuple[int, int]] = []  # apart from each other, in order
        for edits, i, j in sorted(set(places)):
            k = bisect.bisect(taken, (i, j))
            if j > i and (k == 0 or taken[k - 1][1] <= i) and (k == len(taken) or j <= taken[k][0]):
                taken.insert(k, (i, j))
                out.append((item, int(origin[i]), int(origin[j - 1]) + 1, edits))
    return out


def _found(texts: Iterator[pd.Series], items: list[tuple[int, str]], q: int, percent: int) -> Iterator[list[list[tuple]]]:
    """For each batch of texts, for each text, (item_id, start, end, edits) in characters."""
    own = indexes(items, q, percent)  # once for a task
    for batch in texts:
        out = []
        for text in batch:
            rows = []
            for index in own:
                for item, i, j, edits in search(text, index):
                    raw = text.encode("utf-8", "surrogatepass")
                    start = len(raw[:i].decode("utf-8", "replace"))
                    rows.append((index.ids[item], start, start + len(raw[i:j].decode("utf-8", "replace")), edits))
            out.append(rows)
        yield out


def _scan(docs: DataFrame, items: list[tuple[int, str]], q: int, percent: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list = []

        def texts() -> Iterator[pd.Series]:
            for pdf in batches:
                ids.append([None if missing else doc for doc, missing in zip(pdf["doc_id"].tolist(), pdf["missing"])])
                yield pdf["text"]

        for found in _found(texts(), shared.value, q, percent):
            rows = [(doc, *row) for doc, own in zip(ids.pop(), found) for row in own]
            made = pd.DataFrame({c: pd.array(list(v), dtype="Int64") for c, v in zip(_LEAK, zip(*rows))} if rows else {c: [] for c in _LEAK})
            yield made

    # a null in a column of longs would make it one of doubles in pandas
    named = docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("missing"), "text")
    return named.mapInPandas(run, ", ".join(f"{c} long" for c in _LEAK))


def _clean(spark: SparkSession, items: list[tuple[int, str]], q: int, percent: int):
    """Whether a text holds none of the items."""
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for found in _found(texts, shared.value, q, percent):
            yield pd.Series([not rows for rows in found], dtype=bool)

    return clean


def _parts(benchmark: DataFrame, index_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items, in parts of some ``index_bytes`` of text."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = -(-total // index_bytes) or 1
    for k in range(parts):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) if parts > 1 else items
        yield [(r["item_id"], r["text"]) for r in mine.collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, *, q: int = Q, percent: int = EDIT_PERCENT, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """doc_id, item_id, start, end, edits: places (in characters) where a whole
    benchmark item occurs in a document with at most ``percent`` edits per 100
    characters.

    The items are broadcast while their texts are within ``index_bytes``; a
    larger benchmark is taken in parts of that size, one scan for each, whose
    results are written before the next.

    Cases: null and empty texts, and items without characters, match nothing;
    repeated items are each reported, as are repeated documents; a
    document with a null doc_id is searched and its rows have a null doc_id;
    empty tables give no rows; other columns are ignored."""
    narrow, out = texts(docs), None
    for items in _parts(benchmark, index_bytes):
        found = _scan(narrow, items, q, percent)
        if out is not None:
            out = out.union(written(found, "leaks"))
        else:
            out = found
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, q: int = Q, percent: int = EDIT_PERCENT, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs``, with their columns, whose own text holds no benchmark
    item: decided row by row, whatever their doc_ids are, in one scan for each part
    of the benchmark."""
    for items in _parts(benchmark, index_bytes):
        clean = _clean(docs.sparkSession, items, q, percent)
        docs = docs.filter(clean(F.col("text").cast("string")))
    return docs
