"""Sharding by histogram sort.

Rows are ordered by (64-bit hash of the text, doc_id), so equal texts are
neighbours and a hot text is cut by doc_id. Splitters are found by counting the
exact bytes below candidate boundaries in all partitions at once and refining
the probes where a target still lies between two of them; each round is one
partially aggregated job over a narrow table. Then rows are exchanged once.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import free_name, with_row_key, written

_OFFSET = 1 << 63
_TOP = 1 << 128


def _split(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit keys as two signed 64-bit arrays that order alike."""
    high = np.array([(k >> 64) - _OFFSET for k in keys], dtype=np.int64)
    low = np.array([(k & ((1 << 64) - 1)) - _OFFSET for k in keys], dtype=np.int64)
    return high, low


def _join(high: int, low: int) -> int:
    return ((int(high) + _OFFSET) << 64) | (int(low) + _OFFSET)


def _interval(high: np.ndarray, low: np.ndarray, ph: np.ndarray, pl: np.ndarray) -> np.ndarray:
    """Number of probes (ph, pl) at or below each key (high, low)."""
    first, last = np.searchsorted(ph, high, "left"), np.searchsorted(ph, high, "right")
    out = first.copy()
    tied = np.flatnonzero(first < last)
    for lo in np.unique(first[tied]):
        rows = tied[first[tied] == lo]
        out[rows] = lo + np.searchsorted(pl[lo : last[rows[0]]], low[rows], "right")
    return out


def _histogram(keys: DataFrame, probes: list[int]) -> list:
    """(interval, bytes, rows, least and greatest key) of every interval between
    probes that has rows: at most one row more than there are probes."""
    ph, pl = _split(probes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            h, d = pdf["h"].to_numpy(), pdf["d"].to_numpy()
            at = _interval(h, d, ph, pl)
            order = np.lexsort((d, h, at))
            at, h, d, size = at[order], h[order], d[order], pdf["size"].to_numpy()[order]
            start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            end = np.append(start[1:], len(at)) - 1
            yield pd.DataFrame(
                {
                    "at": at[start],
                    "bytes": np.add.reduceat(size, start),
                    "n": end - start + 1,
                    "h0": h[start],
                    "d0": d[start],
                    "h1": h[end],
                    "d1": d[end],
                }
            )

    parts = keys.mapInPandas(run, "at long, bytes long, n long, h0 long, d0 long, h1 long, d1 long")
    return (
        parts.groupBy("at")
        .agg(
            F.sum("bytes").alias("bytes"),
            F.sum("n").alias("n"),
            F.min(F.struct("h0", "d0")).alias("least"),
            F.max(F.struct("h1", "d1")).alias("most"),
        )
        .collect()
    )


class _Counts:
    """What is known of the order: keys whose bytes and rows below are exact."""

    def __init__(self) -> None:
        self.below: dict[int, tuple[int, int]] = {}

    def refine(self, keys: DataFrame, probes: list[int]) -> list[tuple[int, int, int]]:
        """Count one set of probes; returns (least key, greatest key, bytes) of
        the intervals between all keys known after it."""
        known = sorted(set(self.below) | set(probes))
        found = {r["at"]: r for r in _histogram(keys, known)}
        out, size, rows = [], 0, 0
        for i in range(len(known) + 1):
            if i:
                self.below[known[i - 1]] = (size, rows)
            if i in found:
                r = found[i]
                out.append((_join(*r["least"]), _join(*r["most"]), r["bytes"]))
                size, rows = size + r["bytes"], rows + r["n"]
        self.total = (size, rows)
        return out


def _spread(least: int, most: int, n: int) -> list[int]:
    """Up to ``n`` keys in (least, most], evenly; the rows at ``least`` are then
    below the first."""
    width = most - least
    return sorted({least + max(1, (width * k) // n) for k in range(1, n + 1)}) if width > 0 else []


def splitters(keys: DataFrame, shards: int, tolerance: float, slice_bytes: int, probes: int) -> tuple[list[int], _Counts]:
    """``shards - 1`` keys whose bytes below are within ``tolerance`` of a
    shard's mean of their target, or as near as a boundary between two keys
    gets; and the counts found, fine enough for slices of ``slice_bytes``."""
    known = _Counts()
    intervals = known.refine(keys, [_TOP * k // (shards * probes) for k in range(1, shards * probes)])
    total = known.total[0]
    targets = [total * k / shards for k in range(1, shards)]
    near = tolerance * total / shards
    limit = max(slice_bytes, 1)
    while True:
        wanted, size = [], 0
        for least, most, b in intervals:
            inside = [t for t in targets if size < t < size + b and min(t - size, size + b - t) > near]
            if (inside or b > limit) and most > least:
                # hashed keys are even, so some two probes for each slice will do
                wanted += _spread(least, most, probes * len(inside) + (2 * math.ceil(b / limit) if b > limit else 0))
            size += b
        fresh = [k for k in wanted if k not in known.below]
        if not fresh:
            break
        intervals = known.refine(keys, fresh)
    edges = sorted(known.below)
    sizes = [known.below[k][0] for k in edges]
    chosen = []
    for t in targets:
        i = bisect_left(sizes, t)
        best = min((j for j in (i - 1, i) if 0 <= j < len(edges)), key=lambda j: abs(sizes[j] - t), default=None)
        chosen.append(edges[best] if best is not None else _TOP - 1)
    return chosen, known


def histogram_sort(
    docs: DataFrame,
    *,
    shards: int = 16,
    tolerance: float = 0.001,
    slice_bytes: int = 64 << 20,
    slices_per_shard: int = 8,
    probes: int = 64,
) -> DataFrame:
    """The columns of ``docs`` (by default doc_id and text are read) and size,
    shard, slot. ``size`` is the UTF-8 bytes of the text plus 1; shards are
    ranges of the order (hash of the text, doc_id) with near equal bytes; slot
    is the row's place in its shard, gapless from 0. Columns of ``docs`` that
    are named size, shard or slot are replaced.

    Each shard is dealt out as at least ``slices_per_shard`` slices of at most
    about ``slice_bytes``, so no task holds a shard. The driver holds the probes
    only: some 64 per shard and round plus two for each slice, as many as a range
    partitioner of that width has.

    Cases: a null text has size 1 and sorts with other nulls; rows without doc_id
    are ordered among equal texts by a hash of their place in their file; rows with the same text and doc_id can't be
    told apart by key, stay in one shard and take its slots in any order; empty
    tables give no rows; fewer rows than shards leave shards empty."""
    keyed, row = with_row_key(docs)
    h, d, part, rank, place_of = (free_name(docs, name) for name in ("sort_hash", "sort_id", "sort_slice", "sort_rank", "sort_place"))
    base = keyed.withColumns(
        {
            "size": F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long") + 1,
            h: F.xxhash64("text"),
            d: F.coalesce(F.col("doc_id").cast("long"), F.col(row)),
        }
    )
    keys = written(base.select(F.col(h).alias("h"), F.col(d).alias("d"), "size"), "sort-keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slice_bytes = min(slice_bytes, max(1, total // (shards * slices_per_shard)))
    cuts, known = splitters(keys, shards, tolerance, slice_bytes, probes)

    # slices: every cut, and between cuts the counted keys some slice_bytes apart
    edges, bases, shard_of = [], [0], [0]
    start, in_slice, shard, cut = 0, 0, 0, sorted(cuts)
    for key in sorted(known.below):
        size, rows = known.below[key]
        passed = bisect_right(cut, key)
        if passed > shard:
            shard, start, in_slice = passed, rows, size
        elif size - in_slice >= slice_bytes:
            in_slice = size
        else:
            continue
        edges.append(key)
        bases.append(rows - start)
        shard_of.append(shard)
    eh, el = _split(edges)
    first, owner = np.array(bases, dtype=np.int64), np.array(shard_of, dtype=np.int32)

    @pandas_udf("int")
    def slice_of(h: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(_interval(h.to_numpy(), d.to_numpy(), eh, el), dtype="int32")

    @pandas_udf("struct<shard int, base long>")
    def place(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"shard": owner[s.to_numpy()], "base": first[s.to_numpy()]})

    dealt = base.withColumn(part, slice_of(h, d))
    within = F.row_number().over(Window.partitionBy(part).orderBy(h, d))
    out = dealt.withColumn(rank, within).withColumn(place_of, place(part))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "shard", "slot")]
    return out.select(
        *kept,
        "size",
        F.col(f"{place_of}.shard").alias("shard"),
        (F.col(f"{place_of}.base") + F.col(rank) - 1).cast("long").alias("slot"),
    )
