"""Removal of repeated byte strings by difference-cover suffix sorting.

A byte is removed if it is covered by a ``WIDTH``-byte string that also starts
in a document with a smaller doc_id. For that, suffixes have to be sorted by
their first WIDTH bytes only, which the difference-cover algorithm gives at its
first levels:

1. *Sampled tuples.* Offsets whose residue modulo 21 is in the difference cover
   {0, 1, 4, 14, 16} are sampled. For any two suffixes some shift below 21 takes
   both to sampled offsets, so two equal 50-byte strings have a pair of sampled
   suffixes inside that agree in 30 bytes. The sampled 30-byte tuples are sorted
   and named; a name is *shared* if two documents have it.
2. *Remaining suffixes.* Only offsets with a shared name within the next 20 can
   start a repeated string. Their names are composed of two shorter ones (bytes
   0-29 and 30-49, as the recursion composes names of names), and are sorted.
3. *Adjacent prefixes.* Equal neighbours in that order have equal 50-byte
   prefixes; the least doc_id of each run decides.

Suffixes are packed: a row holds the sorted names of one batch of documents that
fall into one range of names, and what comes back is a bit for each name, so
the shuffles carry some 2.5 and 7 bytes for a name, the first with half a byte more
for ten times the text, as a batch then has fewer names in a range. The texts are written once as
a bucketed table and never shuffled. Texts equal to one of a smaller doc_id are
told by their MD5 and have no suffixes sorted. Names are 64-bit hashes, in the first step
their leading bits, where a false match only costs work.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_records, written
from .shingles import odd_constants

WIDTH = 50
MODULUS = 21
COVER = (0, 1, 4, 14, 16)
TUPLE = WIDTH - MODULUS + 1
BATCH_BYTES = 3 << 20
RANGE_BYTES = 32 << 20  # of text for each range of names
RANGES = 4  # at least
FIRST_BITS = 32  # of a name within its range, in the first step: one name in 600 is taken for shared by chance


def _doubled(b: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the strings of 1, 2, 4, 8 and 16 bytes from every offset."""
    out, width = {1: odd_constants(256, "suffix")[b]}, 1
    while width < 16:
        out[2 * width] = _append(out[width], out[width], width, width)
        width *= 2
    return out


def _append(a: np.ndarray, b: np.ndarray, len_a: int, len_b: int) -> np.ndarray:
    """Hash of a string of len_a bytes and the len_b bytes after it."""
    n = max(0, len(b) - len_a)
    base = int(odd_constants(1, "suffix-base")[0])
    return a[:n] * np.uint64(pow(base, len_b, 1 << 64)) + b[len_a : len_a + n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class Batch:
    """Concatenated documents, in doc_id order, and their suffixes' names."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, raw: bytes, copies: np.ndarray):
        self.ids, self.ends = ids, ends
        self.copy = np.zeros(len(ids), dtype=bool)
        self.copy[copies] = True
        self.bytes = np.frombuffer(raw, dtype=np.uint8)
        self.starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        p = _doubled(self.bytes)
        self.rest_hash = _append(p[16], p[4], 16, 4)  # 20 bytes
        self.tuple_hash = _append(p[16], _append(p[8], _append(p[4], p[2], 4, 2), 8, 6), 16, 14)  # 30 bytes

    def _doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")

    def sampled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sampled offsets, the index of each one's name, the sorted distinct
        names, and whether documents of this batch share the name."""
        there = []
        for start, end, copy in zip(self.starts.tolist(), self.ends.tolist(), self.copy.tolist()):
            if end - start >= WIDTH and not copy:
                there.append(start + _sampled_offsets(end - start - TUPLE + 1))
        at = np.concatenate(there) if there else np.empty(0, dtype=np.int64)
        names, index = np.unique(_mixed(self.tuple_hash[at]), return_inverse=True)
        doc = self.ids[self._doc_of(at)]
        least = np.full(len(names), np.iinfo(np.int64).max)
        most = np.full(len(names), np.iinfo(np.int64).min)
        np.minimum.at(least, index, doc)
        np.maximum.at(most, index, doc)
        return at, index, names, least != most

    def candidates(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Offsets that may start a repeated string (``shared``: sampled offsets
        with a shared name), the document of each, the index of its name, and
        the sorted distinct names."""
        mark = np.zeros(len(self.bytes) + 1, dtype=np.int32)
        doc = self._doc_of(shared)
        np.add.at(mark, np.maximum(shared - MODULUS + 1, self.starts[doc]), 1)
        np.add.at(mark, shared + 1, -1)
        at = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        doc = self._doc_of(at)
        ok = at + WIDTH <= self.ends[doc]
        at, doc = at[ok], doc[ok]
        base = pow(int(odd_constants(1, "suffix-base")[0]), WIDTH - TUPLE, 1 << 64)
        names, index = np.unique(
            _mixed(self.tuple_hash[at] * np.uint64(base) + self.rest_hash[at + TUPLE]), return_inverse=True
        )
        return at, doc, index, names


def _sampled_offsets(n: int) -> np.ndarray:
    """Offsets below n in the difference cover."""
    blocks = np.arange(0, max(n, 0), MODULUS)
    at = (blocks[:, None] + np.array(COVER)).ravel()
    return at[at < n]


def _range_of(names: np.ndarray, ranges: int) -> np.ndarray:
    """Bounds of the ranges in the sorted names: equal parts of the key space."""
    width = -(-(1 << 64) // ranges)
    return np.searchsorted(names, np.array([min(k * width, (1 << 64) - 1) for k in range(ranges)], dtype=np.uint64)).tolist() + [len(names)]


def _fixed(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, one after another."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(bits[:, 64 - width :]).tobytes()


def _unfixed(raw: bytes, n: int, width: int) -> np.ndarray:
    bits = np.zeros((n, 64), dtype=np.uint8)
    bits[:, 64 - width :] = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * width).reshape(n, width)
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def _packed(values: np.ndarray, bits: int) -> bytes:
    """Sorted distinct values below 2^bits in Elias-Fano code: the low bits as they are,
    the others as the places of ones in a bitmap. That takes two bits more than
    log2(2^bits / n) for each of n values, however dense they are."""
    n = len(values)
    low = max(0, bits - n.bit_length())
    ones = np.zeros(n + (1 << (bits - low)) + 1, dtype=np.uint8)
    ones[(values.astype(np.uint64) >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    return np.array([n], "<u4").tobytes() + (_fixed(values, low) if low else b"") + np.packbits(ones).tobytes()


def _unpacked(raw: bytes, bits: int) -> np.ndarray:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    low = max(0, bits - n.bit_length())
    cut = 4 + -(-n * low // 8)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, offset=cut)))[:n] - np.arange(n)
    out = high.astype(np.uint64) << np.uint64(low)
    return out | _unfixed(raw[4:cut], n, low) if low else out


def _range_bits(ranges: int) -> tuple[int, int]:
    """Width of a range of names, and the bits of a place in it."""
    width = -(-(1 << 64) // ranges)
    return width, (width - 1).bit_length()


def _first_names(names: np.ndarray, ranges: int) -> np.ndarray:
    """The leading FIRST_BITS within a range, for sorted names of that range."""
    width, bits = _range_bits(ranges)
    return (names % np.uint64(width)) >> np.uint64(max(0, bits - FIRST_BITS))


def _rows(pdf: pd.DataFrame) -> Iterator[tuple[int, Batch]]:
    for key, ids, ends, raw, copies in zip(pdf["batch"], pdf["ids"], pdf["ends"], pdf["text"], pdf["copies"]):
        places = np.asarray(copies if copies is not None else [], dtype=np.int64)
        yield key, Batch(np.asarray(ids, dtype=np.int64), np.asarray(ends, dtype=np.int64), raw, places)


def _known(found: list | None) -> dict[int, bytes]:
    return {x["part"]: x["bits"] for x in found} if found is not None else {}


def _first_pass(ranges: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, batch in _rows(pdf):
                _, _, names, several = batch.sampled()
                bounds, out = _range_of(names, ranges), []
                bits = _range_bits(ranges)[1]
                for r in range(ranges):
                    i, j = bounds[r], bounds[r + 1]
                    if i < j:
                        first = _first_names(names[i:j], ranges)
                        new = np.concatenate(([True], first[1:] != first[:-1]))
                        # names equal in their first bits count as shared
                        group = np.cumsum(new) - 1
                        flag = np.zeros(int(group[-1]) + 1, dtype=bool)
                        np.logical_or.at(flag, group, several[i:j])
                        flag |= np.bincount(group) > 1
                        out.append((r, key, _packed(first[new], min(FIRST_BITS, bits)), np.packbits(flag).tobytes()))
                yield pd.DataFrame(out, columns=["part", "batch", "names", "several"])

    return run


def _by_part(batches: Iterator[pd.DataFrame]) -> Iterator[list]:
    """All rows of a part together; input is sorted by part."""
    held: list = []
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            if held and held[0].part != row.part:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _shared_names(ranges: int):
    width = min(FIRST_BITS, _range_bits(ranges)[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_part(batches):
            names = [_unpacked(r.names, width) for r in rows]
            sizes = np.cumsum([0] + [len(x) for x in names])
            several = np.concatenate([np.unpackbits(np.frombuffer(r.several, np.uint8), count=len(x)) for r, x in zip(rows, names)])
            _, index, times = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
            shared = (times[index] > 1) | (several > 0)
            yield pd.DataFrame(
                [(r.batch, r.part, np.packbits(shared[i:j]).tobytes()) for r, i, j in zip(rows, sizes, sizes[1:])],
                columns=["batch", "part", "bits"],
            )

    return run


def _bits(found: list, part: int, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(found[part], np.uint8), count=n).astype(bool)


def _shared_offsets(batch: Batch, found: dict[int, bytes], ranges: int) -> np.ndarray:
    at, index, names, _ = batch.sampled()
    bounds, shared = _range_of(names, ranges), np.zeros(len(names), dtype=bool)
    for r in range(ranges):
        i, j = bounds[r], bounds[r + 1]
        if i < j:
            first = _first_names(names[i:j], ranges)
            group = np.cumsum(np.concatenate(([True], first[1:] != first[:-1]))) - 1
            shared[i:j] = _bits(found, r, int(group[-1]) + 1)[group]
    return at[shared[index]]


def _least(batch: Batch, doc: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    """The document (by place, i.e. by doc_id) that is least for each name."""
    least = np.full(n, len(batch.ids), dtype=np.int64)
    np.minimum.at(least, index, doc)
    return least


def _second_pass(ranges: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (key, batch), found in zip(_rows(pdf), pdf["found"]):
                at, doc, index, names = batch.candidates(_shared_offsets(batch, _known(found), ranges))
                least = _least(batch, doc, index, len(names))
                bounds, out = _range_of(names, ranges), []
                width, bits = _range_bits(ranges)
                for r in range(ranges):
                    i, j = bounds[r], bounds[r + 1]
                    if i < j:
                        used, place = np.unique(least[i:j], return_inverse=True)
                        own = _packed(names[i:j] % np.uint64(width), bits)
                        out.append((r, key, own, _fixed(place, len(used).bit_length()), batch.ids[used]))
                yield pd.DataFrame(out, columns=["part", "batch", "names", "least", "ids"])

    return run


def _earlier(ranges: int):
    """A bit for each name of each batch: another batch has it in a document
    with a smaller doc_id than any of this batch."""
    width = _range_bits(ranges)[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_part(batches):
            names = [_unpacked(r.names, width) for r in rows]
            sizes = np.cumsum([0] + [len(x) for x in names])
            docs = np.concatenate(
                [np.asarray(r.ids, np.int64)[_unfixed(r.least, len(x), len(r.ids).bit_length()).astype(np.int64)] for r, x in zip(rows, names)]
            )
            flat = np.concatenate(names)
            order = np.argsort(flat, kind="stable")
            new = np.concatenate(([True], flat[order][1:] != flat[order][:-1]))
            least = np.minimum.reduceat(docs[order], np.flatnonzero(new))
            earlier = np.empty(len(flat), dtype=bool)
            earlier[order] = least[np.cumsum(new) - 1] < docs[order]
            yield pd.DataFrame(
                [(r.batch, r.part, np.packbits(earlier[i:j]).tobytes()) for r, i, j in zip(rows, sizes, sizes[1:])],
                columns=["batch", "part", "bits"],
            )

    return run


def _last_pass(ranges: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (_, batch), found, later in zip(_rows(pdf), pdf["found"], pdf["earlier"]):
                at, doc, index, names = batch.candidates(_shared_offsets(batch, _known(found), ranges))
                least, bounds = _least(batch, doc, index, len(names)), _range_of(names, ranges)
                earlier, bits = np.zeros(len(names), dtype=bool), _known(later)
                for r in range(ranges):
                    i, j = bounds[r], bounds[r + 1]
                    if i < j:
                        earlier[i:j] = _bits(bits, r, j - i)
                covered = earlier[index] | (batch.ids[least[index]] < batch.ids[doc])
                yield _results(batch, at[covered])

    return run


def _results(batch: Batch, starts: np.ndarray) -> pd.DataFrame:
    """Per document: what is removed if strings start at ``starts``."""
    mark = np.zeros(len(batch.bytes) + 1, dtype=np.int32)
    mark[starts] += 1
    np.subtract.at(mark, starts + WIDTH, 1)
    gone = np.cumsum(mark[:-1]) > 0
    for i, j in zip(batch.starts[batch.copy].tolist(), batch.ends[batch.copy].tolist()):
        gone[i:j] = j - i >= WIDTH
    out = []
    for doc, i, j in zip(batch.ids.tolist(), batch.starts.tolist(), batch.ends.tolist()):
        g = gone[i:j]
        edge = np.diff(np.concatenate(([0], g.view(np.int8), [0])))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        kept = batch.bytes[i:j][~g].tobytes()
        out.append((doc, j - i, int(g.sum()), len(begin), hashlib.sha256(kept).hexdigest(), np.stack([begin, end], axis=1).ravel()))
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def _batched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents to batches of some BATCH_BYTES, each in doc_id order."""
    part, made = TaskContext.get().partitionId(), 0

    def closed(held: list[tuple[int, bytes]]) -> pd.DataFrame:
        held.sort()
        ends = np.cumsum([len(b) for _, b in held])
        key = (part << 32) | made
        return pd.DataFrame(
            {
                "batch": [key],
                "ids": [[d for d, _ in held]],
                "ends": [ends],
                "digests": [[hashlib.md5(b, usedforsecurity=False).digest() for _, b in held]],
                "text": [b"".join(b for _, b in held)],
            }
        )

    held, size = [], 0
    for pdf in batches:
        for doc, text in zip(pdf["doc_id"], pdf["text"]):
            raw = (text or "").encode("utf-8", "surrogatepass")
            held.append((int(doc), raw))
            size += len(raw)
            if size >= BATCH_BYTES:
                yield closed(held)
                held, size, made = [], 0, made + 1
    if held:
        yield closed(held)


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 (of the remaining bytes) and spans (begin and end bytes of the
    removed runs, flat, in order).

    The result is a written table; all others are dropped at the end.

    Cases: null and empty texts have no bytes; texts under WIDTH bytes lose
    nothing; rows that repeat a doc_id don't remove each other's strings; a row
    without doc_id is before or after none: it loses nothing and removes nothing;
    a text is one row and is held whole; other columns are ignored; no documents
    give no rows."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = F.octet_length("text").cast("long")
    nothing = F.lit(0).cast("long")
    nameless = base.filter("doc_id IS NULL").select(
        "doc_id", size.alias("n_bytes"), nothing.alias("n_removed"), nothing.alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), F.array().cast("array<bigint>").alias("spans"),
    )

    total = base.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    ranges = max(RANGES, total // RANGE_BYTES)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total >> 26, 8)
    table = f"suffix_batches_{uuid.uuid4().hex[:12]}"
    base.filter("doc_id IS NOT NULL").mapInPandas(
        _batched, "batch long, ids array<long>, ends array<long>, digests array<binary>, text binary"
    ).write.bucketBy(buckets, "batch").option("compression", "zstd").saveAsTable(table)
    try:
        # rows are batches of some megabytes: a worker gets two at a time, not all of its bucket
        with Scratch(spark) as scratch, arrow_records(spark, 2):
            return _resolved(spark.table(table), nameless, ranges, scratch)
    finally:
        spark.sql(f"DROP TABLE {table}")


def _resolved(texts: DataFrame, nameless: DataFrame, ranges: int, scratch: Scratch) -> DataFrame:
    """The passes over the batches' table; the result is written."""
    # places of the texts that a smaller doc_id has too, per batch
    each = texts.select("batch", F.posexplode(F.arrays_zip("ids", "digests")).alias("place", "x"))
    each = each.select("batch", "place", F.col("x.ids").alias("doc_id"), F.col("x.digests").alias("digest"))
    # a table of its own, so that AQE can split a hot digest in the join with it
    repeated = scratch.written(
        each.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "text-repeated",
    )
    copies = scratch.written(
        each.join(repeated, "digest").filter("doc_id <> first").groupBy("batch").agg(F.collect_list("place").alias("copies")),
        "text-copies",
    )
    batches = texts.drop("digests").join(copies, "batch", "left")

    def per_batch(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("batch").agg(F.collect_list(F.struct("part", "bits")).alias(name))

    def sorted_parts(rows: DataFrame) -> DataFrame:
        return rows.repartitionById(ranges, "part").sortWithinPartitions("part")  # a task each

    bits = "batch long, part int, bits binary"
    named = batches.mapInPandas(_first_pass(ranges), "part int, batch long, names binary, several binary")
    shared = scratch.written(sorted_parts(named).mapInPandas(_shared_names(ranges), bits), "shared-names")
    found = batches.join(per_batch(shared, "found"), "batch", "left")
    suffixes = found.mapInPandas(_second_pass(ranges), "part int, batch long, names binary, least binary, ids array<long>")
    earlier = scratch.written(sorted_parts(suffixes).mapInPandas(_earlier(ranges), bits), "earlier-names")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    marked = found.join(per_batch(earlier, "earlier"), "batch", "left").mapInPandas(_last_pass(ranges), schema)
    return written(marked.union(nameless), "without-repeats")


def repeats_sql() -> str:
    """The query by all windows of bytes, in DuckDB SQL. Bytes are pairs of hex digits."""
    return f"""
WITH doc AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents
), win AS (
  SELECT doc_id, i, substring(h, 2 * i + 1, {2 * WIDTH}) AS w
  FROM (SELECT doc_id, h, unnest(range(0, n - {WIDTH - 1})) AS i FROM doc WHERE n >= {WIDTH})
), shared AS (
  SELECT w, min(doc_id) AS first FROM win GROUP BY w HAVING min(doc_id) < max(doc_id)
), hit AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {WIDTH}, true) AS new
  FROM win JOIN shared USING (w) WHERE doc_id > first
), run AS (
  SELECT doc_id, min(i) AS b, max(i) + {WIDTH} AS e
  FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM hit) GROUP BY doc_id, g
), cut AS (  -- what is kept before each run, and after the last
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS b, b AS e FROM run
  UNION ALL SELECT doc_id, coalesce(max(e), 0), max(n) FROM doc LEFT JOIN run USING (doc_id) GROUP BY doc_id
), kept AS (
  SELECT doc_id, coalesce(string_agg(substring(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b) FILTER (WHERE e > b), '') AS h
  FROM cut JOIN doc USING (doc_id) GROUP BY doc_id
), removed AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM doc JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""
