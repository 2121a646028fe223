"""Best-fit packing by patterns: non-negative least squares on the length
histogram, then best fit for what rounding leaves.

The pieces are tokenised and ranked on Spark; the plan is made from the length
histogram alone, which has ``seq_len`` bins whatever the corpus size.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import texts, written

RANK_BUCKET = 512  # pieces of one length that are numbered in one group

# Letters, digits and white space of Latin-1, where lower-casing and NFC are
# plain; what the vocabulary's own pre-tokeniser matches there.
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ÿ"
_DIGITS = "0-9²³¹¼-¾"
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^ \t-\r\x85\xa0{_LETTERS}{_DIGITS}]+"
)


_BEYOND = re.compile(r"[^\x00-\xff]")
# The normaliser and pre-tokeniser that _LATIN and the cuts at blanks are equal to. Fixed values.
_NORMALISER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PRE_TOKENISER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _cut_as_here(tokenizer) -> bool:
    """Whether texts may be cut into pre-tokens here: another vocabulary's rules
    need the whole text."""
    spec = json.loads(tokenizer.to_str())
    return (
        spec["normalizer"] == _NORMALISER
        and spec["pre_tokenizer"] == _PRE_TOKENISER
        and spec["post_processor"] is None
        and spec["model"]["type"] == "BPE"
        and spec["model"]["dropout"] is None
        and all("<|" in t["content"] for t in spec["added_tokens"])
    )


def _byte_symbols() -> dict[int, str]:
    """Latin-1 characters as a byte-level vocabulary spells their UTF-8 bytes:
    printable bytes stand for themselves, the others for U+0100 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(shown)]
    symbol = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return {c: "".join(symbol[b] for b in chr(c).encode()) for c in range(256)}


class _Ids(dict):
    """Latin-1 pre-token -> its ids as little-endian unsigned 32-bit, by the
    vocabulary's own merges; ``parts`` has the same for parts of other texts.
    Both are emptied at ``bound`` entries."""

    def __init__(self, path: str, bound: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.bound = Tokenizer.from_file(path), bound
        self.model, self.symbols, self.parts = self.tokenizer.model, _byte_symbols(), {}
        self.cut = _cut_as_here(self.tokenizer)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        out = self[word] = array("I", [t.id for t in self.model.tokenize(word.translate(self.symbols))]).tobytes()
        return out

    def part(self, text: str) -> bytes:
        out = self.parts.get(text)
        if out is None:
            if len(self.parts) >= self.bound // 4:
                self.parts.clear()
            out = self.parts[text] = self.whole(text)
        return out


def _ids_of_worker(path: str) -> _Ids:
    """One cache per vocabulary and Python worker, kept across its tasks."""
    state = sys.modules.setdefault("_marquee_worker", types.ModuleType("_marquee_worker"))
    caches = state.__dict__.setdefault("ids", {})
    if path not in caches:
        caches[path] = _Ids(path)
    return caches[path]


def token_ids(text: str | None, ids: _Ids) -> bytes:
    """The vocabulary's ids of a text. Where its pre-tokeniser is the one known here,
    it cuts at white space and between letters, digits and marks, and nothing
    crosses those cuts, so a text is the concatenation of its pre-tokens' ids.
    Latin-1 texts are cut by an equal pattern; others at blanks, each part left to
    the vocabulary. Texts with a special token's string, and all texts of other
    vocabularies, are given to it whole."""
    if not text:
        return b""
    if not ids.cut or "<|" in text:
        return ids.whole(text)
    if text.isascii() or _BEYOND.search(text) is None:
        return b"".join(map(ids.__getitem__, _LATIN.findall(text.lower())))
    return b"".join(map(ids.part, re.split(r"[ \n\t\r]+", text)))


def token_pieces(docs: DataFrame, path: str, *, seq_len: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): each text's ids and
    then ``end_id``, cut into pieces of ``seq_len`` where longer."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * seq_len

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _ids_of_worker(path)
        for pdf in batches:
            out: list[tuple] = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                raw = token_ids(text, cache) + end
                for k in range(0, len(raw), step):
                    part = raw[k : k + step]
                    row = (doc, k // step, k // 4, len(part) // 4, zlib.crc32(part))
                    out.append(row + (np.frombuffer(part, dtype="<u4").astype(np.int32),) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            made = pd.DataFrame(out, columns=names)
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    return texts(docs).mapInPandas(run, schema)


def patterns(lengths: np.ndarray, seq_len: int) -> np.ndarray:
    """All patterns of one to three of the given lengths that fill ``seq_len``
    exactly, one row each, longest first, 0 where there are fewer."""
    there = np.zeros(seq_len + 1, dtype=bool)
    there[lengths] = True
    there[0] = True
    out = []
    for a in lengths[::-1]:
        rest = seq_len - a
        if rest > 2 * a:
            break
        b = np.arange((rest + 1) // 2, min(a, rest) + 1)
        c = rest - b
        ok = there[b] & there[c]
        out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], axis=1))
    return np.concatenate(out) if out else np.empty((0, 3), dtype=np.int64)


def fit(pattern: np.ndarray, counts: np.ndarray, seq_len: int, rounds: int = 200) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |W (A x - counts)|, A the patterns'
    lengths, by accelerated projected gradients. W weighs a length's misfit by
    the length: what is left over of short ones is easy to place."""
    if not len(pattern):
        return np.zeros(0)
    weight = np.arange(seq_len + 1) / seq_len
    weight[0] = 0.0
    w2 = weight**2

    def usage(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(pattern[:, k], x, seq_len + 1) for k in range(3))

    # step: the largest eigenvalue of A'W'WA, by power iteration
    v = np.ones(len(pattern))
    for _ in range(15):
        r = usage(v) * w2
        v = r[pattern].sum(axis=1)
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(pattern))
    t = 1.0
    for _ in range(rounds):
        r = (usage(y) - counts) * w2
        new = np.maximum(0, y - r[pattern].sum(axis=1) / (1.05 * norm))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def rounded(x: np.ndarray, pattern: np.ndarray, counts: np.ndarray) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Whole repeat counts near x that never use more pieces than there are
    (rounding errors are carried to the next pattern of the same longest
    length); and the counts left."""
    left, used = counts.copy(), []
    total = np.cumsum(x)
    first = np.concatenate(([True], pattern[1:, 0] != pattern[:-1, 0])) if len(pattern) else np.empty(0, dtype=bool)
    base = np.maximum.accumulate(np.where(first, total - x, 0)) if len(x) else total
    upto = np.floor(total - base + 0.5)
    repeat = np.diff(np.concatenate(([0], upto)))
    repeat[first] = upto[first]
    for k in np.flatnonzero(repeat > 0):
        lens = tuple(int(n) for n in pattern[k] if n)
        need = {n: lens.count(n) for n in lens}
        n = min([int(repeat[k]), *(int(left[m]) // c for m, c in need.items())])
        if n > 0:
            for m, c in need.items():
                left[m] -= n * c
            used.append((lens, n))
    return used, left


def best_fit(counts: np.ndarray, seq_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: bins with the same contents are one
    entry with a count, so the work depends on the lengths, not on the pieces."""
    free: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    order: list[int] = []

    def put(space: int, lens: tuple[int, ...], n: int) -> None:
        if space not in free:
            free[space] = []
            insort(order, space)
        free[space].append((lens, n))

    for size in np.flatnonzero(counts)[::-1]:
        size, n = int(size), int(counts[size])
        while n:
            at = bisect_left(order, size)
            if at < len(order):
                space = order[at]
                lens, bins = free[space].pop()
                if not free[space]:
                    del free[space], order[at]
            else:
                space, lens, bins = seq_len, (), n
            each = min(space // size, n)
            m = min(bins, n // each)
            if bins > m and lens:
                put(space, lens, bins - m)
            put(space - each * size, lens + (size,) * each, m)
            n -= m * each
    return [entry for space in free.values() for entry in space]


def plan(counts: np.ndarray, seq_len: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every piece of the histogram once."""
    pattern = patterns(np.flatnonzero(counts), seq_len)
    used, left = rounded(fit(pattern, counts, seq_len), pattern, counts)
    return used + best_fit(left, seq_len)


def slots(packed: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Ranges of ranks per length: the pieces of that length with ranks from
    ``rank`` on go to sequences ``sequence`` on, at ``offset``. Sorted by length
    and rank."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for lens, n in packed:
        offset = 0
        for size in lens:
            rank = used.get(size, 0)
            used[size] = rank + n
            rows.append((size, rank, base, offset))
            offset += size
        base += n
    rows.sort()
    names = ("length", "rank", "sequence", "offset")
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)}


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``pieces`` with ``rank``, 0.. within each length. A length is dealt out
    to groups of about RANK_BUCKET pieces; the groups' sizes give their bases."""
    spark = pieces.sparkSession
    groups = spark.createDataFrame([(n, -(-c // RANK_BUCKET)) for n, c in counts.items()], "length long, groups long")
    dealt = pieces.join(F.broadcast(groups), "length").withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "piece"), "groups")
    )
    sizes = dealt.groupBy("length", "group").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("length", "group", F.coalesce(before, F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("length", "group").orderBy("doc_id", "piece"))
    return (
        dealt.withColumn("number", number)
        .join(bases, ["length", "group"])
        .withColumn("rank", F.col("base") + F.col("number") - 1)
        .drop("groups", "group", "number", "base")
    )


def pack(docs: DataFrame, path: str, *, seq_len: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids). The pieces of a sequence fill it gaplessly from 0.

    The driver holds the histogram (``seq_len`` counts) and the plan, whose size
    is bounded by the number of patterns of up to three lengths, not by the
    corpus; the plan is broadcast.

    Cases: null and empty texts are one piece, the end id; rows that repeat a
    doc_id or a whole row are packed like any others; a null doc_id stays null;
    other columns are ignored; no documents give no rows."""
    pieces = written(token_pieces(docs, path, seq_len=seq_len, end_id=end_id, with_ids=with_ids), "token-pieces")
    counted = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= seq_len rows
    histogram = np.zeros(seq_len + 1, dtype=np.int64)
    for n, c in counted.items():
        histogram[n] = c
    table = slots(plan(histogram, seq_len))
    shared = pieces.sparkSession.sparkContext.broadcast(table)

    @pandas_udf("struct<sequence_id long, offset long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = shared.value
        # (length, rank) as one order-preserving key
        at = np.searchsorted((t["length"] << 48) | t["rank"], (length.to_numpy() << 48) | rank.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": t["sequence"][at] + rank.to_numpy() - t["rank"][at], "offset": t["offset"][at]})

    out = ranked(pieces, counted).withColumn("place", place("length", "rank"))
    return out.select(*pieces.columns, "place.sequence_id", "place.offset")
