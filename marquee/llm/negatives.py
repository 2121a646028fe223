"""Hard-negative mining with an inverted multi-index.

Vectors are integers, scores integer inner products. Both halves of the
dimensions have a codebook of their own; a row's cell is the pair of its nearest
centroids. A half-score with an anchor's half a is at most a * centroid +
|a| * radius, the radius being the largest distance of any row to its centroid,
and at least a * centroid - |a| * radius. The sum over both halves bounds all
scores of a cell.

A search asks, for each anchor, for the best ``k`` rows of some score windows:
first one unbounded window for the positives, then one window for each positive.
A heap over the two sorted sequences of half-bounds (multi-sequence) gives an
anchor's cells by falling bound. They are visited in rounds of growing numbers of
rows, and an anchor is done when the next bound is below the k-th best score of
every window (or the window's lower end): what is found is certified, not
approximate. Where bounds are loose -- many dimensions, no structure -- that means most cells,
so cells are compared as matrices.

A round on Spark: batches of anchors run their heaps and give (batch, cell)
visits; visits are joined to the cells' blocks of rows, dealt by (batch,
bucket of blocks), and stream past their batch; only rows that enter a window's
best leave a task. A hot cell is many blocks. Rounds are written tables.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_records, written
from .vectors import integer_vectors

SAMPLE = 16_384  # rows the codebooks are fitted on; every row is indexed
CELL_ROWS = 128  # aimed at, while the codebooks have at most CENTROIDS
CENTROIDS = 256
BLOCK = 512  # rows of a cell that are compared at once
BATCH = 256  # anchors compared at once
GROUP = 128  # blocks that stream past a batch in one group
FIRST_ROUND, GROWTH = 4096, 8  # rows an anchor visits in its first round; growth of their number
LARGEST = float(1 << 22)  # of an integer entry: 100 x scores of 4096 dimensions fit a long


def _half_distances(z: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return np.maximum(np.square(z).sum(axis=1)[:, None] - 2 * z @ centroids.T + np.square(centroids).sum(axis=1), 0)


def _codebook(z: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means centroids (fewer if there are fewer distinct rows), from distinct
    rows at even ranks of the first coordinates' order."""
    distinct = np.unique(z, axis=0)
    out = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(rounds):
        own = _half_distances(z, out).argmin(axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, own, z)
        n = np.bincount(own, minlength=len(out))[:, None]
        out = np.where(n > 0, sums / np.maximum(n, 1), out)
    return out


class Codebooks:
    """The halves' centroids and radii, and each cell's rows and blocks."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.centroids = (first, second)
        self.cut = first.shape[1]
        self.radii: list[np.ndarray] = []
        self.rows = self.blocks = np.zeros((len(first), len(second)), dtype=np.int64)

    def halves(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return z[:, : self.cut], z[:, self.cut :]

    def assigned(self, z: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(centroid, distance to it) of each row, for both halves."""
        out = []
        for half, centroids in zip(self.halves(z), self.centroids):
            own = _half_distances(half, centroids).argmin(axis=1)
            out.append((own, np.linalg.norm(half - centroids[own], axis=1)))
        return out

    def bounds(self, z: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(lowest, highest) half-scores of anchors (rows) with clusters (columns),
        with room for rounding."""
        out = []
        for half, centroids, radius in zip(self.halves(z), self.centroids, self.radii):
            size = np.linalg.norm(half, axis=1)[:, None]
            middle, reach = half @ centroids.T, size * radius
            reach = reach + 1e-9 * (reach + size * np.linalg.norm(centroids, axis=1)) + 1e-6
            out.append((middle - reach, middle + reach))
        return out


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all pairs by falling sum first[i] + second[j]: a heap holds
    at most one pair of each row of the sorted grid."""
    rows, columns = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[rows].tolist(), second[columns].tolist()
    rows, columns = rows.tolist(), columns.tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        s, i, j = heapq.heappop(heap)
        yield -s, rows[i], columns[j]
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def cells_to_visit(
    books: Codebooks, low: list[np.ndarray], high: list[np.ndarray], need: float, top: float, done: int, budget: int
) -> list[tuple[int, int]]:
    """The cells an anchor visits when its first ``done`` rows are visited: by
    falling bound, up to ``budget`` rows, while a cell may hold a score of
    ``need`` or more. Cells whose scores are all above ``top`` are left out."""
    seen, out = 0, []
    for bound, i, j in multi_sequence(high[0], high[1]):
        if bound < need or seen >= budget:
            break
        n = int(books.rows[i, j])
        if n == 0 or low[0][i] + low[1][j] > top:
            continue
        if seen >= done:
            out.append((i, j))
        seen += n
    return out


def _matrix(raw: bytes, d: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i4").reshape(-1, d)


def _scores(z: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products (rows x anchors): in doubles while they hold them."""
    size = max(1, z.shape[1]) * float(np.abs(z).max(initial=0)) * float(np.abs(anchors).max(initial=0))
    if size < 1 << 53:
        return (z.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return z.astype(np.int64) @ anchors.astype(np.int64).T


def _indexed(books: Codebooks):
    k = len(books.centroids[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                z = np.stack(pdf["x"].to_numpy()).astype("<i4")
                (i, r1), (j, r2) = books.assigned(z.astype(np.float64))
                yield pd.DataFrame(
                    {"vec_id": pdf["vec_id"], "label": pdf["label"], "z": [row.tobytes() for row in z], "cell": i * k + j, "i": i, "j": j, "r1": r1, "r2": r2}
                )

    return run


def _packed(size: int, by_cell: bool):
    """Sorted rows to blocks of up to ``size`` rows, of one cell each if ``by_cell``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made, held = TaskContext.get().partitionId(), 0, None

        def closed(rows: pd.DataFrame) -> pd.DataFrame:
            nonlocal made
            made += 1
            return pd.DataFrame(
                {
                    "block": [(part << 32) | made],
                    "cell": [rows["cell"].iloc[0]],
                    "n": [len(rows)],
                    "ids": [rows["vec_id"].to_numpy("<i8").tobytes()],
                    "labels": [rows["label"].to_numpy("<i8").tobytes()],
                    "z": [b"".join(rows["z"])],
                }
            )

        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            cells = held["cell"].to_numpy()
            at = 0
            while at < len(held):
                end = min(at + size, np.searchsorted(cells, cells[at], "right") if by_cell else len(held))
                if end == len(held) and end - at < size:
                    break  # it may go on in the next batch
                yield closed(held.iloc[at:end])
                at = end
            held = held.iloc[at:]
        if held is not None and len(held):
            yield closed(held)

    return run


_BLOCK_SCHEMA = "block long, cell int, n int, ids binary, labels binary, z binary"
_WINDOWS = "array<struct<at:int,w:int,lo:bigint,hi:bigint,need:bigint>>"


def _window_arrays(windows) -> dict[str, np.ndarray]:
    return {c: np.array([x[c] for x in windows], dtype=np.int64) for c in ("at", "w", "lo", "hi", "need")}


def _visits(books: Codebooks, d: int, done: int, budget: int):
    k = len(books.centroids[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for batch, z, windows in zip(pdf["block"], pdf["z"], pdf["windows"]):
                w = _window_arrays(windows)
                anchors = _matrix(z, d).astype(np.float64)
                (low1, high1), (low2, high2) = books.bounds(anchors)
                masks: dict[tuple[int, int], np.ndarray] = {}
                for a in np.unique(w["at"]).tolist():
                    own = w["at"] == a
                    for cell in cells_to_visit(
                        books, [low1[a], low2[a]], [high1[a], high2[a]],
                        float(w["need"][own].min()), float(w["hi"][own].max()), done, budget,
                    ):
                        masks.setdefault(cell, np.zeros(len(anchors), dtype=bool))[a] = True
                out += [(batch, i * k + j, np.packbits(m).tobytes(), int(books.blocks[i, j])) for (i, j), m in masks.items()]
            yield pd.DataFrame(out, columns=["batch", "cell", "mask", "n_blocks"])

    return run


class _Best:
    """The best k (score, id) of each window of one batch of anchors."""

    def __init__(self, ids: bytes, labels: bytes, z: bytes, windows, d: int, k: int, same: bool):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.z, self.k, self.same = _matrix(z, d), k, same
        self.w = _window_arrays(windows)
        self.need = self.w["need"].copy()  # rises with what is found here
        self.found = np.empty((0, 3), dtype=np.int64)  # window, -score, id

    def add(self, ids: np.ndarray, labels: np.ndarray, z: np.ndarray, mask: np.ndarray) -> None:
        use = np.flatnonzero(mask[self.w["at"]])
        if not len(use):
            return
        anchors, column = np.unique(self.w["at"][use], return_inverse=True)
        scores = _scores(z, self.z[anchors])[:, column]
        at = anchors[column]
        ok = (scores >= np.maximum(self.w["lo"], self.need)[use]) & (scores <= self.w["hi"][use])
        ok &= (labels[:, None] == self.labels[at]) == self.same
        ok &= ids[:, None] != self.ids[at]
        if len(ids) > self.k:  # at least the k-th best of this block, ties included
            lowest = np.iinfo(np.int64).min
            kth = np.partition(np.where(ok, scores, lowest), len(ids) - self.k, axis=0)[len(ids) - self.k]
            ok &= scores >= kth
        row, col = np.nonzero(ok)
        if not len(row):
            return
        new = np.stack([use[col], -scores[row, col], ids[row]], axis=1)
        all_ = np.concatenate([self.found, new])
        all_ = all_[np.lexsort((all_[:, 2], all_[:, 1], all_[:, 0]))]
        rank = np.arange(len(all_)) - np.searchsorted(all_[:, 0], all_[:, 0])
        self.found = all_[rank < self.k]
        full = self.found[rank[rank < self.k] == self.k - 1]
        self.need[full[:, 0]] = np.maximum(self.need[full[:, 0]], -full[:, 1])

    def rows(self) -> pd.DataFrame:
        own = self.found[:, 0]
        at = self.w["at"][own]
        return pd.DataFrame({"anchor_id": self.ids[at], "w": self.w["w"][own].astype("int32"), "score": -self.found[:, 1], "id": self.found[:, 2]})


def _scored(d: int, k: int, same: bool):
    """Sorted rows of (batch, bucket) groups, the batch first and then its blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in batches:
            for kind, ids, labels, z, mask, windows in zip(*(pdf[c] for c in ("kind", "ids", "labels", "z", "mask", "windows"))):
                if kind == 0:
                    if best is not None:
                        yield best.rows()
                    best = _Best(ids, labels, z, windows, d, k, same)
                else:
                    bits = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(best.ids)).astype(bool)
                    best.add(np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), _matrix(z, d), bits)
        if best is not None:
            yield best.rows()

    return run


class MultiIndex:
    """The inverted multi-index of rows (vec_id, label, x)."""

    def __init__(self, rows: DataFrame, d: int, scratch: Scratch):
        self.d, self.spark, self.scratch = d, rows.sparkSession, scratch
        total = rows.count()
        k = int(min(CENTROIDS, max(1, round((total / CELL_ROWS) ** 0.5))))
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("x").collect()
        z = np.array([r["x"] for r in sample], dtype=np.float64).reshape(-1, d)
        cut = d // 2
        self.books = Codebooks(_codebook(z[:, :cut], k), _codebook(z[:, cut:], k))
        schema = "vec_id long, label long, z binary, cell int, i int, j int, r1 double, r2 double"
        self.rows = scratch.written(rows.mapInPandas(_indexed(self.books), schema), "multi-index-rows")
        self._radii()
        ordered = self._ordered(self.rows)
        self.blocks = scratch.written(ordered.mapInPandas(_packed(BLOCK, True), _BLOCK_SCHEMA), "multi-index-blocks")
        shape = (len(self.books.centroids[0]), len(self.books.centroids[1]))
        counts = self.blocks.groupBy("cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("blocks")).collect()
        self.books.rows, self.books.blocks = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
        for c in counts:  # at most CENTROIDS squared
            self.books.rows.flat[c["cell"]], self.books.blocks.flat[c["cell"]] = c["n"], c["blocks"]

    def _radii(self) -> None:
        self.books.radii = []
        for code, distance, centroids in zip("ij", ("r1", "r2"), self.books.centroids):
            radius = np.zeros(len(centroids))
            for r in self.rows.groupBy(code).agg(F.max(distance).alias("r")).collect():
                radius[r[code]] = r["r"]
            self.books.radii.append(radius)

    @staticmethod
    def _ordered(rows: DataFrame) -> DataFrame:
        """By cell; a hot cell is cut by hash."""
        salted = rows.select("vec_id", "label", "z", "cell", F.xxhash64("vec_id").alias("salt"))
        return salted.repartitionByRange("cell", "salt").sortWithinPartitions("cell", "salt")

    def batches(self, condition: Column | str) -> DataFrame:
        """Anchors, in batches of neighbours."""
        return self.scratch.written(self._ordered(self.rows.filter(condition)).mapInPandas(_packed(BATCH, False), _BLOCK_SCHEMA), "multi-index-anchors")

    def search(self, batches: DataFrame, windows: DataFrame, k: int, same: bool) -> DataFrame:
        """anchor_id, w, score, id: for each window (anchor_id, block, at, w, lo,
        hi) the best k rows of the anchor's label (or of the others) in it, except
        the anchor; higher scores first, ties by smaller id."""
        n_batches = batches.count()
        best, done, budget = None, 0, FIRST_ROUND
        while True:
            now = windows
            if best is not None:
                kth = best.groupBy("anchor_id", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
                now = windows.join(kth, ["anchor_id", "w"], "left")
                now = now.withColumn("need", F.when(F.col("n") >= k, F.greatest("lo", "kth")).otherwise(F.col("lo")))
            else:
                now = windows.withColumn("need", F.col("lo"))
            # a batch has at most BATCH anchors, each with a window for each positive
            per_batch = now.groupBy("block").agg(F.collect_list(F.struct("at", "w", "lo", "hi", "need")).cast(_WINDOWS).alias("windows"))
            with arrow_records(self.spark, 32):  # rows are blocks; ten thousand at once would be gigabytes
                asking = self.scratch.written(batches.join(per_batch, "block"), "multi-index-asking")
                visits = self.scratch.written(
                    asking.mapInPandas(_visits(self.books, self.d, done, budget), "batch long, cell int, mask binary, n_blocks long"),
                    "multi-index-visits",
                )
                pairs = visits.agg(F.sum("n_blocks")).first()[0]
                if not pairs:
                    return best if best is not None else self.spark.createDataFrame([], "anchor_id long, w int, score long, id long")
                found = self._round(asking, visits, pairs, n_batches, k, same)
                if best is not None:
                    found = found.unionByName(best)
                order = Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "id")
                ranked = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")
                best = self.scratch.written(ranked, f"multi-index-best-{budget}")
                self.scratch.done("multi-index-asking", "multi-index-visits")
            done, budget = budget, budget * GROWTH

    def _round(self, asking: DataFrame, visits: DataFrame, pairs: int, n_batches: int, k: int, same: bool) -> DataFrame:
        buckets = -(-pairs // (n_batches * GROUP))
        none = F.lit(None)
        bucket = F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("int").alias("bucket")
        blocks = self.blocks.join(visits.select("batch", "cell", "mask"), "cell").select(
            "batch", bucket, F.lit(1).alias("kind"), "ids", "labels", "z", "mask", none.cast(_WINDOWS).alias("windows")
        )
        used = asking.join(visits.select(F.col("batch").alias("block")).distinct(), "block", "left_semi")
        anchors = used.select(
            F.col("block").alias("batch"), F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
            F.lit(0).alias("kind"), "ids", "labels", "z", none.cast("binary").alias("mask"), "windows",
        )
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), min(20_000, n_batches * buckets))
        dealt = blocks.unionByName(anchors).repartition(tasks, "batch", "bucket").sortWithinPartitions("batch", "bucket", "kind")
        return dealt.mapInPandas(_scored(self.d, k, same), "anchor_id long, w int, score long, id long")


def _floor_percent(score: Column, percent: int) -> Column:
    x = score * F.lit(percent).cast("long")
    return ((x - F.pmod(x, F.lit(100).cast("long"))) / 100).cast("long")


def hard_negatives(
    table: DataFrame, anchors: Column | str, *, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``table`` has vec_id, embedding and label; entries c become floor(scale * c)
    and a row's score is its inner product with the anchor. Anchors are the rows
    for which ``anchors`` (on vec_id and label) holds; their positives the first
    ``positives`` other rows of their label. For each, the first ``negatives`` rows of
    other labels with low * positive_score <= 100 * score <= high * positive_score,
    numbered by rank. First: higher scores, ties by smaller vec_id. Exact.

    Cases: rows with a null label, vec_id or vector, or a null or non-finite
    entry, take no part, nor do entries of 2^22 or more after scaling (scores
    must fit a long) and vectors of another than the commonest length. Rows that
    repeat a vec_id count once (the one with the least label and vector). An anchor
    without other rows of its label, or a positive without rows in its window
    (always so where its score is negative), gives no rows; empty tables neither.
    Other columns are ignored. The result is a written table."""
    with Scratch(table.sparkSession) as scratch:
        return _mined(table, anchors, positives, negatives, low, high, scale, scratch)


def _mined(
    table: DataFrame, anchors: Column | str, positives: int, negatives: int, low: int, high: int, scale: int, scratch: Scratch
) -> DataFrame:
    spark = table.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    usable, d = integer_vectors(table, key="vec_id", vector="embedding", scale=scale, shift=0, below=LARGEST, keep=("label",))
    if d == 0:
        return spark.createDataFrame([], schema)
    labelled = usable.select("vec_id", F.col("label").cast("long").alias("label"), "x").dropna(subset=["vec_id", "label"])
    one = labelled.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")
    rows = scratch.written(one, "multi-index-vectors")
    if rows.isEmpty():
        return spark.createDataFrame([], schema)
    index = MultiIndex(rows, d, scratch)
    batches = index.batches(anchors)

    everything = 1 << 62
    places = scratch.written(batches.select("block", "ids", "n").mapInPandas(_places, "block long, at int, anchor_id long"), "multi-index-places")
    open_windows = places.select("*", F.lit(0).alias("w"), F.lit(-everything).alias("lo"), F.lit(everything).alias("hi"))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = index.search(batches, open_windows, positives, True)
    chosen = found.select("anchor_id", F.row_number().over(order).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    chosen = scratch.written(chosen, "multi-index-positives")
    score = F.col("positive_score")
    asked = chosen.join(places, "anchor_id").select(
        "block", "at", "anchor_id", "w", (-_floor_percent(-score, low)).alias("lo"), _floor_percent(score, high).alias("hi")
    )
    answered = index.search(batches, scratch.written(asked.filter("lo <= hi"), "multi-index-windows"), negatives, False)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "id"))
    out = (
        answered.withColumn("rank", rank)
        .join(chosen, ["anchor_id", "w"])
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
    return written(out, "hard-negatives")


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for block, ids, n in zip(pdf["block"], pdf["ids"], pdf["n"]):
            yield pd.DataFrame({"block": block, "at": np.arange(n, dtype="int32"), "anchor_id": np.frombuffer(ids, "<i8")})


def negatives_sql() -> str:
    """The query by brute force, in DuckDB SQL."""
    return """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS z
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_sum(list_transform(range(1, len(a.z) + 1), lambda i: a.z[i] * r.z[i]))::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= 5"""
