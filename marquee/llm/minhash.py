"""MinHash near-dedup with tensored banding.

A document's set is its distinct ``width``-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``). Two small collections U and V of ``m`` parts each
(a part combines ``parts`` minhashes) give m * m tables: table (i, j) has the
key (U_i, V_j). So 2 * m * parts minhashes do the work of m * m * 2 * parts --
about the square root. A pair is a candidate if it shares a key in any table;
at similarity s it is missed with probability at most 2 * (1 - s**parts)**m,
and ``m`` is chosen so that this is below ``miss`` at the threshold.

Tables are not materialised: rows are dealt by U part, and within a U group a
pair shares table (i, j) iff it also agrees in V_j. A pair is looked at only in
the group of its first common U part, so once. Groups above ``HOT`` members
have leaders, and each member is first compared with one of them: those similar to
the same are connected, so pairs among them need no look, and a large group of near
copies costs one comparison for each. What is left is dealt out as pairs of blocks.
Candidates are confirmed on full sets, inside
the group, and only a spanning forest of the confirmed links leaves it -- never
all pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_records, free_name, texts, with_row_key, written
from .components import connected_components
from .shingles import WordHashes, minhashes, mix, odd_constants, shingle_set, words_of

BLOCK = 512  # members of a U group that one task compares with as many others
HOT = 8 * BLOCK  # members of a group with a leader: below, its pairs of blocks cost less than reading texts once more
PARTS = 2
ARROW_RECORDS = 1000  # texts, or sets of shingles, in one Arrow batch
MARKS = 1 << 24  # bits that tell most texts nobody asks for, before any is moved


def collection_size(similarity: float, parts: int = PARTS, miss: float = 1e-6) -> int:
    """Parts per collection so that a pair at ``similarity`` shares no table
    with probability below ``miss``."""
    return max(2, math.ceil(math.log(miss / 2) / math.log(1 - similarity**parts)))


def signatures(docs: DataFrame, *, width: int = 5, m: int = 12, parts: int = PARTS) -> DataFrame:
    """doc_id, n_shingles, digest (of the whole set; null: empty set), u and v
    (m 32-bit parts each: parts equal by chance cost a comparison, as all pairs
    are confirmed on their sets)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, weights = WordHashes(), odd_constants(width, "shingle")
        mult = odd_constants(2 * m * parts, "minhash")
        for pdf in batches:
            sets = [shingle_set(words_of(t), hashes, width, weights) for t in pdf["text"]]
            full = [k for k, s in enumerate(sets) if len(s)]
            uv: list = [None] * len(sets)
            if full:
                mins = minhashes([sets[k] for k in full], mult)
                part = np.zeros((len(full), 2 * m), dtype=np.uint64)
                for p in range(parts):
                    part = mix(part + mins[:, p * 2 * m : (p + 1) * 2 * m])
                for k, row in zip(full, part.astype(np.uint32).view(np.int32)):
                    uv[k] = row
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"],
                    "n_shingles": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "u": [None if x is None else x[:m] for x in uv],
                    "v": [None if x is None else x[m:] for x in uv],
                }
            )

    return texts(docs).mapInPandas(run, "doc_id long, n_shingles long, digest binary, u array<int>, v array<int>")


def _groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups from batches sorted by ``key``, several at a time: all of a
    batch but its last group, which may go on in the next."""
    held: pd.DataFrame | None = None
    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        last = np.ones(len(pdf), dtype=bool)
        for k in key:
            last &= (pdf[k] == pdf[k].iloc[-1]).to_numpy()
        cut = int(np.argmax(last))
        if cut:
            yield pdf.iloc[:cut].reset_index(drop=True)
        held = pdf.iloc[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _first_common(u: np.ndarray, v: np.ndarray, a: np.ndarray, b: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) of rows have ``part`` as their first common U part and
    share a V part, i.e. a table."""
    same = u[a] == u[b]
    return (same.argmax(axis=1) == part[a]) & same.any(axis=1) & (v[a] == v[b]).any(axis=1)


def _pairs(key: np.ndarray, side: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs within equal, adjacent keys, by distance; in groups of two
    different blocks only pairs across them."""
    at, d = np.arange(len(key)), 0
    while True:
        d += 1
        at = at[at + d < len(key)]
        at = at[key[at] == key[at + d]]
        if not len(at):
            return
        ok = at[~cross[at] | (side[at] != side[at + d])]
        for k in range(0, len(ok), 20_000):
            yield ok[k : k + 20_000], ok[k : k + 20_000] + d


def _candidate_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in _groups(batches, ["ukey", "b1", "b2"]):
        u, v = np.stack(pdf["u"].to_numpy()), np.stack(pdf["v"].to_numpy())
        key = pdf.groupby(["ukey", "b1", "b2"], sort=False).ngroup().to_numpy()
        need = np.zeros(len(pdf), dtype=bool)
        part = pdf["part"].to_numpy()
        for a, b in _pairs(key, pdf["block"].to_numpy(), (pdf["b1"] != pdf["b2"]).to_numpy()):
            hit = _first_common(u, v, a, b, part)
            need[a[hit]] = True
            need[b[hit]] = True
        yield pdf.loc[need, ["ukey", "b1", "b2", "block", "part", "rep", "u", "v"]]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b| on sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(percent: int, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, weights = WordHashes(), odd_constants(width, "shingle")
        for pdf in _groups(batches, ["ukey", "b1", "b2"]):
            u, v = np.stack(pdf["u"].to_numpy()), np.stack(pdf["v"].to_numpy())
            key = pdf.groupby(["ukey", "b1", "b2"], sort=False).ngroup().to_numpy()
            part, sets = pdf["part"].to_numpy(), [shingle_set(words_of(t), hashes, width, weights) for t in pdf["text"]]
            root = list(range(len(pdf)))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            links = []
            for a, b in _pairs(key, pdf["block"].to_numpy(), (pdf["b1"] != pdf["b2"]).to_numpy()):
                hit = _first_common(u, v, a, b, part)
                for x, y in zip(a[hit].tolist(), b[hit].tolist()):
                    rx, ry = find(x), find(y)
                    if rx != ry and similar(sets[x], sets[y], percent):
                        root[max(rx, ry)] = min(rx, ry)
                        links.append((x, y))
            reps = pdf["rep"].to_numpy()
            yield pd.DataFrame({"a": [reps[x] for x, _ in links], "b": [reps[y] for _, y in links]}, dtype="int64")

    return run


def _asked_for(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the rows of ``docs`` whose doc_id may be among ``ids``: all that
    are, and of the others those that share a bit with one. There are MARKS bits for
    the hashes of the ids, so that what is broadcast is bounded, however many there are."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    word, bit = F.expr("place div 64").alias("word"), F.expr("cast(place % 64 AS int)").alias("bit")
    marks = ids.select(place.alias("place")).select(word, bit)
    marks = marks.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    placed = texts(docs).withColumn("place", place).select("doc_id", "text", word, bit)
    return placed.join(F.broadcast(marks), "word").filter("getbit(bits, bit) = 1").select("doc_id", "text")


def _shingle_rows(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, weights = WordHashes(), odd_constants(width, "shingle")
        for pdf in batches:
            for k in range(0, len(pdf), 500):
                part = pdf.iloc[k : k + 500]
                yield pd.DataFrame(
                    {
                        "rep": part["doc_id"],
                        "shingles": [shingle_set(words_of(t), hashes, width, weights).tobytes() for t in part["text"]],
                    }
                )

    return run


def _exploded(reps: DataFrame, *columns: str) -> DataFrame:
    """A row for each U part: ukey, part, rep and the columns named."""
    parts = reps.select("rep", *columns, F.posexplode("u").alias("part", "upart"))
    return parts.select(F.xxhash64("part", "upart").alias("ukey"), "part", "rep", *columns)


def _hot_groups(reps: DataFrame) -> DataFrame:
    """ukey and leader of each group above HOT members: of those with the
    commonest first V part, the smallest, so that it is one of many alike."""
    narrow = _exploded(reps.select("rep", "u", F.get("v", F.lit(0)).alias("v0")), "v0")
    by_v = narrow.groupBy("ukey", "v0").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("leader"))
    by_key = by_v.groupBy("ukey").agg(F.sum("n").alias("n"), F.max_by("leader", F.struct("n", "leader")).alias("leader"))
    return by_key.filter(F.col("n") > HOT).drop("n")


def _similar_to_leader(percent: int):
    """Rows sorted by (leader, bucket, kind): the leader's set, then its members'."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held = None, []  # a doc_id that repeats has several sets
        for pdf in batches:
            out = []
            for leader, bucket, kind, rep, raw in zip(*(pdf[c] for c in ("leader", "bucket", "kind", "rep", "shingles"))):
                own = np.frombuffer(raw, dtype=np.uint64)
                if group != (leader, bucket):
                    group, held = (leader, bucket), []
                if kind == 0:
                    held.append(own)
                elif any(similar(own, of_leader, percent) for of_leader in held):
                    out.append((rep, leader))
            yield pd.DataFrame(out, columns=["rep", "leader"], dtype="int64")

    return run


def _stars(reps: DataFrame, hot: DataFrame, sets_of, percent: int) -> DataFrame:
    """(rep, leader): members of hot groups that are similar to a leader. Each member
    is compared with one, the smallest leader of its hot groups, so its set is moved
    once; a leader's set goes to a bucket for every BLOCK members."""
    pairs = _exploded(reps.select("rep", "u")).join(hot, "ukey").groupBy("rep").agg(F.min("leader").alias("leader")).filter("leader < rep")
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb"))
    of_members = (
        pairs.join(sizes, "leader")
        .select("leader", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int").alias("bucket"), F.lit(1).alias("kind"), "rep")
        .join(sets_of(pairs.select(F.col("rep").alias("doc_id"))), "rep")
    )
    of_leaders = sizes.select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("bucket"), F.lit(0).alias("kind"), F.col("leader").alias("rep")
    ).join(sets_of(sizes.select(F.col("leader").alias("doc_id"))), "rep")
    dealt = of_members.unionByName(of_leaders).repartition("leader", "bucket").sortWithinPartitions("leader", "bucket", "kind")
    return dealt.mapInPandas(_similar_to_leader(percent), "rep long, leader long").distinct()


def _classes(stars: DataFrame) -> DataFrame:
    """(rep, class): the least leader reached over a few links of ``stars``, in which
    leaders have leaders too. A class that isn't followed to its end costs
    comparisons only."""
    out = stars.select("rep", F.col("leader").alias("class"))
    for _ in range(2):
        above = out.select(F.col("rep").alias("class"), F.col("class").alias("above"))
        out = out.join(above, "class", "left").select("rep", F.coalesce("above", "class").alias("class"))
    return out


def _dealt(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows (ukey, part, rep, class, u, v) to the pairs of blocks (b1, b2) of their
    group in which they are compared. The members of a hot group (ukey, class of its
    leader) of the leader's class are connected: their blocks come first and aren't
    compared with each other."""
    led = rows.join(hot.withColumnRenamed("class", "leading"), "ukey", "left")
    led = led.withColumn("star", F.coalesce(F.col("class") == F.col("leading"), F.lit(False)))
    sizes = led.groupBy("ukey").agg(
        F.count(F.lit(1)).alias("n"),
        F.ceil(F.count_if("star") / BLOCK).cast("int").alias("ns"),
        F.ceil(F.count_if(~F.col("star")) / BLOCK).cast("int").alias("nr"),
    )
    place = F.xxhash64("rep", F.lit(1))
    block = F.when(F.col("star"), F.pmod(place, F.greatest("ns", F.lit(1)))).otherwise(F.col("ns") + F.pmod(place, F.greatest("nr", F.lit(1))))
    others = F.sequence(F.when(F.col("star"), F.col("ns")).otherwise(F.lit(0)), F.col("ns") + F.col("nr") - 1)
    return (
        led.join(sizes.filter("n > 1 AND nr > 0"), "ukey")
        .withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(others))
        .select("ukey", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), "block", "part", "rep", "u", "v")
    )


def near_duplicates(docs: DataFrame, *, percent: int = 80, width: int = 5, miss: float = 1e-6) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents with 100 * |intersection| >= percent * |union| are linked;
    component_id is the smallest doc_id reachable over links, kept is
    doc_id = component_id.

    Cases: null, empty and blank texts have the empty set and are linked with
    nothing; a text under ``width`` words is one shingle; equal sets are linked
    through their smallest doc_id (never as pairs); rows that repeat a doc_id
    are one node, linked if any of its texts is, and each row is returned; a
    row without doc_id has a null component and is kept; other columns are
    ignored; no documents give no rows. The result is a written table."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch, arrow_records(spark, ARROW_RECORDS):
        return _linked(docs, percent, width, collection_size(percent / 100, miss=miss), scratch)


def _linked(docs: DataFrame, percent: int, width: int, m: int, scratch: Scratch) -> DataFrame:
    sig = scratch.written(signatures(docs, width=width, m=m), "minhash-signatures")
    known = sig.filter("doc_id IS NOT NULL AND digest IS NOT NULL")

    # a table of its own, so that AQE can split a hot digest in the join with it
    repeated = scratch.written(
        known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "minhash-repeated",
    )
    copies = scratch.written(
        known.select("doc_id", "digest").join(repeated, "digest").filter("doc_id <> rep").select("doc_id", "digest", "rep"),
        "minhash-copies",
    )
    reps = known.join(copies.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti")
    reps = reps.dropDuplicates(["doc_id", "digest"]).select(F.col("doc_id").alias("rep"), "u", "v")
    reps = scratch.written(reps, "minhash-reps")

    def sets_of(ids: DataFrame) -> DataFrame:
        # no semi-join: the optimiser would put it before the filter
        wanted = _asked_for(docs, ids).join(ids.distinct(), "doc_id")
        return wanted.mapInPandas(_shingle_rows(width), "rep long, shingles binary")

    hot = scratch.written(_hot_groups(reps), "minhash-hot")
    if hot.isEmpty():
        stars = docs.sparkSession.createDataFrame([], "rep long, leader long")
        rows, hot = reps.withColumn("class", F.col("rep")), hot.withColumnRenamed("leader", "class")
    else:
        stars = scratch.written(_stars(reps, hot, sets_of, percent), "minhash-stars")
        classes = scratch.written(_classes(stars), "minhash-classes")
        rows = reps.join(classes, "rep", "left").withColumn("class", F.coalesce("class", "rep"))
        leading = hot.join(classes.withColumnRenamed("rep", "leader"), "leader", "left")
        hot = scratch.written(leading.select("ukey", F.coalesce("class", "leader").alias("class")), "minhash-leading")
    rows = scratch.written(_exploded(rows, "class", "u", "v"), "minhash-parts")
    dealt = _dealt(rows, hot)
    group = ["ukey", "b1", "b2"]
    schema = "ukey long, b1 int, b2 int, block int, part int, rep long, u array<int>, v array<int>"
    members = scratch.written(
        dealt.repartition(*group).sortWithinPartitions(*group).mapInPandas(_candidate_members, schema),
        "minhash-candidates",
    )
    scratch.done("minhash-parts")
    # texts travel, not their sets: these are twice as large and can't be compressed
    asked = _asked_for(docs, members.select(F.col("rep").alias("doc_id")))
    links = (
        members.join(asked.withColumnRenamed("doc_id", "rep"), "rep")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInPandas(_confirmed(percent, width), "a long, b long")
    )
    edges = links.union(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))).union(stars)
    edges = scratch.written(edges, "minhash-links")
    scratch.done("minhash-candidates")
    found = connected_components(edges)
    component = F.coalesce("component", "doc_id")
    out = (
        sig.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
        )
    )
    return written(out, "near-duplicate-components")


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with their columns, of which one is kept of each group:
    that of the smallest doc_id.

    Rows decide, not doc_ids: a row without doc_id, or one of several with the same,
    is a document of its own (after all others where one of its group is chosen).
    The rows to drop are written and anti-joined."""
    rows, key = with_row_key(docs)
    doc_id = F.col("doc_id").cast("long")
    several = docs.filter(doc_id.isNotNull()).groupBy(doc_id.alias("__several")).count().filter("count > 1")
    # a table of its own, whose size the planner knows
    several = written(several.select("__several"), "repeated-ids")
    node, mark = free_name(rows, "node"), free_name(rows, "__several")
    several = several.withColumnRenamed("__several", mark)
    own = F.col(key).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    named = rows.join(several, doc_id == F.col(mark), "left").withColumn(
        node, F.when(doc_id.isNull() | F.col(mark).isNotNull(), own).otherwise(doc_id)
    )
    found = near_duplicates(named.select(F.col(node).alias("doc_id"), "text"), **options)
    drop = written(found.filter("NOT kept").select(F.col("doc_id").alias(node)).distinct(), "near-duplicates")
    return named.join(drop, node, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def duplicates_sql(percent: int, width: int = 5) -> str:
    """``near_duplicates`` in DuckDB SQL: overlaps of all sets that share a shingle,
    equal sets through their smallest doc_id, and a walk over the links."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{letters.upper()}', '{letters}'), '[ \\t\\n\\x0B\\f\\r]+'),
                             lambda w: w <> '') AS words FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + {width - 1}], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {width - 2}, 2))) AS i FROM doc WHERE len(words) > 0)
), whole AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS digest FROM shingle GROUP BY doc_id
), named AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY digest) AS rep FROM whole
), own AS (SELECT rep, n, s FROM named JOIN shingle USING (doc_id) WHERE doc_id = rep
), pair AS (
  SELECT a.rep AS a, b.rep AS b FROM own a JOIN own b ON a.s = b.s AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), link AS (
  SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair
  UNION ALL SELECT doc_id, rep FROM named WHERE doc_id <> rep UNION ALL SELECT rep, doc_id FROM named WHERE doc_id <> rep
), reach AS (
  SELECT doc_id, doc_id AS node FROM doc UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.node = link.a
), component AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN whole USING (doc_id)"""
