from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from marquee.llm import suffixes
from marquee.llm.suffixes import WIDTH, without_repeats


def brute(docs):
    first, out = set(), {}
    for d in sorted(docs):
        b = (docs[d] or "").encode()
        gone, mine = [False] * len(b), []
        for s in range(len(b) - WIDTH + 1):
            w = b[s : s + WIDTH]
            if w in first:
                gone[s : s + WIDTH] = [True] * WIDTH
            else:
                mine.append(w)
        first.update(mine)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_every_pair_of_residues_meets_in_the_cover():
    d = suffixes.COVER
    assert {(a - b) % suffixes.MODULUS for a in d for b in d} == set(range(suffixes.MODULUS))


def test_small_table_equals_brute_force(spark, sample):
    assert found(without_repeats(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))) == brute(sample)


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_strings_at_all_alignments(make_docs, seed, monkeypatch):
    monkeypatch.setattr(suffixes, "BATCH_BYTES", 2000)  # many batches
    r = random.Random(seed)
    text = lambda n: "".join(r.choice("abcdeé ") for _ in range(n))
    passages = [text(n) for n in (49, 50, 51, 60, 120, 400)]
    docs = {}
    for i in range(60):
        docs[i] = "".join(text(r.randint(0, 90)) + r.choice(passages)[r.randint(0, 3) :] for _ in range(r.randint(0, 4)))
    docs |= {100: docs[3], 101: "ab" * 100, 102: "ab" * 60, 103: passages[4] + passages[4]}
    assert found(without_repeats(make_docs(docs.items()))) == brute(docs)


def test_odd_rows(odd_docs, no_docs, spark):
    before = {t.name for t in spark.catalog.listTables()}
    rows = without_repeats(odd_docs).collect()
    assert len(rows) == 13
    empty = hashlib.sha256(b"").hexdigest()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[1].n_bytes, by[1].n_removed, by[1].kept_sha256) == (0, 0, empty) and by[2].n_spans == 0
    assert by[5].n_removed == 0 and by[6].n_removed == by[6].n_bytes and by[6].kept_sha256 == empty and by[6].n_spans == 1
    assert by[7].n_removed == by[5].n_bytes and list(by[7].spans) == [0, by[5].n_bytes]
    assert by[8].n_removed == 0
    assert all(r.n_removed == 0 for r in rows if r.doc_id is None)
    assert without_repeats(no_docs).count() == 0
    assert {t.name for t in spark.catalog.listTables()} == before


def test_packed_values_round_trip():
    rng = np.random.default_rng(0)
    for bits in (1, 8, 30, 33, 60, 62):
        for n in (1, 2, 500, 5000):
            v = np.unique(rng.integers(0, 2**bits, n).astype(np.uint64))
            assert (suffixes._unpacked(suffixes._packed(v, bits), bits) == v).all()
    dense = np.arange(256, dtype=np.uint64)
    assert (suffixes._unpacked(suffixes._packed(dense, 8), 8) == dense).all()
    for width in (1, 7, 10, 64):
        v = rng.integers(0, 2 ** min(width, 63), 777).astype(np.uint64)
        assert (suffixes._unfixed(suffixes._fixed(v, width), 777, width) == v).all()


@pytest.mark.parametrize("ranges, first, second", [(16, 2.6, 7.0), (900, 3.3, 7.0), (9000, 3.8, 7.1)])
def test_bytes_for_a_name_hardly_grow_with_the_ranges(ranges, first, second):
    """A full batch's names in one range, at 0.5, 30 and 300 GB of text."""
    width, bits = suffixes._range_bits(ranges)
    rng = np.random.default_rng(1)
    sampled = max(1, suffixes.BATCH_BYTES * len(suffixes.COVER) // suffixes.MODULUS // ranges)
    names = np.unique(rng.integers(0, width - 1, sampled, dtype=np.uint64))
    short = np.unique(suffixes._first_names(names, ranges))
    assert len(suffixes._packed(short, suffixes.FIRST_BITS)) / len(short) < first
    assert len(suffixes._packed(names, bits)) / len(names) < second
