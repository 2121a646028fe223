from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

from marquee.llm.packing import _ids_of_worker, best_fit, pack, plan, slots, token_ids
from marquee.llm.queries import vocabulary

SEQ = 2048


def whole(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary()).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    [
        "it's a TEST I'm we'll 12.5 ½ é É ß ẞ x", "naïve foo\x85bar \x1c \x1f q", "a<|endoftext|>b <|startoftext|>", "",
        "日本 語 'RE 'S ó ́x", "'s't're don'T''ll", "ǅ Σας ΣΑΣ  İstanbul", "µ ª º ²³¹ \xa0\xad", " \n\t ", "\U0001f600!!,,..",
    ],
)
def test_ids_are_the_vocabularys(text):
    got = np.frombuffer(token_ids(text, _ids_of_worker(vocabulary())), dtype="<u4").tolist()
    assert got == whole(text)


def check(rows, docs):
    """Every id of every document once, in gapless sequences of at most SEQ."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= SEQ
    for doc, text in docs.items():
        ids = np.array(whole(text) + [0], dtype="<u4")
        got = sorted(pieces[doc], key=lambda r: r.piece)
        assert [r.start for r in got] == list(range(0, len(ids), SEQ))
        assert [r.ids_crc32 for r in got] == [zlib.crc32(ids[k : k + SEQ].tobytes()) for k in range(0, len(ids), SEQ)]
        assert sum(r.length for r in got) == len(ids)
    return len(sequences)


def test_round_trip_on_the_small_table(spark, sample):
    from marquee.llm.common import read_table

    rows = pack(read_table(spark, "/root/testdata/sf0.001", "documents"), vocabulary()).collect()
    used = check(rows, sample)
    total = sum(r.length for r in rows)
    assert used <= -(-total // SEQ) + 1


def test_odd_rows(odd_docs, no_docs):
    rows = pack(odd_docs, vocabulary()).collect()
    check(rows, {1: None, 2: "", 3: " \n\t "})
    assert len([r for r in rows if r.doc_id == 8]) == 2 and len([r for r in rows if r.doc_id is None]) == 2
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert pack(no_docs, vocabulary()).count() == 0


def test_ids_are_kept_on_request(make_docs):
    (row,) = pack(make_docs([(1, "hello world")]), vocabulary(), with_ids=True).collect()
    assert list(row.ids) == whole("hello world") + [0]


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once_and_few_bins(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(SEQ, rng.lognormal(6, 1, 20_000 if seed % 2 else 300).astype(int) + 1)
    counts = np.bincount(lengths, minlength=SEQ + 1)
    packed = plan(counts, SEQ)
    used = np.zeros(SEQ + 1, dtype=int)
    for lens, n in packed:
        assert sum(lens) <= SEQ and n > 0
        for x in lens:
            used[x] += n
    assert (used == counts).all()
    bins, lower = sum(n for _, n in packed), -(-int(lengths.sum()) // SEQ)
    assert lower <= bins <= max(lower + 2, int(lower * 1.002))
    assert bins <= sum(n for _, n in best_fit(counts, SEQ)) + 2
    table = slots(packed)
    for x in np.flatnonzero(counts):  # ranges of ranks partition each length
        assert table["rank"][table["length"] == x][0] == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_vocabularys_own(make_docs, sample, name):
    """Also of a vocabulary with other rules, whose texts are given to it whole."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from marquee.llm.packing import _cut_as_here, token_pieces

    path = str(public_tokenizers.path(name))
    tokenizer = Tokenizer.from_file(path)
    assert _cut_as_here(tokenizer) == (name == "word_bpe_49k.json")
    texts = dict(list(sample.items())[:60])
    texts |= {9001: "It's  THE\n\nÀÉ 12³ <|endoftext|> x", 9002: "日本 \U0001f600 Ünḯ", 9003: None, 9004: " "}
    rows = token_pieces(make_docs(texts.items()), path, seq_len=64, end_id=0, with_ids=True).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert got == {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t in texts.items()}
