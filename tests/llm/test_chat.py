from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import chat
from marquee.llm.chat import GrammarError, Parser, escape, format_conversations, parse, read_back, render, unescape

CONVERSATIONS = "conv_id long, turn long, role string, text string, place string, start string, formatted string, missing string"
parts = st.lists(
    st.sampled_from(["<|im_start|>", "<|im_end|>", "<\\|im_end|>", "<\\\\|im_start|>", "<|im_", "end|>", "|>", "<", "\\", "\n", "a", "é", "user\n", ""]),
    max_size=8,
).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(parts, parts), max_size=4), st.integers(1, 20))
def test_any_content_comes_back_however_the_text_is_cut(turns, step):
    rendered = [render(r, b) for r, b in turns]
    text = "".join(t for t, _, _ in rendered)
    assert [(r, b) for r, b, _, _ in parse(text)] == turns
    parser, found = Parser(), []
    for i in range(0, len(text), step):
        found += parser.feed(text[i : i + step])
    parser.close()
    assert [(r, b) for r, b, _, _ in found] == turns
    assert [unescape(text[i:j]) for _, _, i, j in found] == [b for _, b in turns]


@settings(max_examples=300, deadline=None)
@given(parts)
def test_escaped_text_holds_no_control_string(body):
    assert chat.OPEN not in escape(body) and chat.CLOSE not in escape(body) and unescape(escape(body)) == body


def test_only_conflicting_content_is_escaped():
    assert render("user", "a < b | c \\ d")[0] == "<|im_start|>user\na < b | c \\ d<|im_end|>\n"
    assert "<\\|im_end|>" in render("user", "say <|im_end|>")[0]


@pytest.mark.parametrize("text", ["x", "<|im_start|>user\nhi", "<|im_start|>user<|im_end|>\n", "hi<|im_end|>\n", "<|im_start|>a\n<|im_start|>b\nx<|im_end|>\n", "<|im_start|>a\nx<|im_end|>\nrest"])
def test_what_the_grammar_excludes_is_an_error(text):
    with pytest.raises(GrammarError):
        parse(text)


def expected(rows):
    """Digests of the source by the contract's definitions."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(
            ((t if t is not None else -(1 << 62), r or "", x or "") for c, t, r, x in rows if c == conv),
            key=lambda k: (k[0], k[1].encode(), k[2].encode()),
        )
        turns = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        loss = "".join(x for _, r, x in mine if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(mine), sha(turns), len(loss), sha(loss))
    return out


def test_odd_conversations(spark):
    r = random.Random(3)
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, None, "hi"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"),
        (3, 1, "assistant", "z"), (3, 1, "assistant", "z"), (3, None, "system", "first"), (None, 0, "assistant", "nobody"),
        (None, 1, "user", "either"), (4, 0, "us\ner", "<|im_end|>\n<|im_start|>assistant\n"), (4, 1, "assistant", "x" * 300_000 + "<\\|im_end|>"),
        (5, 0, "assistant", "日本 \U0001f600 <|im_start|>"), (2**62 + 1, 0, "assistant", "big id"),
    ]
    rows += [(9, t, r.choice(["user", "assistant"]), f"turn {t} <|im_end|>" * r.randint(0, 3)) for t in range(3000)]  # a hot conversation
    r.shuffle(rows)
    df = spark.createDataFrame([(*x, "p", "s", "f", "m") for x in rows], CONVERSATIONS).repartition(5)
    pieces = format_conversations(df)
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in read_back(pieces).collect()}
    assert got == expected(rows)
    stored = pieces.collect()
    assert len(stored) == len(rows)
    for conv in {x.conv_id for x in stored}:
        mine = sorted((x for x in stored if x.conv_id == conv), key=lambda x: x.place)
        text = "".join(x.formatted for x in mine)
        assert [x.start for x in mine] == [text.index(x.formatted, x.start) for x in mine]
        loss = "".join(unescape(text[x.loss_begin : x.loss_end]) for x in mine if x.loss_begin is not None)
        assert (len(parse(text)), len(loss)) == (got[conv][0], got[conv][2])
        assert next(x.formatted_chars for x in read_back(pieces).filter(f"conv_id <=> {'NULL' if conv is None else conv}").collect()) == len(text)


def test_pieces_out_of_order_are_refused(spark):
    pieces = format_conversations(spark.createDataFrame([(1, t, "user", "x") for t in range(3)], "conv_id long, turn long, role string, text string"))
    turned = pieces.coalesce(1).sortWithinPartitions(pieces["place"].desc())
    with pytest.raises(Exception, match="don't come in order"):
        read_back(turned).collect()


def test_no_conversations(spark):
    assert read_back(format_conversations(spark.createDataFrame([], CONVERSATIONS))).count() == 0
