"""Chat formatting that is proved by a round trip through its grammar.

    conversation = { turn }
    turn         = OPEN role "\\n" body CLOSE "\\n"

``OPEN`` and ``CLOSE`` are the control strings. Turns are rendered as they are,
the rendering is parsed by the grammar (a deterministic scan for the next control
string), and what is recovered is compared with the source. Content that comes
back otherwise -- it holds a control string, or what an escaped one looks like
-- is escaped and rendered again, until the parse gives the source.

Escaping puts one more backslash after the ``<`` of a control string that has
none or some there; the parser takes one away. Line ends and backslashes of a
role are escaped in the same manner.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
_ROLE_ESCAPES = {"\\": "\\\\", "\n": "\\n"}
_ROLE_ESCAPE = re.compile(r"\\|\n")
_ROLE_ESCAPED = re.compile(r"\\(.?)", re.DOTALL)
_ROLE_UNESCAPES = {"\\": "\\", "n": "\n"}


class GrammarError(ValueError):
    """The text isn't a conversation of the grammar."""


def escape(body: str) -> str:
    return _CONTROL.sub(r"<\\\1|\2|>", body)


def unescape(body: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", body)


def escape_role(role: str) -> str:
    return escape(_ROLE_ESCAPE.sub(lambda m: _ROLE_ESCAPES[m[0]], role))


def unescape_role(role: str) -> str:
    try:
        return _ROLE_ESCAPED.sub(lambda m: _ROLE_UNESCAPES[m[1]], unescape(role))
    except KeyError as e:
        raise GrammarError("a role with an unknown escape") from e


@dataclass
class Parser:
    """Reads a conversation's text piece by piece, however it is cut, and holds
    no more than what is left of an unfinished turn.

    ``feed`` gives (role, body, begin, end) of each turn that ended: unescaped,
    with the place of the escaped body in the whole text. ``close`` raises
    GrammarError if a turn is unfinished."""

    held: list[str] = field(default_factory=list)
    tail: str = ""
    place: int = 0

    def feed(self, piece: str) -> Iterator[tuple[str, str, int, int]]:
        # a control string may be cut in two: look for the end in the last characters too
        window = self.tail + piece
        self.held.append(piece)
        if CLOSE + "\n" not in window:
            self.tail = window[-len(CLOSE) :]
            return
        text, at = "".join(self.held), 0
        while (end := text.find(CLOSE + "\n", at)) >= 0:
            if not text.startswith(OPEN, at):
                raise GrammarError(f"no turn begins at {self.place + at}")
            line = text.find("\n", at, end)
            if line < 0 or OPEN in text[at + len(OPEN) : end]:
                raise GrammarError(f"the turn at {self.place + at} isn't one")
            begin = line + 1
            if CLOSE in text[at:end]:
                raise GrammarError(f"a control string in the turn at {self.place + at}")
            yield unescape_role(text[at + len(OPEN) : line]), unescape(text[begin:end]), self.place + begin, self.place + end
            at = end + len(CLOSE) + 1
        self.place += at
        self.held, self.tail = [text[at:]], text[at:][-len(CLOSE) :]

    def close(self) -> None:
        if any(self.held):
            raise GrammarError(f"the turn at {self.place} doesn't end")


def parse(text: str) -> list[tuple[str, str, int, int]]:
    parser = Parser()
    out = list(parser.feed(text))
    parser.close()
    return out


def render(role: str, body: str) -> tuple[str, int, int]:
    """A turn's text and the place of its body in it: as it is if the grammar
    gives it back, else with the body escaped, else with the role escaped too."""
    for as_role, as_body in ((role, body), (role, escape(body)), (escape_role(role), escape(body))):
        text = f"{OPEN}{as_role}\n{as_body}{CLOSE}\n"
        try:
            found = [t[:2] for t in parse(text)]
        except GrammarError:
            continue
        if found == [(role, body)]:
            begin = len(OPEN) + len(as_role) + 1
            return text, begin, begin + len(as_body)
    raise GrammarError("escaped content isn't recovered")  # the grammar excludes it


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    """Rows whose integers may be null, without a detour over doubles."""
    values = list(zip(*rows)) or [()] * len(columns)
    whole = lambda v: all(x is None or isinstance(x, int) for x in v)
    return pd.DataFrame({c: pd.array(list(v), dtype="Int64") if whole(v) else list(v) for c, v in zip(columns, values)})


def _rendered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and place to pieces."""
    last, place, start = object(), 0, 0
    for pdf in batches:
        rows = []
        for missing, conv, role, text in zip(pdf["missing"], pdf["conv"], pdf["role"], pdf["text"]):
            conv = None if missing else int(conv)
            if conv != last:
                last, place, start = conv, 0, 0
            piece, begin, end = render(role, text)
            scored = role == LOSS_ROLE
            rows.append((conv, place, start, piece, start + begin if scored else None, start + end if scored else None))
            place, start = place + 1, start + len(piece)
        yield _frame(rows, ["conv_id", "place", "start", "formatted", "loss_begin", "loss_end"])


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per row of ``conversations``: conv_id, place (in the conversation,
    from 0), start, formatted, loss_begin, loss_end. A conversation's text is its
    ``formatted`` in the order of ``place``; start and the loss span (the escaped
    text of an assistant; null for other roles) are places in that text, in code
    points.

    Conversations are dealt by conv_id and sorted, and stream through their task:
    no conversation is held. They come out whole and in order within partitions.

    Cases: rows are ordered by turn (null first), then role and text, so repeated
    turns all stay, in a fixed order; null texts and roles are empty ones; rows
    without conv_id are one conversation; a turn is one row and is held whole;
    control strings, their escaped forms and line ends in texts and roles come back as they were;
    other columns are ignored; no rows give no rows."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select(
        F.col("conv_id").isNull().alias("missing"), F.coalesce("conv_id", F.lit(0)).alias("conv"), "role", "text"
    ).mapInPandas(
        _rendered, "conv_id long, place long, start long, formatted string, loss_begin long, loss_end long"
    )


@dataclass
class _Reading:
    """Digests of one conversation as it is read back."""

    conv: int | None
    turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    turns_hash: object = field(default_factory=hashlib.sha256)
    loss_hash: object = field(default_factory=hashlib.sha256)
    parser: Parser = field(default_factory=Parser)
    spans: list[tuple[int, int]] = field(default_factory=list)

    def piece(self, place: int, start: int, text: str, begin: int | None, end: int | None) -> None:
        if start != self.chars:
            raise GrammarError(f"pieces of conversation {self.conv} don't come in order")
        self.chars += len(text)
        if begin is not None:
            self.spans.append((begin, end))
        for role, body, first, last in self.parser.feed(text):
            self.turns += 1
            self.turns_hash.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
            if self.spans and self.spans[0] == (first, last):  # the mask covers this body
                self.spans.pop(0)
                self.loss_chars += len(body)
                self.loss_hash.update(body.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        self.parser.close()
        if self.spans:
            raise GrammarError(f"the loss mask of conversation {self.conv} isn't on whole texts")
        return self.conv, self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


_READ = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now: _Reading | None = None
    for pdf in batches:
        rows = []
        for missing, conv, *piece, begin, end in pdf.itertuples(index=False):
            conv = None if missing else int(conv)
            if now is None or conv != now.conv:
                rows += [now.row()] if now else []
                now = _Reading(conv)
            now.piece(*piece, *((int(begin), int(end)) if begin >= 0 else (None, None)))
        yield _frame(rows, _READ)
    if now:
        yield _frame([now.row()], _READ)


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, parsed from ``pieces``: conv_id, n_turns,
    turns_sha256 (of role, line end, text, line end of each turn), loss_chars and
    loss_sha256 (of the unescaped texts under the loss mask), formatted_chars.

    ``pieces`` is what ``format_conversations`` returns, a conversation's pieces
    in order in one partition; pieces out of order raise GrammarError."""
    return pieces.select(
        F.col("conv_id").isNull().alias("missing"),
        F.coalesce("conv_id", F.lit(0)).alias("conv_id"),
        "place",
        "start",
        "formatted",
        F.coalesce("loss_begin", F.lit(-1)).alias("loss_begin"),
        F.coalesce("loss_end", F.lit(-1)).alias("loss_end"),
    ).mapInPandas(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def digest_sql(extra: str) -> str:
    """``read_back`` of the formatted table in DuckDB SQL; ``extra``: rows added
    to the table, as SQL."""
    control = r"<(\\*)\|(im_start|im_end)\|>"
    escaped = rf"regexp_replace(text, '{control}', '<\\\1|\2|>', 'g')"
    role = rf"regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '{control}', '<\\\1|\2|>', 'g')"
    overhead = len(OPEN) + len(CLOSE) + 2
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL {extra})
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = '{LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = '{LOSS_ROLE}'), '')) AS loss_sha256,
       sum({overhead} + length({role}) + length({escaped}))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id"""
