"""Surrogates for personal data.

Entities are found by pattern and replaced by keyed, type-consistent surrogates
(HMAC of the key, the type and the normalised entity): an address stays an
address of the same shape, a card number keeps its length, grouping, first digit
and Luhn validity, a name keeps its script, case, hyphens and gender.

Names are found after a title, or as a common given name with a surname after it.
Each word of a name is an entity, whatever its role, so it has one surrogate
wherever it occurs. Its gender is the given name's, or what the titles of the corpus say where it is a given
name; where they say both or nothing it has none.

The same entity gets the same surrogate everywhere, and different entities get
different ones: surrogates that meet, or that equal an entity of the corpus, are
drawn again in distributed rounds until none do.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, written

# Titles and the gender they tell (m, f, or n for neither).
TITLES = {
    "mr": "m", "mister": "m", "sir": "m", "herr": "m", "señor": "m", "sr": "m", "don": "m", "monsieur": "m", "m": "m",
    "mrs": "f", "ms": "f", "miss": "f", "madam": "f", "frau": "f", "señora": "f", "sra": "f", "señorita": "f",
    "srta": "f", "doña": "f", "madame": "f", "mme": "f", "mademoiselle": "f", "mlle": "f",
    "dr": "n", "dra": "f", "prof": "n", "господин": "m", "госпожа": "f", "κύριος": "m", "κυρία": "f",
}
_TITLE = "|".join(sorted({f(t) for t in TITLES for f in (str.capitalize, str.upper)}, key=len, reverse=True))
# Common given names and their gender. Fixed values.
GIVEN = {
    name: gender
    for gender, names in {
        "m": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew "
        "Kenneth George Peter Hans Klaus Jürgen Wolfgang Stefan Andreas Uwe Heinz Jean Pierre Michel Philippe Jacques François "
        "Olivier Julien José Juan Carlos Luis Miguel Javier Pedro Manuel Иван Алексей Сергей Дмитрий Γιώργος Νίκος",
        "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Margaret Sandra Emily Anna Maria "
        "Julia Laura Emma Ursula Monika Petra Sabine Renate Helga Katharina Brigitte Marie Nathalie Isabelle Sylvie Catherine "
        "Françoise Céline Carmen Ana Lucía Isabel Pilar Elena Rosa Teresa Ольга Елена Наталья Татьяна Μαρία Ελένη",
    }.items()
    for name in names.split()
}
# Prefixes of keys and tokens by their issuers, which surrogates keep.
_SECRET = (
    r"(?:(?:sk|pk|ghp|gho|AKIA|xox[bp])[-_A-Za-z0-9]{16,}|(?:AIza|ASIA)[-_A-Za-z0-9]{16,}"
    r"|(?:rk|ghu|ghs|ghr|github_pat|glpat|npm|hf|pypi|shpat|xox[aers])[-_][-_A-Za-z0-9]{16,}"
    r"|(?:ya29|SG)\.[-_.A-Za-z0-9]{15,}[A-Za-z0-9]|eyJ[-_A-Za-z0-9]{10,}\.eyJ[-_A-Za-z0-9]{10,}\.[-_A-Za-z0-9]+)"
)
_SECRET_PREFIX = re.compile(r"github_pat[-_]|glpat[-_]|shpat[-_]|pypi[-_]|npm[-_]|AKIA|ASIA|AIza|gh[opusr][-_]?|xox[abeprs][-_]?|ya29\.|SG\.|eyJ|hf[-_]|[spr]k[-_]?")
_HEX = "[0-9A-Fa-f]{1,4}"
_IPV6 = (
    rf"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?:{_HEX}:){{1,7}}:|:(?::{_HEX}){{1,7}})(?![\w:]|\.\d)"
)
_WORD = r"(?:[A-ZÀ-ÖØ-Þ]['’])?[^\W\d_a-z][^\W\d_]+(?:[-'’][^\W\d_]+)*"
_INITIAL = "[A-ZÀ-ÖØ-ÞΆ-ΫЀ-Я]"
# One to three words, with initials before them; without a full stop only after the title.
_NAME = rf"(?:{_INITIAL}(?:\.[ ]?|[ ])){{0,3}}{_WORD}(?:[ ](?:{_INITIAL}\.[ ]?){{0,3}}{_WORD}){{0,2}}"
_PART = re.compile(r"[^\W\d_]+")
_GIVEN = "|".join(sorted(GIVEN, key=len, reverse=True))
# One alternation; the first that matches at a place wins.
_SHAPED = (
    r"(?P<email>[A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<token>\b(?=[0-9a-fA-F]*\d)(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{24,}\b"
    rf"|\b{_SECRET}\b)"
    r"|(?P<ip>\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b(?!\.\d))"
    rf"|(?P<ipv6>{_IPV6})"
    r"|(?P<ssn>\b\d{3}-\d{2}-\d{4}\b)"
    r"|(?P<card>\b\d(?:[ -]?\d){12,18}\b)"
    r"|(?P<phone>(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\b\d{3}[ .-])\d{3,4}[ .-]\d{3,4}\b|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}\b"
    r"|(?<![\w.,/-])[2-9]\d{2}-\d{4}\b(?![-/]|[.,]\d))"
)
_TITLED = rf"|\b(?P<title>{_TITLE})\b\.?[ ](?P<person>{_NAME})"
_FULL = rf"|\b(?P<full>(?:{_GIVEN})(?:-(?:{_GIVEN}))?(?:[ ]{_INITIAL}\.)*[ ]{_WORD})"
_PATTERN = re.compile(_SHAPED + _TITLED + _FULL)
_PATTERNS = {(t, f): re.compile(_SHAPED + _TITLED * t + _FULL * f) for t in (False, True) for f in (False, True)}
# What the alternatives need: a digit, an at sign or a secret; a title; a given name.
_MAYBE = re.compile(rf"[@\d]|{_SECRET}")
_CAPITALISED = re.compile(r"\b[^\W\d_a-z][^\W\d_]*")
_TITLE_WORDS = frozenset(_TITLE.split("|"))


def _pattern_of(text: str) -> re.Pattern | None:
    """The alternatives that can match in a text (the words that names begin with are
    many, so they are looked for only where there is one); None if none can."""
    words = set(_CAPITALISED.findall(text))
    titled, full = not words.isdisjoint(_TITLE_WORDS), not words.isdisjoint(GIVEN)
    return _PATTERNS[titled, full] if titled or full or _MAYBE.search(text) else None


# Syllables of surrogate names, per script.
SYLLABLES = {
    "latin": (tuple("b d f g k l m n p r s t v z br dr kr st tr".split()), tuple("a e i o u".split())),
    "cyrillic": (tuple("б в г д к л м н п р с т".split()), tuple("а е и о у".split())),
    "greek": (tuple("β γ δ κ λ μ ν π ρ σ τ".split()), tuple("α ε ι ο".split())),
}
ENDINGS = {
    "latin": {"m": "o", "f": "a", "n": "en"},
    "cyrillic": {"m": "ин", "f": "ина", "n": "енко"},
    "greek": {"m": "ος", "f": "η", "n": "ου"},
}


def script(word: str) -> str:
    c = word[0]
    return "cyrillic" if "Ѐ" <= c <= "ԯ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def _norm(kind: str, text: str) -> str:
    """What makes two mentions the same entity."""
    if kind in ("email", "ipv6"):
        return text.lower()
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind.startswith("name"):
        return text.casefold()
    return text


def entities(text: str | None) -> list[tuple[int, int, str, str, str]]:
    """(start, end, kind, normalised, gender) in text order, without overlaps. Name
    kinds are name/<script>, one entity for each word or initial of a name; gender is
    what this text says of a name (m, f or nothing) and empty for others. A
    name's words, but not its initials, are also found where they occur alone in the same text."""
    pattern = _pattern_of(text) if text else None
    if pattern is None:
        return []
    out: list[tuple[int, int, str, str]] = []
    said: dict[str, set[str]] = {}
    alone: dict[str, str] = {}
    for m in pattern.finditer(text):
        group = m.lastgroup
        if group not in ("person", "full"):
            out.append((m.start(), m.end(), group, _norm(group, m.group())))
            continue
        title = TITLES[m["title"].lower()] if group == "person" else "n"
        parts = list(_PART.finditer(m[group]))
        for k, p in enumerate(parts):
            word, norm = p.group(), _norm("name", p.group())
            kind = f"name/{script(word)}"
            gender = GIVEN.get(word) or GIVEN.get(word.capitalize()) or (title if k < len(parts) - 1 else "n")
            said.setdefault(norm, set()).update({gender} - {"n"})
            if len(word) > 1 and not word[0].islower():
                alone[word] = kind
            at = m.start(group) + p.start()
            out.append((at, at + len(word), kind, norm))
    if alone:
        word = re.compile(r"\b(?:" + "|".join(re.escape(n) for n in sorted(alone, key=len, reverse=True)) + r")\b")
        taken = [(s, e) for s, e, *_ in out]
        k = 0
        for m in word.finditer(text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if k == len(taken) or taken[k][0] >= m.end():
                out.append((m.start(), m.end(), alone[m.group()], _norm("name", m.group())))
        out.sort()
    one = {norm: min(genders) if len(genders) == 1 else "" for norm, genders in said.items()}
    return [(s, e, kind, norm, one.get(norm, "") if kind.startswith("name/") else "") for s, e, kind, norm in out]


class _Draw:
    """A keyed stream of small numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, norm: str, attempt: int):
        self.seed, self.n, self.left = hmac.new(key, f"{kind}\0{norm}\0{attempt}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest()
            self.n += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


def _shaped(text: str, draw: _Draw, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    """Letters to letters of the same case, digits to digits, the rest kept."""
    out = []
    for c in text:
        if c.isdigit():
            out.append("0123456789"[draw.below(10)])
        elif c.isalpha():
            x = letters[draw.below(len(letters))]
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def surrogate(key: bytes, kind: str, norm: str, attempt: int, gender: str = "") -> str:
    """The normalised surrogate of a normalised entity. From the 8th attempt on
    addresses, tokens and names get longer, so small shapes can't run out."""
    draw, longer = _Draw(key, kind, norm, attempt), max(0, attempt - 7)
    if kind == "email":
        local, _, domain = norm.partition("@")
        labels = domain.split(".")
        own = _Draw(key, "domain", ".".join(labels[:-1]), 0)  # addresses of a domain stay in one
        return f"{_shaped(local + 'x' * longer, draw)}@{_shaped('.'.join(labels[:-1]), own)}.{labels[-1]}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "ipv6":
        return re.sub("[0-9a-f]+", lambda m: "123456789abcdef"[draw.below(15)] + "".join("0123456789abcdef"[draw.below(16)] for _ in m[0][1:]), norm)
    if kind == "token":
        if re.fullmatch(r"[0-9a-fA-F]+", norm):
            return "".join(("0123456789ABCDEF" if c.isupper() else "0123456789abcdef")[draw.below(16)] for c in norm) + "0" * longer
        prefix = _SECRET_PREFIX.match(norm)
        at = prefix.end() if prefix else 3
        return norm[:at] + _shaped(norm[at:] + "x" * longer, draw)
    if kind == "card":
        body = norm[0] + "".join(str(draw.below(10)) for _ in norm[2:])
        valid = [d for d in "0123456789" if _luhn(body + d) == 0][0]
        return body + (valid if _luhn(norm) == 0 else str((int(valid) + 1 + draw.below(9)) % 10))
    if kind == "iban":
        body = _shaped(norm[4:], draw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        number = "".join(str(int(c, 36)) for c in body + norm[:2] + "00")
        return f"{norm[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "phone":
        keep = 2 if norm.startswith("+") else 0  # the plus and the country code's first digit
        return norm[:keep] + "".join(str(draw.below(10)) for _ in norm[keep:])
    if kind.startswith("name/"):
        kind_script = kind.split("/")[1]
        first, then = SYLLABLES[kind_script]
        word = "".join(first[draw.below(len(first))] + then[draw.below(len(then))] for _ in range(2 + draw.below(2) + longer))
        last = first[draw.below(len(first))]  # drawn in any case, so the stem doesn't depend on the gender
        return word + (ENDINGS[kind_script][gender] if gender else last)
    return _shaped(norm, draw)


def _dressed(found: str, kind: str, made: str) -> str:
    """The normalised surrogate in the mention's format."""
    if kind in ("card", "ssn", "phone", "iban"):
        symbols = iter(made)
        keep = str.isalnum if kind == "iban" else (lambda c: c.isdigit() or c == "+" and kind == "phone")
        return "".join(next(symbols) if keep(c) else c for c in found)
    if kind in ("email", "ipv6"):
        return made.upper() if found.isupper() else made
    if kind.startswith("name/"):
        if len(found) == 1:  # an initial stays one
            return made[0] if found.islower() else made[0].upper()
        return made.upper() if found.isupper() else made if found[0].islower() else made.capitalize()
    return made


def replaced(text: str | None, key: bytes, settled: dict[tuple[str, str], tuple[int, str]]) -> tuple[str | None, int]:
    """The text with surrogates, and the number of entities. ``settled``: (attempt,
    gender) of (kind, norm) where they aren't (0, what the text says)."""
    found = entities(text)
    out, at = [], 0
    for start, end, kind, norm, gender in found:
        attempt, gender = settled.get((kind, norm), (0, gender))
        out += [text[at:start], _dressed(text[start:end], kind, surrogate(key, kind, norm, attempt, gender))]
        at = end
    return ("".join(out) + text[at:] if found else text), len(found)


def _mentions(docs: DataFrame) -> DataFrame:
    """Distinct (text_key, kind, norm, gender) of every text; equal texts share a key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *e) for k, t in zip(pdf["text_key"], pdf["text"]) for e in {e[2:] for e in entities(t)}]
            yield pd.DataFrame(rows, columns=["text_key", "kind", "norm", "gender"])

    return docs.select(F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text")).mapInPandas(
        run, "text_key long, kind string, norm string, gender string"
    )


def _known(mentions: DataFrame) -> DataFrame:
    """kind, norm, gender of every entity: the only gender that any text says, or none."""
    said = F.when(F.col("gender") != "", F.col("gender"))
    agreed = F.when(F.min(said) == F.max(said), F.min(said))
    return mentions.groupBy("kind", "norm").agg(F.coalesce(agreed, F.lit("")).alias("gender"))


def _drawn(pending: DataFrame, key: bytes, attempt: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(made=[surrogate(key, k, n, attempt, g) for k, n, g in zip(pdf["kind"], pdf["norm"], pdf["gender"])])

    # names are told apart over all scripts, as a reader sees them
    return pending.mapInPandas(run, "kind string, norm string, gender string, made string").withColumn(
        "space", F.substring_index("kind", "/", 1)
    )


def drawn_again(known: DataFrame, key: bytes) -> DataFrame:
    """(kind, norm, attempt) of the entities whose first surrogate collides, with
    the first attempt that doesn't. In each round a surrogate is refused if it is
    an entity of the corpus, was given in an earlier round, or is drawn by
    several entities and not by the least. ``known``: distinct (kind, norm), gender."""
    spark = known.sparkSession
    originals = known.select(F.substring_index("kind", "/", 1).alias("space"), F.col("norm").alias("made")).distinct()
    given, pending, late, attempt = None, known, None, 0
    while True:
        made = written(_drawn(pending, key, attempt), "surrogates")
        free = made.join(originals, ["space", "made"], "left_anti")
        if given is not None:
            free = free.join(given, ["space", "made"], "left_anti")
        turn = F.row_number().over(Window.partitionBy("space", "made").orderBy("kind", "norm"))
        accepted = written(free.withColumn("turn", turn).filter("turn = 1").drop("turn"), "surrogates-given")
        if attempt:
            mine = accepted.select("kind", "norm", F.lit(attempt).alias("attempt"))
            late = mine if late is None else late.union(mine)
        pending = written(
            made.select("kind", "norm", "gender").join(accepted.select("kind", "norm"), ["kind", "norm"], "left_anti"), "surrogates-refused"
        )
        if pending.isEmpty():
            return late if late is not None else spark.createDataFrame([], "kind string, norm string, attempt int")
        mine = accepted.select("space", "made")
        given, attempt = mine if given is None else given.union(mine), attempt + 1


def with_surrogates(docs: DataFrame, key: str, *, count: str | None = None) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced (and, if named, a column
    with their number). Other columns are kept, whatever their names; n_chars,
    where there is one, follows the new text.

    The few entities that the corpus settles otherwise than a text alone does
    (surrogates drawn again, genders) reach that text by a join on its hash; no
    table is broadcast by force. Cases: null and empty texts stay; equal texts get equal
    results; a null or repeated doc_id plays no part; no documents, no rows."""
    secret = key.encode()
    mentions = written(_mentions(docs), "pii-mentions")
    known = written(_known(mentions), "pii-entities")
    again = drawn_again(known, secret)
    # entities that a text alone would settle otherwise than the corpus does
    settled = known.join(again, ["kind", "norm"], "left").select(
        "kind", "norm", F.coalesce("attempt", F.lit(0)).alias("attempt"), F.col("gender").alias("agreed")
    )
    key_of, others, made = (free_name(docs, name) for name in ("text_key", "settled", "made"))
    exceptions = written(
        mentions.join(settled, ["kind", "norm"])
        .filter("attempt > 0 OR gender <> agreed")
        .groupBy(F.col("text_key").alias(key_of))
        .agg(F.collect_set(F.struct("kind", "norm", "attempt", F.col("agreed").alias("gender"))).alias(others)),
        "pii-again",
    )

    @F.pandas_udf("struct<text string, n long>")
    def apply(text: pd.Series, other: pd.Series) -> pd.DataFrame:
        rows = [
            replaced(t, secret, {(x["kind"], x["norm"]): (x["attempt"], x["gender"]) for x in o} if o is not None else {})
            for t, o in zip(text, other)
        ]
        return pd.DataFrame(rows, columns=["text", "n"])

    joined = docs.withColumn(key_of, F.xxhash64("text")).join(exceptions, key_of, "left")
    done = joined.withColumn(made, apply(F.col("text").cast("string"), others))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col(f"{made}.text").alias("text"))
        elif c == "n_chars":
            columns.append(F.char_length(f"{made}.text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return done.select(*columns, *([F.col(f"{made}.n").alias(count)] if count else []))
