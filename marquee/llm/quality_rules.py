"""Quality rules whose cutoffs are risk-controlled on labelled documents.

Every rule compares one measure of the text with a cutoff from a fixed grid,
from lenient to strict. For each stratum and rule the cutoffs are tested in that
order: the hypothesis "more than ``risk`` of the stratum's good documents are
rejected" is tested by the exact binomial tail P(X <= rejected) with X of
Bin(good documents, risk). The strictest cutoff before the first that isn't
significant is used (fixed-sequence testing needs no correction along the grid).

A stratum's share of ``error`` (Bonferroni over the strata) is spent in two halves.
One is divided by the number of rules, so that no rule depends on another. The
other tests all cutoffs of the stratum undivided, in the fixed order CHAIN, up to
the first that isn't significant; so fewer labels suffice where good documents
break no rule. A rule's cutoff is the stricter of the two. By the union bound, with
probability 1 - ``error``, no rule rejects more than ``risk`` of the good documents
of any stratum. A stratum with too few labels gets no cutoff and loses nothing to
that rule.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BLANKS = "\t\n\x0b\f\r "
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# rule: (numerator, denominator, rejects above (or below) the cutoff, cutoffs from lenient to strict)
RULES: dict[str, tuple[str, str, bool, tuple[float, ...]]] = {
    "symbol_rate": ("n_symbols", "n_words", True, (1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
    "shout_rate": ("n_shouts", "n_words", True, (1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
    "repeat_rate": ("n_repeat_words", "n_words", True, (0.25, 0.2, 0.15, 0.1, 0.05)),
    "dup_line_rate": ("n_dup_lines", "n_lines", True, (0.5, 0.4, 0.3, 0.2, 0.1)),
    "long_words": ("word_chars", "n_words", True, (20.0, 15.0, 12.0, 10.0)),
    "short_words": ("word_chars", "n_words", False, (2.0, 2.5, 3.0)),
    "few_words": ("n_distinct_words", "n_words", False, (0.05, 0.1, 0.2, 0.3)),
}
# The rules in the order in which a stratum's undivided half of the error tests them:
# the most lenient cutoff of each, then the others rule by rule. Repetition is last,
# as good texts (lists, verse) have some.
CHAIN = ("symbol_rate", "shout_rate", "long_words", "short_words", "few_words", "dup_line_rate", "repeat_rate")
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_shouts",
    "n_distinct_words",
)


def _count_chars(text: Column, chars: str) -> Column:
    """Occurrences of any of ``chars`` (ASCII): bytes lost by removing them."""
    return F.octet_length(text) - F.octet_length(reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text))


def with_measures(docs: DataFrame, name: str = "__measures") -> DataFrame:
    """``docs`` and a struct column of the text's measures (longs). A null text
    measures as an empty one.

    Repeated windows are found per document: hashes of all windows (64 bits of
    the words' 64-bit hashes), and only where their distinct number is smaller
    are they sorted with their places."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blank = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), BLANKS[:-1], text)
    n = F.size("__words")
    step = docs.withColumn("__words", F.array_remove(F.split(blank, " "), ""))
    step = step.withColumn(
        "__lines", F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    ).withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    step = step.withColumn(
        "__windows",
        F.when(
            n >= WINDOW,
            F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__hashes", i, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    step = step.withColumn(
        "__sorted",
        F.when(
            F.size(F.array_distinct("__windows")) < F.size("__windows"),
            F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    # places of windows that have an equal neighbour in hash order
    step = step.withColumn(
        "__places",
        F.sort_array(
            F.filter(
                F.transform(
                    "__sorted",
                    lambda x, k: F.when(
                        (x["h"] == F.get(F.col("__sorted"), k - 1)["h"])
                        | (x["h"] == F.get(F.col("__sorted"), k + 1)["h"]),
                        x["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            )
        ),
    )
    # words covered by windows at ascending places: each adds what the one before left
    covered = F.aggregate(
        "__places",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    values = {
        "n_words": n,
        "word_chars": F.char_length(F.concat_ws("", "__words")),
        "n_symbols": _count_chars(text, SYMBOLS),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("__lines"),
        "n_shouts": _count_chars(text, "!"),
        "n_distinct_words": F.size(F.array_distinct("__hashes")),
    }
    return step.withColumn(name, F.struct(*[values[k].cast("long").alias(k) for k in MEASURES])).drop(
        "__words", "__lines", "__hashes", "__windows", "__sorted", "__places"
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def rejects(rule: str, m: Column, cutoff: Column) -> Column:
    """Whether the rule rejects; false without a cutoff or with denominator 0."""
    above, below, high, _ = RULES[rule]
    value = F.try_divide(m[above].cast("double"), m[below].cast("double"))
    return F.coalesce(value > cutoff if high else value < cutoff, F.lit(False))


def _lgamma(x: Column) -> Column:
    """ln Gamma(x), x >= 1: Stirling's series at x + 8, stepped back."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    back = reduce(lambda a, b: a + b, [F.log(x + float(k)) for k in range(8)])
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - back


def binomial_tail(n: Column, k: Column, p: float, terms: int = 20_000) -> Column:
    """P(X <= k) for X of Bin(n, p), 1 where k >= n p (never significant).
    Terms are summed from k down; past ``terms`` of them the rest is bounded by
    its geometric majorant, which errs to the safe side."""
    n, k = n.cast("double"), k.cast("double")
    log_first = _lgamma(n + 1) - _lgamma(k + 1) - _lgamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    odds = (1 - p) / p
    last = F.least(k, F.lit(float(terms))).cast("int")
    steps = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda a, j: F.struct(
            (a["t"] * (k - j + 1) / (n - k + j) * odds).alias("t"),
            (a["s"] + a["t"] * (k - j + 1) / (n - k + j) * odds).alias("s"),
        ),
        lambda a: F.struct(a["t"].alias("t"), a["s"].alias("s")),
    )
    ratio = k * odds / (n - k + 1)
    rest = F.when(k > terms, total["t"] * ratio / (1 - ratio)).otherwise(F.lit(0.0))
    return F.when(k < n * p, F.least(F.lit(1.0), F.exp(log_first) * (total["s"] + rest))).otherwise(F.lit(1.0))


def good_ids(labels: DataFrame) -> DataFrame:
    """doc_id of the documents all of whose labels are good."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
    worst = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("__q"))
    return worst.filter("__q = 1").select("doc_id")


def cutoffs(measured: DataFrame, labels: DataFrame, *, risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """stratum and a column per rule with its cutoff (null: none), from
    ``measured`` (doc_id, stratum, measures) and ``labels`` (doc_id, quality; 1
    is good). One partially aggregated pass; the result has a row per stratum.

    Labels are deduplicated per doc_id (good only if all its labels are); null
    qualities are ignored."""
    graded = measured.join(good_ids(labels), "doc_id", "left_semi")
    m = F.col("measures")
    counts = [
        F.sum(rejects(rule, m, F.lit(c)).cast("long")).alias(f"{rule}_{i}")
        for rule, spec in RULES.items()
        for i, c in enumerate(spec[3])
    ]
    per_stratum = graded.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *counts)
    tests = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(i).alias("at"),
                F.lit(0 if i == 0 else 1 + CHAIN.index(rule)).alias("turn"),
                F.lit(CHAIN.index(rule) if i == 0 else i).alias("place"),
                F.lit(c).alias("cutoff"),
                F.col(f"{rule}_{i}").alias("k"),
            )
            for rule, spec in RULES.items()
            for i, c in enumerate(spec[3])
        ]
    )
    per_stratum = written(per_stratum, "quality-counts")  # a row per stratum
    half = error / max(1, per_stratum.count()) / 2
    rows = per_stratum.withColumn("half", F.lit(half)).select("stratum", "n", "half", F.inline(tests))
    tail = rows.withColumn("tail", binomial_tail(F.col("n"), F.col("k"), risk))
    tested = tail.withColumn("alone", (F.col("tail") <= F.col("half") / len(RULES)).cast("int")).withColumn(
        "chained", (F.col("tail") <= F.col("half")).cast("int")
    )
    along = Window.partitionBy("stratum", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    chain = Window.partitionBy("stratum").orderBy("turn", "place").rowsBetween(Window.unboundedPreceding, 0)
    kept = tested.withColumn("passed", F.greatest(F.min("alone").over(along), F.min("chained").over(chain)))
    return kept.groupBy("stratum").agg(
        *[
            F.max_by("cutoff", F.when((F.col("passed") == 1) & (F.col("rule") == rule), F.col("at"))).alias(rule)
            for rule in RULES
        ]
    )


def stratum_of(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def judged(docs: DataFrame, limits: DataFrame, measures: str = "__measures") -> DataFrame:
    """``docs`` (with measures) and __base_failed, __kept. ``limits`` has a row
    per stratum (language). As a written table its size is known to the planner,
    which then needn't shuffle the texts by language to join it."""
    m = F.col(measures)
    named = limits.select(F.col("stratum").alias("__stratum"), *[F.col(r).alias(f"__{r}") for r in RULES])
    out = docs.withColumn("__stratum", stratum_of(docs)).join(named, "__stratum", "left")
    bad = reduce(lambda a, b: a | b, [rejects(r, m, F.col(f"__{r}")) for r in RULES])
    return (
        out.withColumn("__base_failed", base_failed(m))
        .withColumn("__kept", ~base_failed(m) & ~bad)
        .drop("__stratum", *[f"__{r}" for r in RULES])
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, *, risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed, kept.

    Cases: null and empty texts have no words and fail the base; a null lang is
    a stratum of its own; rows that repeat a doc_id are judged one by one; a
    null doc_id can't be labelled but is judged; without labels there are no
    cutoffs and the base decides; no documents give no rows; other columns are
    ignored."""
    measured = written(
        with_measures(docs.select("doc_id", "text", *(["lang"] if "lang" in docs.columns else []))).select(
            F.col("doc_id").cast("long").alias("doc_id"), stratum_of(docs).alias("lang"), F.col("__measures").alias("measures")
        ),
        "quality-measures",
    )
    limits = written(cutoffs(measured.withColumnRenamed("lang", "stratum"), labels, risk=risk, error=error), "quality-cutoffs")
    out = judged(measured, limits, "measures")
    return out.select(
        "doc_id",
        *[F.col(f"measures.{k}").alias(k) for k in MEASURES],
        F.col("__base_failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Texts are measured
    twice -- for the cutoffs, then in place -- and never moved: only measures meet
    the labels, as choosing the labelled texts first would shuffle all of them.

    The filter must not be pushed below the measures, where it would repeat
    their expressions; a row number, which isn't deterministic, holds it."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", stratum_of(docs).alias("stratum"))
    measured = with_measures(named).select("doc_id", "stratum", F.col("__measures").alias("measures"))
    limits = written(cutoffs(measured, labels, risk=risk, error=error), "quality-cutoffs")
    numbered = with_measures(docs).withColumn("__row", F.monotonically_increasing_id())
    kept = judged(numbered, limits).filter("__kept AND __row >= 0")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
