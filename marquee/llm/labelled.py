"""Labelled documents, bounded samples of them, and held-out splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(folds))


def known_labels(labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    """(doc_id, label) of each doc_id labelled 0 or 1 outside fold ``held``.
    Conflicting labels of a doc_id count as their least."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .filter(fold("doc_id", folds) != held)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each label 0
    and 1 outside fold ``held``, taken in the order of a hash of the doc_id. The
    label rows chosen -- 2 * per_class at most -- are broadcast, so no text is
    shuffled."""
    known = known_labels(labels, label, folds, held)
    order = F.xxhash64("doc_id", F.lit(label))
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    return texts(docs).join(F.broadcast(chosen), "doc_id")


def class_shares(labels: DataFrame, label: str, folds: int, held: int) -> tuple[int, int]:
    """Documents labelled 0 and 1 outside the held-out fold."""
    row = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold("doc_id", folds) != held))
        .agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
        .first()
    )
    return row["n0"], row["n1"]
