"""Integer vectors of an embeddings table, which the operators on embeddings share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def integer_vectors(
    table: DataFrame, *, key: str, vector: str, scale: int, shift: int, below: float, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, int]:
    """(rows, dimensions): ``key`` (long), the columns ``keep`` and x, an
    array<long> with floor(scale * c) + shift for every entry c.

    Rows whose vector is null or has a null, non-finite or too large entry
    (scale * |c| of ``below`` or more, where integers would no longer fit) are
    left out, and so are rows whose vector's length is not the commonest one (of
    lengths that are equally common, the longest). One aggregate of the lengths
    is run; dimensions is 0 if no row is left."""
    c = F.col(f"`{vector}`").cast("array<double>")
    usable = table.select(F.col(f"`{key}`").cast("long").alias(key), *[F.col(f"`{k}`") for k in keep], c.alias("__c")).filter(
        # NaN compares as the largest value
        F.coalesce(F.forall("__c", lambda e: F.coalesce(F.abs(e * scale) < below, F.lit(False))), F.lit(False))
    )
    sizes = usable.groupBy(F.size("__c").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    commonest = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    d = commonest["d"] if commonest else 0
    x = F.transform("__c", lambda e: F.floor(e * F.lit(float(scale))).cast("long") + F.lit(shift).cast("long"))
    return usable.filter(F.size("__c") == d).select(key, *[F.col(f"`{k}`") for k in keep], x.alias("x")), d
