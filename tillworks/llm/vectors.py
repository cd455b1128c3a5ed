"""What the operators on embeddings share: which rows take part, and the usual length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there, isn't empty and holds finite numbers only."""
    each = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & each, F.lit(False))


def usual_length(vectors: DataFrame, column: str) -> int:
    """The commonest length; of equally common ones the longest. 0 for an empty table."""
    lengths = vectors.groupBy(F.size(column).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return first.length if first else 0
