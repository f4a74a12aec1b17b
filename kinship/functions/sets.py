"""Keyword-set similarity as Column expressions (intersection, union, Jaccard)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinship.functions.text import _col, sorted_joined


def n_common(a, b) -> Column:
    return F.size(F.array_intersect(_col(a), _col(b))).cast("bigint")


def n_union(a, b) -> Column:
    return F.size(F.array_union(_col(a), _col(b))).cast("bigint")


def jaccard(a, b) -> Column:
    """|a & b| / |a | b| as a double; 0.0 when either set is empty."""
    a, b = _col(a), _col(b)
    return (
        F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(n_common(a, b).cast("double") / n_union(a, b).cast("double"))
    )


def explain_pair(a, b) -> list[Column]:
    """Columns describing a keyword-set pair: sizes, common words, similarity."""
    return [
        F.size(_col(a)).cast("bigint").alias("n_kw1"),
        F.size(_col(b)).cast("bigint").alias("n_kw2"),
        n_common(a, b).alias("n_common"),
        n_union(a, b).alias("n_union"),
        sorted_joined(F.array_intersect(_col(a), _col(b))).alias("common"),
        jaccard(a, b).alias("similarity"),
    ]
