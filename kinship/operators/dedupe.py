"""Keyed index with explicit record order (first-wins / last-wins dedupe).

The winner of a key is chosen by an explicit order column, never by
``dropDuplicates`` or ``first`` (whose choice depends on partitioning).
``max_by``/``min_by`` are declarative aggregates, so Spark runs them as a
partial (map-side) aggregate before the shuffle: a key holding a third of
all rows is reduced to one row per input partition before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.operators.strategy import digest

KEEP_MODES = ("last", "first")


def build_index(df: DataFrame, key: str, order: str, payload: Sequence[str] = (),
                keep: str = "last", drop_empty_keys: bool = False) -> DataFrame:
    """One row per ``key``.

    Columns: ``key``, ``first_ord`` (order of the first record of the key,
    used for tie-breaks), ``win_ord`` (order of the kept record: the last one
    for ``keep='last'``, the first for ``keep='first'``), ``n_records`` and,
    when ``payload`` is given, the payload columns of the kept record.
    The payload travels as one struct, so a null field of the winner is kept
    as null instead of being replaced by another record's value.
    """
    if keep not in KEEP_MODES:
        raise ValueError(f"keep must be one of {KEEP_MODES}")
    src = df.where(F.col(key) != "") if drop_empty_keys else df
    aggs: list[Column] = [
        F.min(order).alias("first_ord"),
        (F.max(order) if keep == "last" else F.min(order)).alias("win_ord"),
        F.count(F.lit(1)).alias("n_records"),
    ]
    if payload:
        pick = F.max_by if keep == "last" else F.min_by
        aggs.append(pick(F.struct(*[F.col(c) for c in payload]), F.col(order)).alias("_rec"))
    out = src.groupBy(key).agg(*aggs)
    if payload:
        out = out.select(key, "first_ord", "win_ord", "n_records",
                         *[F.col("_rec." + c).alias(c) for c in payload])
    return out


def digest_index(df: DataFrame, key: str, order: str, payload: Sequence[str] = (), keep: str = "last") -> DataFrame:
    """``build_index`` by the digest of the key: ``_kd`` names the key, whose text
    is neither shuffled nor returned (unless it is in ``payload``). ``hot_join``
    takes it as it is."""
    narrow = df.select(digest(key).alias("_kd"), order, *[c for c in payload if c != order])
    return build_index(narrow, "_kd", order, payload, keep=keep)


def attach_payload(rows: DataFrame, records: DataFrame, order: str, payload: Sequence[str],
                   win_col: str = "win_ord") -> DataFrame:
    """Late materialisation: fetch wide ``payload`` columns of the winning
    records for ``rows`` that carry ``win_col``.

    ``records`` comes straight from its scan, so AQE may broadcast the side
    that turns out small or split a record that many rows won; at scale Spark's
    runtime bloom filter prunes the scan to records that some row won.
    """
    wide = records.select(F.col(order).alias(win_col), *payload)
    return rows.join(wide, win_col, "left")
