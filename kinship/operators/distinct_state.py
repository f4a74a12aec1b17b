"""Exact distinct counts whose states are kept and merged later.

A key gets a dense number once; what a file (or run) holds is then a set of
numbers, kept as bitmaps of 32,768 numbers each. Bitmaps of any choice of files
are merged by OR and counted, without reading a key again, and a file that is
read anew replaces its own state only.

Numbers of new keys run by the first group that holds them, so that a group's
numbers lie next to each other and its bitmaps are full, not strewn over all
buckets. A number, once given, stays: later batches number only keys that are not
known yet, from the next free number on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinship.operators.strategy import digest, written

# rows of a partition below this are told apart by monotonically_increasing_id
_PARTITION_BITS = 33


def group_keys(rows: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """``by, _kd``: the distinct keys of every group as digests, written. Null keys are not counted."""
    return written(rows.where(F.col(key).isNotNull()).select(*by, digest(key).alias("_kd")).distinct(), "group-keys")


def number_keys(keys: DataFrame, by: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """``_kd, _n`` of the keys of ``group_keys`` that ``known`` numbers do not have.

    Sorted ranges count their rows; a key's number is its place in its range plus
    the rows of the ranges before (one row a range, summed over all of them) plus
    the numbers that are given away already.
    """
    first = keys.groupBy("_kd").agg(F.min(F.struct(*by)).alias("_first"))
    if known is not None:
        first = first.join(known, "_kd", "left_anti")
    ranges = first.repartitionByRange("_first", "_kd").sortWithinPartitions("_first", "_kd").select("_kd")
    placed = written(ranges.withColumn("_at", F.monotonically_increasing_id()), "key-places")
    part = F.shiftright("_at", _PARTITION_BITS)
    counts = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select("_p", (F.sum("_rows").over(Window.orderBy("_p")) - F.col("_rows")).alias("_start"))
    given = F.lit(0) if known is None else F.lit(known.agg(F.coalesce(F.max("_n") + 1, F.lit(0))).first()[0])
    place = F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    return (placed.withColumn("_p", part).join(starts, "_p")
            .select("_kd", (place + F.col("_start") + given).cast("long").alias("_n")))


def states(keys: DataFrame, numbers: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, bucket, bitmap`` of ``group_keys``: the numbers of each group."""
    n = keys.join(numbers, "_kd").select(*by, (F.col("_n") + 1).alias("_b"))   # buckets hold numbers from 1
    return (n.groupBy(*by, F.bitmap_bucket_number("_b").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_b")).alias("bitmap")))


def merged_counts(state: DataFrame, by: Sequence[str], count: str = "n_distinct", total: bool = False) -> DataFrame:
    """Exact distinct keys of every ``by`` group over all states, and with ``total``
    of every prefix of ``by`` as well (those rows have nulls in the other columns).

    States of one group and bucket are combined before they are counted, so a key that
    many files hold counts once. An empty state gives no group; a total of it has no row.
    """
    levels = range(len(by) + 1) if total else [len(by)]
    out = None
    for n in levels:
        per = state.groupBy(*by[:n], "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        one = (per.groupBy(*by[:n]) if n else per.groupBy(F.lit(0).alias("_all"))).agg(F.sum(F.bitmap_count("bitmap")).alias(count))
        one = one.select(*by[:n], *[F.lit(None).cast(state.schema[c].dataType).alias(c) for c in by[n:]], count)
        out = one if out is None else out.unionByName(one)
    return out


def distinct_by_digest(rows: DataFrame, key: str, by: Sequence[str], flags: dict) -> DataFrame:
    """Distinct ``key`` values of every ``by`` group for each named flag: one
    distinct over digests instead of an expansion of every row by flag."""
    named = {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}
    d = (rows.where(F.col(key).isNotNull()).groupBy(*by, digest(key).alias("_kd"))
         .agg(*[F.max(flag).alias(name) for name, flag in named.items()]))
    have = d.groupBy(*by).agg(*[F.count_if(F.col(name)).alias(name) for name in named])
    # groups of null keys only have a row of zeros, as with count_distinct
    none = rows.where(F.col(key).isNull()).select(*by).distinct()
    return (have.unionByName(none.select(*by, *[F.lit(0).cast("long").alias(name) for name in named]))
            .groupBy(*by).agg(*[F.sum(name).alias(name) for name in named]))
