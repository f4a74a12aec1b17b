"""Helpers shared by the training-data operators.

A document is a row with ``doc_id`` and ``text``; every other column is
ignored, so clashing names in wider tables cannot reach an operator. Rows are
told apart by ``(doc_id, th)``, ``th`` being a 64-bit hash of the text: rows
that repeat both are the same document stored several times.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, a null as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, th, text`` of every row (null text: empty)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return d.select("doc_id", F.xxhash64("text").alias("th"), "text")


#: Buckets in which ``tagged`` looks up the ids that have several texts.
BUCKETS = 1 << 16


def tagged(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, text``: the tag tells texts under one id apart. It is ``th``,
    all 64 bits, and 0 where an id has one text, which the id alone names.

    What comes to the driver is the buckets of ids with several texts, at most
    ``BUCKETS``; an id that falls into one by chance has ``th`` as well, which
    changes no result.
    """
    d = keyed(docs)
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")
    several = (d.groupBy("doc_id").agg((F.min("th") != F.max("th")).alias("several")).filter("several")
               .select(bucket.alias("b")).distinct().collect())
    flags = bytearray(BUCKETS)
    for r in several:
        flags[r["b"]] = 1
    tag = F.when(F.substring(F.lit(flags), bucket + 1, 1) == F.lit(bytearray([1])), F.col("th")).otherwise(F.lit(0)) if several else F.lit(0)
    return d.select("doc_id", tag.cast("long").alias("tag"), "text")


def lower_ascii(col: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(col, UPPER, LOWER)


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/kinship-llm/{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation)
    and lets AQE see plain inputs, so it may split skewed join partitions.
    """
    spark = df.sparkSession
    path = shared_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most bytes of a broadcast side, whatever its number of rows.
MAX_BROADCAST_BYTES = 64 << 20


def row_bytes(schema: T.StructType) -> Column:
    """About what a row takes: 8 bytes a value, and the length of texts and lists."""

    def width(t: T.DataType) -> int:
        return sum(width(f.dataType) for f in t) if isinstance(t, T.StructType) else 8

    def of(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            e = f.dataType.elementType
            if isinstance(e, (T.StringType, T.BinaryType, T.ArrayType)):
                return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
            return F.coalesce(F.size(c), F.lit(0)) * F.lit(width(e))
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0))
        return F.lit(width(f.dataType))

    return sum((of(f).cast("long") for f in schema), F.lit(16).cast("long"))


def small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` as the broadcast side of a join if it has at most so many rows and
    bytes, else as it is: the join then shuffles, and AQE splits what is skewed."""
    first = df.select(row_bytes(df.schema).alias("w")).limit(max_rows + 1)
    n, w = first.agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and w <= max_bytes else df


def without(docs: DataFrame, dropped: DataFrame, repeated: DataFrame | None = None,
            max_broadcast: int = 200_000) -> DataFrame:
    """The rows of ``docs``, all columns, whose ``doc_id, th`` are not in ``dropped``;
    of rows that share an id and a text in ``repeated`` one is left."""

    def keys(df: DataFrame) -> DataFrame:
        return small(df.select("doc_id", "th").distinct(), max_broadcast).alias("k")

    same = F.expr("d.doc_id <=> k.doc_id and xxhash64(coalesce(d.text, '')) = k.th")
    d = docs.alias("d")
    if repeated is None or repeated.isEmpty():
        return d.join(keys(dropped), same, "left_anti")
    whole = "text_" + uuid.uuid4().hex          # clashes with no column
    once = (d.join(keys(repeated), same, "left_semi").withColumn(whole, whole_text())
            .dropDuplicates(["doc_id", whole]).drop(whole))
    rest = d.join(keys(dropped.select("doc_id", "th").unionByName(repeated.select("doc_id", "th"))), same, "left_anti")
    return rest.unionByName(once)


def release_memory() -> None:
    """Give memory that freed arrays leave with the allocators back to the system:
    Spark keeps a Python worker between tasks, beside the next stages' workers."""
    import ctypes
    import ctypes.util

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(ctypes.util.find_library("c") or None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def lean(f):
    """An Arrow batch function that releases its memory when its task ends."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            release_memory()

    return run
