"""Exact deduplication by deterministic block naming.

The normalised bytes of a document are cut into blocks of a fixed size. All
blocks are sorted and each distinct one gets an integer name; then pairs of
adjacent names are sorted and named in turn, level by level, until every
document is one name. Equal names of one level stand for equal bytes, so
``(length, name)`` identifies a text without a collision. Rows are joined with
their names by id and a 64-bit hash of the text, so two texts under one id could
be taken for one another only if those hashes collide.

Sorting is hash-partitioned: equal keys meet in one partition and are
neighbours there, the name is the partition's number and the key's rank in
it. Equal keys of a batch are first combined into one numbered row that lists its
documents. Only keys and row numbers are sorted; the lists meet the names by the
row's number. So a block that a third of all rows share reaches its task once per
batch, without its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import keyed, lean, lower_ascii, materialise

_LIST = T.ArrayType(T.LongType())
COMBINED = T.StructType([
    T.StructField("key", T.BinaryType()),
    *(T.StructField(c, _LIST) for c in ("doc_id", "th", "n_bytes", "idx")),
])
NAMED = T.StructType([T.StructField("row", T.LongType()), T.StructField("name", T.LongType())])
_LISTS = pa.schema([("key", pa.binary()), *((c, pa.list_(pa.int64())) for c in ("doc_id", "th", "n_bytes", "idx"))])


def _combine(keys: list[bytes], cols: list[list]) -> pa.RecordBatch:
    """One row per distinct key with the lists of its documents and places."""
    at: dict[bytes, list[int]] = {}
    for i, k in enumerate(keys):
        at.setdefault(k, []).append(i)
    order = [i for v in at.values() for i in v]
    stops = np.cumsum([0, *map(len, at.values())])
    offsets = pa.array(stops, pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array([c[i] for i in order], pa.int64())) for c in cols]
    return pa.RecordBatch.from_arrays([pa.array(list(at), pa.binary()), *lists], schema=_LISTS)


def blocks(docs: DataFrame, size: int) -> DataFrame:
    """Fixed-size blocks of the normalised bytes; an empty text is one empty block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, cols = [], [[], [], [], []]
            for doc, th, raw in zip(*(c.to_pylist() for c in b.columns)):
                for i, at in enumerate(range(0, max(1, len(raw)), size)):
                    keys.append(raw[at:at + size])
                    for c, v in zip(cols, (doc, th, len(raw), i)):
                        c.append(v)
            yield _combine(keys, cols)

    return (keyed(docs)
            .select("doc_id", "th", F.encode(lower_ascii(F.col("text")), "utf-8").alias("raw"))
            .mapInArrow(lean(cut), COMBINED))


def adjacent(named: DataFrame) -> DataFrame:
    """Pairs of neighbouring names as keys (a last name without neighbour pairs with -1)."""
    pairs = (named.groupBy("doc_id", "th", "n_bytes", F.expr("idx div 2").alias("idx"))
             .agg(F.max(F.when(F.expr("idx % 2 = 0"), F.col("name"))).alias("a"),
                  F.coalesce(F.max(F.when(F.expr("idx % 2 = 1"), F.col("name"))), F.lit(-1)).alias("b")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = np.stack([b.column(c).to_numpy() for c in ("a", "b")], 1).astype(">i8").tobytes()
            yield _combine([raw[i:i + 16] for i in range(0, len(raw), 16)],
                           [b.column(c).to_pylist() for c in ("doc_id", "th", "n_bytes", "idx")])

    return pairs.select("doc_id", "th", "n_bytes", "idx", "a", "b").mapInArrow(lean(pack), COMBINED)


def name_keys(combined: DataFrame) -> DataFrame:
    """Sort the keys and give every distinct one an integer name: ``doc_id, th, n_bytes, idx, name``."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, rank, last = TaskContext.get().partitionId() << 40, 0, None
        for b in batches:
            names = []
            for k in b.column("key").to_pylist():
                if last is not None and k != last:
                    rank += 1
                last = k
                names.append(base + rank)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(names, pa.int64())], names=NAMED.names)

    # numbered once: what was written keeps its numbers when a task is run again
    rows = materialise(combined.withColumn("row", F.monotonically_increasing_id()), "keys")
    names = (rows.select("key", "row").repartition("key").sortWithinPartitions("key").mapInArrow(lean(name), NAMED))
    return (rows.drop("key").join(names, "row")
            .select("name", F.inline(F.arrays_zip("doc_id", "th", "n_bytes", "idx")))
            .select("doc_id", "th", "n_bytes", "idx", "name"))


def identities(docs: DataFrame, size: int = 4096) -> DataFrame:
    """``doc_id, th, n_bytes, name`` of every distinct document: ``(n_bytes, name)``
    is equal exactly where the normalised texts are."""
    level = materialise(name_keys(blocks(docs, size)), "names")
    n_blocks = f"greatest(1, (n_bytes + {size - 1}) div {size})"
    done, width = [], 1
    longest = level.select(F.max(F.expr(n_blocks))).first()[0] or 0
    while True:
        done.append(level.filter(F.expr(f"{n_blocks} <= {width}")))
        if longest <= width:
            break
        level = materialise(name_keys(adjacent(level.filter(F.expr(f"{n_blocks} > {width}")))), "names")
        width *= 2
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.groupBy("doc_id", "th").agg(F.max("n_bytes").alias("n_bytes"), F.max("name").alias("name"))


def exact_groups(docs: DataFrame, size: int = 4096) -> DataFrame:
    """Groups of texts that are identical after lower-casing A-Z only.

    Returns a row per row of ``docs``: ``doc_id``, ``th``, ``keep_id`` (the
    largest doc_id of the group), ``group_size``, ``kept`` and ``text_sha256``
    of the normalised text. A null text counts as empty. Null ids are smaller
    than all others; a group without ids keeps one row under a null
    ``keep_id``. Rows that repeat the largest id and text count as copies, one
    of them is kept. Texts that differ only in case are one group, whatever
    their ids. An empty table gives an empty result.
    """
    names = identities(docs, size)
    rows = keyed(docs).select("doc_id", "th", F.sha2(lower_ascii(F.col("text")), 256).alias("text_sha256"))
    # copies of one row are counted, not repeated, until the groups are known
    rows = rows.groupBy("doc_id", "th").agg(F.first("text_sha256").alias("text_sha256"), F.count("*").alias("copies"))
    m = materialise(
        rows.alias("r").join(names.alias("n"), F.expr("r.doc_id <=> n.doc_id and r.th = n.th"))
        .select("r.*", "n.n_bytes", "n.name"), "members")
    groups = materialise(
        m.groupBy("n_bytes", "name").agg(
            F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"),
            # the row that stays: its text variant breaks ties between equal ids
            F.max(F.struct("doc_id", "th"))["th"].alias("keep_th")), "groups")
    out = (m.join(groups, ["n_bytes", "name"])
           .withColumn("is_kept", F.expr("doc_id <=> keep_id and th = keep_th"))
           .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
    return out.select("doc_id", "th", "keep_id", "group_size",
                      (F.col("is_kept") & (F.col("copy") == 1)).alias("kept"), "text_sha256")
