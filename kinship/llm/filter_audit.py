"""What a chain of quality filters removes, in every order it could be run in.

Whether a document fails a filter does not depend on the other filters, so all
that an order changes is which filter gets the credit. Documents are reduced to
mask cells: per part and set of failed filters the number of documents and of
good and toxic ones. Per part, a Gray-code walk goes through all 32 sets of
filters, toggling one filter at a time: every cell counts its active failures,
and the running survivors change by the cells whose counter leaves or reaches
zero. The 32 states are kept; the steps of all 120 orders are differences.

Nulls and ties: a null text is empty, a null ``source`` the empty string. Rows
that repeat an id and a text are several documents, none of them a copy of the
other (their ids are equal, not smaller). A row with a null id has no smaller
id, and is nobody's original. Texts are equal when their SHA-256 is. An empty table
gives no rows. Several ``labels`` rows of one id count as one with the largest
marks; a null id has no label. Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import UPPER, materialise, whole_text

FILTERS = "ABCDE"
_ALL = (1 << len(FILTERS)) - 1
_COPY = 1 << FILTERS.index("E")

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def text_failures(text: Column, min_words: int, min_distinct: int, max_capitals: int) -> Column:
    """Bits of A (too few words), B (too few distinct words, in percent), C (too
    many capitals, in percent of the code points) and D (special characters)."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    fails = (n < min_words, distinct * 100 < n * min_distinct, capitals.cast("long") * 100 > F.length(text).cast("long") * max_capitals,
             text.rlike(r"[#$%&*|]"))
    mask = F.lit(0)
    for k, failed in enumerate(fails):
        mask = mask + F.when(failed, 1 << k).otherwise(0)
    return mask


def cells(docs: DataFrame, labels: DataFrame, min_words: int = 200, min_distinct: int = 50,
          max_capitals: int = 2) -> DataFrame:
    """``part, mask, n, good, toxic`` of every part and set of failed filters.

    Texts leave the scan as a digest. The first of equal texts is found by a
    partial aggregate and marked by a join on digest and id together, so that
    the rows of a large group of copies are dealt to many tasks.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                    whole_text().alias("text"))
    rows = d.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                    text_failures(F.col("text"), min_words, min_distinct, max_capitals).alias("mask"))
    rows = materialise(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n")), "audit-rows")
    first = materialise(rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null"), "audit-first")
    marks = materialise(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).cast("int").alias("good"),
                      (F.col("toxic") == 1).cast("int").alias("toxic"))
        .filter("doc_id is not null and (good = 1 or toxic = 1)").groupBy("doc_id")
        .agg(F.coalesce(F.max("good"), F.lit(0)).alias("good"), F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic")), "audit-marks")
    marked = rows.join(first.withColumn("original", F.lit(True)), ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    copy = F.when(F.col("doc_id").isNotNull() & F.col("original").isNull(), _COPY).otherwise(0)
    return marked.groupBy("part", (F.col("mask") + copy).alias("mask")).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.col("n") * F.col("good")), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0)).alias("toxic"))


def gray_walk(mask: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Survivors of each of the 32 sets of filters; ``weights`` has a row for each cell."""
    states = np.zeros((_ALL + 1, weights.shape[1]), np.int64)
    failing = np.zeros(len(mask), np.int64)             # active failures of every cell
    alive = weights.sum(0)
    states[0] = alive
    active = 0
    for step in range(1, _ALL + 1):
        bit = step & -step                              # the filter that the Gray code toggles
        active ^= bit
        has = (mask & bit) > 0
        if active & bit:
            alive = alive - weights[has & (failing == 0)].sum(0)
            failing += has
        else:
            failing -= has
            alive = alive + weights[has & (failing == 0)].sum(0)
        states[active] = alive
    return states


_ORDERS = list(permutations(range(len(FILTERS))))
_NAMES = ["".join(FILTERS[f] for f in order) for order in _ORDERS]
_FILTER = np.array(_ORDERS)
_AFTER = np.cumsum(1 << _FILTER, axis=1)
_BEFORE = _AFTER - (1 << _FILTER)


def steps(part: str, mask: np.ndarray, weights: np.ndarray) -> pa.Table:
    """All steps of all orders for one part, as differences of the walk's states."""
    states = gray_walk(mask, weights)
    lost = states[_BEFORE] - states[_AFTER]             # order, step, weight
    removed = lost[:, :, 0]
    bits = 1 << np.arange(len(FILTERS))
    fails = states[0, 0] - states[bits, 0]
    alone = states[_ALL ^ bits, 0] - states[_ALL, 0]
    shapley = np.zeros(len(FILTERS), np.int64)
    np.add.at(shapley, _FILTER, removed)
    columns = (states[_AFTER, 0], removed, fails[_FILTER] - removed, alone[_FILTER], lost[:, :, 1], lost[:, :, 2], shapley[_FILTER])
    per = len(FILTERS)
    return pa.table([pa.array([part] * _FILTER.size, pa.string()), pa.array(np.repeat(_NAMES, per)).cast(pa.string()),
                     pa.array(np.tile(np.arange(1, per + 1, dtype=np.int32), len(_ORDERS))),
                     *(pa.array(c.ravel()) for c in columns)], names=["part", "filter_order", "step", *COUNTS])


def audit(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """One row per part, order of the five filters and step; ``limits`` as in ``cells``.

    A group holds the cells of one part, 32 at most.
    """

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        weights = np.stack([table.column(c).to_numpy() for c in ("n", "good", "toxic")], 1).astype(np.int64)
        return steps(key[0].as_py(), table.column("mask").to_numpy().astype(np.int64), weights)

    return cells(docs, labels, **limits).groupBy("part").applyInArrow(walk, SCHEMA)
