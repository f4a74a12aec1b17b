"""Exact deduplication against grouping by the normalised text."""

import hashlib
import random

import pytest

from kinship.llm.block_names import exact_groups

SCHEMA = "doc_id long, text string, th string, name int, n_bytes string"
UP = {c: c + 32 for c in range(65, 91)}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 5, "y") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("size", [4, 16, 4096])
def test_groups(spark, size):
    rng = random.Random(1)
    base = ["", "A", "a", "abcd", "abcdabcd", "abcdabcdabcd", "ABCDabcde", "É", "é", "x" * 500, "x" * 499 + "y",
            "abcdefgh" * 40, "abcdefgh" * 39 + "abcdefgx"]
    rows = [(i, rng.choice(base)) for i in range(150)] + [(None, "a"), (None, "null only"), (None, None)]
    rows += [(149, rows[149][1]), (149, "x" * 500), (7, "Dup"), (7, "dUP")]
    got = exact_groups(frame(spark, rows), size).drop("th").collect()
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(UP), []).append(i)
    exp = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda x: (x is not None, x or 0), reverse=True)):
            exp.append((i, keep, len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(exp, key=str)


def test_empty_table(spark):
    assert exact_groups(frame(spark, [])).collect() == []


def test_hot_blocks_over_many_batches(spark):
    """Copies that fall into different batches get one name, at every level."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        long = "ab" * 9000
        rows = [(i, (long if i % 3 else long[:-1]) + ("" if i % 5 else "Z")) for i in range(90)]
        got = exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), 4096).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ends = {}
    for i, t in rows:
        ends.setdefault(t.lower(), []).append(i)
    want = {i: (max(g), len(g), i == max(g)) for g in ends.values() for i in g}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got} == want


def test_broadcast_sides_are_bound_by_bytes(spark):
    from pyspark.sql import functions as F

    from kinship.llm.common import small

    df = spark.range(50).select("id", F.array_repeat(F.struct("id", F.col("id").alias("b")), 100).alias("spans"), F.lit("x" * 10).alias("t"))
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()      # noqa: E731
    assert hinted(small(df, 50)) and hinted(small(df.limit(0), 0))
    assert not hinted(small(df, 49))
    assert hinted(small(df, 50, 50 * (16 + 8 + 1600 + 10))) and not hinted(small(df, 50, 50 * (16 + 8 + 1600 + 10) - 1))
    nested = spark.createDataFrame([(["a" * 500],)], "w array<string>")
    assert not hinted(small(nested, 9, 500)) and hinted(small(nested, 9, 600))
