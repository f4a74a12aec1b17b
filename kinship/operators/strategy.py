"""Physical-strategy helpers: joins whose hot keys can be split, written
intermediates, spreading of few-file inputs, skew-safe top-k.

AQE splits a skewed partition of a sort-merge join only where both inputs come
straight from a shuffle of the join itself. An input that is aggregated by the
join key is already partitioned by it, gets no shuffle and so blocks the
split. ``hot_join`` therefore joins on a digest of the key: the aggregate's
partitioning does not serve for that, both sides are shuffled, and the rows of
a key that a third of the probe side shares are dealt to several tasks. A
digest is also narrower than a long key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinship.session import checkpoint_dir


def digest(*cols: str) -> Column:
    """SHA-256 of the columns' text (nulls told apart from empty strings).

    Never null, also by its type: else a join's test for null keys would be
    pushed to the scan and compute the key there once more."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("0")) for c in cols]
    return F.coalesce(F.unhex(F.sha2(F.concat_ws("\x00", *parts), 256)), F.lit(b""))


def hot_join(probe: DataFrame, unique: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``probe`` joined with ``unique`` (one row per ``key``) so that AQE may split hot keys of ``probe``.

    ``unique`` has ``key`` or its digest ``_kd`` (``dedupe.digest_index``). Null keys never match.
    """
    def joined_by(d: Column, null: Column, if_null: bytes) -> Column:
        # not the expression that an index is grouped by, so that both sides are shuffled; nulls of the sides differ
        return F.when(null, F.lit(if_null)).otherwise(F.concat(F.lit(b"\x01"), d))

    p = probe.withColumn("_jd", joined_by(digest(key), F.col(key).isNull(), b"p"))
    if "_kd" in unique.columns:
        u = unique.withColumn("_jd", joined_by(F.col("_kd"), F.lit(False), b"u")).drop("_kd")
    else:
        u = unique.withColumn("_jd", joined_by(digest(key), F.col(key).isNull(), b"u")).drop(key)
    return p.join(u, "_jd", how).drop("_jd")


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: several
    readers share one computation, and a lost executor costs a re-read."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/kinship/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over the cores where it is read from fewer files than there
    are cores (one gzip file is one split, and so is a small parquet file); an
    input of many files is returned unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int, spread_by: str,
                    salts: int = 32, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each ``group`` by ``order`` (with ``rank_col``
    1..k), skew-safe: rows are first cut to ``k`` per
    ``(group, hash(spread_by) mod salts)``, so one group holding a third of
    all rows is ranked by many tasks, and the final ranking sees at most
    ``k * salts`` rows per group.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread_by)), F.lit(salts)))
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    part = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(group).orderBy(*order)
    return part.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder of the session."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
