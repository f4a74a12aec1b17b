"""A keyed store that takes batches: last record of a key wins, only touched buckets change.

Layout below ``root``: ``data/<batch>-<run>/bucket=<b>/`` holds a bucket's records,
``manifest/<version>/`` one row per bucket, with the folder of its records and the
batches that have gone in. A batch is merged into the buckets its keys fall into;
the others keep their files. The new manifest is written last, under the next
number and never over another: until then, readers see the store as it was, and a
run that fails leaves only folders that no manifest names. A batch that is
already in the store is not merged again, so a retry changes nothing. Two writers at
a time are not meant: the second to commit fails, since its version exists.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from kinship.operators.dedupe import digest_index
from kinship.operators.strategy import digest

MANIFEST = StructType([StructField("version", LongType()), StructField("bucket", IntegerType()), StructField("path", StringType()),
                       StructField("batches", ArrayType(StringType())), StructField("buckets", IntegerType())])


class UpsertStore:
    """``key``, ``ord`` and payload columns of the last record of every key.

    ``schema`` is that of the records, ``key`` and ``order`` name two of its
    columns. The number of buckets is fixed by the first batch.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str = "key", order: str = "ord", buckets: int = 64):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.order, self.buckets = key, order, buckets

    def manifest(self, version: int | None = None) -> list:
        """The rows of a version, by default the last one; at most one per bucket."""
        try:
            found = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{self.root}/manifest")
            found = found.filter(F.col("version") == version) if version else found.filter(
                F.col("version") == F.lit(found.agg(F.max("version")).first()[0]))
            return found.collect()
        except Exception as e:      # no folder yet: an empty store
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []

    def records(self, rows: list) -> DataFrame:
        """The records of the named buckets."""
        paths = sorted({r["path"] for r in rows})
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        return self.records([r for r in self.manifest(version) if r["path"]])

    def upsert(self, df: DataFrame, batch: str) -> int:
        """Merge a batch; its records win over stored ones, later ones over earlier ones.
        Returns the version that holds it."""
        old = self.manifest()
        version = old[0]["version"] if old else 0
        if old and batch in old[0]["batches"]:
            return version
        buckets = old[0]["buckets"] if old else self.buckets
        columns = self.schema.names
        bucket = F.pmod(F.xxhash64(digest(self.key)), F.lit(buckets)).cast("int")
        new = df.select(*columns).withColumn("bucket", bucket)
        touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}          # at most ``buckets`` numbers
        kept = [r for r in old if r["bucket"] not in touched]
        merge = [r for r in old if r["bucket"] in touched and r["path"]]
        stored = self.records(merge).withColumn("bucket", bucket)
        both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        last = digest_index(both.withColumn("_at", F.struct("_new", self.order)), self.key, "_at",
                            payload=[*columns, "bucket"], keep="last")
        folder = f"{self.root}/data/{batch}-{uuid.uuid4().hex}"
        # a bucket's records were dealt by key; its file count follows from its size
        (last.select(*columns, "bucket").repartition("bucket", F.pmod(F.xxhash64(self.key), F.lit(4)))
         .sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").parquet(folder))
        batches = [*(old[0]["batches"] if old else []), batch]
        rows = [(version + 1, r["bucket"], r["path"], batches, buckets) for r in kept]
        rows += [(version + 1, b, f"{folder}/bucket={b}", batches, buckets) for b in sorted(touched)]
        rows = rows or [(version + 1, -1, None, batches, buckets)]                          # an empty batch into an empty store
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{self.root}/manifest/{version + 1:012d}")
        return version + 1
