"""Stored inverted index over keyword sets, probed by question batches.

``build_store`` writes ``sets`` (a record of each distinct keyword set), ``tokens`` (the
number of each keyword, by frequency), ``coded`` (the sets as numbers, dealt to the
shares of ``set_cells``, a file each) and ``blocks`` (posting lists of each share cut into blocks,
a file for each share, dealt over folders). ``probe`` finds the sets of the store
that are similar to a batch of questions from these tables alone: the corpus text
is not read again. The order of the keywords in a set is the store's; keywords that
the store does not know come first and have no postings.

A share's sets are of one band of sizes, so a question goes to the shares of sizes that
can be similar enough and meets there the postings of its own keywords only. A task reads
the files of its share: the store is not shuffled for a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators.set_cells import Cells, coded, filed, token_numbers
from kinship.operators.simjoin import prefix_length, with_ids, with_numbers
from kinship.operators.strategy import written

#: Postings in one block at most, about.
BLOCK = 512


def build_store(sets: DataFrame, path: str, t: float, folders: int = 16) -> None:
    """Write the store of ``sets`` (``rid``, ``kw`` and any other columns) for
    similarities of at least ``t``. Postings of a frequent keyword are dealt over blocks by
    their sets, so no task holds a whole posting list."""
    spark = sets.sparkSession
    sets.write.mode("error").parquet(f"{path}/sets")
    sized = with_numbers(spark.read.schema(sets.schema).parquet(f"{path}/sets"), "rid")
    sized.select("no", "rid").write.parquet(f"{path}/numbers")
    token_numbers(sized.select(F.explode("kw").alias("token"))).write.parquet(f"{path}/tokens")
    codes = coded(sized, _tokens(spark, path))
    cells = Cells.of(codes, t)
    cells.dealt(codes, f"{path}/coded")
    places = written(_read_coded(spark, path).select("band", "share", "no", F.posexplode(F.slice("codes", F.lit(1), prefix_length(F.col("sz"), t)))
                                                     .alias("place", "code")).withColumn("place", F.col("place") + 1), "places")
    longest = places.groupBy("band", "share", "code").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    part = F.pmod(F.xxhash64("no"), F.lit(-(-longest // BLOCK)))
    blocks = places.groupBy("band", "share", "code", part.alias("part")).agg(F.collect_list(F.struct("no", "place")).alias("p"))
    blocks = blocks.select("band", "share", "code", F.col("p.no").alias("sets"), F.col("p.place").alias("places"),
                           F.pmod(F.xxhash64("band", "share"), F.lit(folders)).alias("folder"))
    filed(blocks, f"{path}/blocks", "folder", "band", "share")
    shares = ",".join(f"{b}:{n}" for b, n in sorted(cells.shares.items()))
    spark.createDataFrame([(float(t), shares, cells.size)], PostingStore.SETTINGS).coalesce(1).write.parquet(f"{path}/settings")


def _tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("token string, code int").parquet(f"{path}/tokens")


def _read_coded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("no long, sz int, codes array<int>, band int, share int").parquet(f"{path}/coded")


class PostingStore:
    """A store that ``build_store`` has written."""

    BLOCKS = "band int, share int, code int, sets array<long>, places array<int>"
    SETTINGS = "t double, shares string, size long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        held = spark.read.schema(self.SETTINGS).parquet(f"{path}/settings").first()
        self.t = held["t"]
        self.cells = Cells(self.t, dict(tuple(map(int, x.split(":"))) for x in held["shares"].split(",") if x), held["size"])
        self.sets = spark.read.parquet(f"{path}/sets")

    def probe(self, questions: DataFrame, t: float | None = None) -> DataFrame:
        """``lid, rid, n_common, sim`` of all sets of the store that are similar by
        ``t`` (at least the store's own) or more to ``questions`` (``lid, kw``)."""
        return self.best(questions, None, t)

    def best(self, questions: DataFrame, k: int | None, t: float | None = None) -> DataFrame:
        """``probe`` that may leave out pairs of which the question has ``k`` better ones (ties to the smaller ``rid``)."""
        t = t or self.t
        if t < self.t:
            raise ValueError(f"the store holds prefixes for similarities from {self.t}")
        asked = with_numbers(questions, "lid")
        mine = coded(asked, _tokens(self.spark, self.path))
        blocks = self.spark.read.schema(self.BLOCKS).parquet(f"{self.path}/blocks")
        held = _read_coded(self.spark, self.path)
        rids = self.spark.read.parquet(f"{self.path}/numbers")
        return with_ids(self.cells.pairs(mine, held, k, t, blocks), asked, rids, "lid", "rid")
