"""Dense numbers of the lines of text files, the same for every size of splits.

A line's number says how many lines come before it, files in path order and
lines in file order. Every split counts its lines (a partial aggregate over two
small columns), the counts are summed up over the splits before, and a line's
number is its place within its split plus that sum. The splits are few against the lines,
but not bounded: their sums run per file, then over the files, and join by split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinship.operators.strategy import written


def placed_lines(spark: SparkSession, paths, **options) -> DataFrame:
    """``value, file, block, row``: every line and its place; ``row`` grows with
    the lines of a block. Holds within one evaluation, so write it before it is used twice."""
    return spark.read.options(**options).text([paths] if isinstance(paths, str) else list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))


def split_starts(placed: DataFrame) -> DataFrame:
    """``file, block, first_row, before``: the lines before each split."""
    per = placed.groupBy("file", "block").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n"))
    in_file = per.withColumn("ahead", F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n"))
    files = per.groupBy("file").agg(F.sum("n").alias("of_file"))
    # one row for each file: the only sum that runs over everything
    files = files.withColumn("earlier", F.sum("of_file").over(Window.orderBy("file")) - F.col("of_file")).select("file", "earlier")
    return in_file.join(files, "file").select("file", "block", "first_row", (F.col("ahead") + F.col("earlier")).alias("before"))


def numbered(placed: DataFrame, number: str = "ord") -> DataFrame:
    """``placed`` (written) with the dense ``number`` of every line, from 0, instead of its place."""
    starts = split_starts(placed)
    out = placed.join(starts, ["file", "block"])
    return out.withColumn(number, F.col("before") + F.col("row") - F.col("first_row")).drop("block", "row", "first_row", "before")


def numbered_lines(spark: SparkSession, paths, number: str = "ord", **options) -> DataFrame:
    """``value, file`` and ``number`` of every line of text files."""
    return numbered(written(placed_lines(spark, paths, **options), "lines"), number)
