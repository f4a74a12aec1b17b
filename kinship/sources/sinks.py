"""Writers: JSON lines, sorted text lines, keyed (bucketed) tables, reports.

All writers are distributed: each task writes its own part file; no output
is funnelled through one task or the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators.strategy import digest

MODES = ("overwrite", "append", "error", "ignore")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", keep_nulls: bool = True,
                compression: str | None = None) -> None:
    """JSON lines, UTF-8 (non-ASCII kept). ``keep_nulls`` writes null fields
    as ``null`` instead of dropping them."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    w = df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower())
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def merged_json(line, hit, overlay: list[str]):
    """The JSON object ``line`` with all its fields, the ``overlay`` columns put
    over it where ``hit`` holds."""
    record = F.from_json(line, "map<string,variant>")
    over = F.from_json(F.to_json(F.struct(*overlay), {"ignoreNullFields": "false"}), "map<string,variant>")
    kept = F.map_filter(record, lambda k, _: ~k.isin(overlay))
    return F.to_json(F.when(hit, F.map_concat(kept, over)).otherwise(record), {"ignoreNullFields": "false"})


def write_merged(df: DataFrame, path: str, hit, overlay: list[str], line: str = "_line",
                 by: str = "dataset", mode: str = "overwrite") -> None:
    """Every row's whole input record as JSON lines, enriched where it matched,
    one folder per value of ``by``."""
    df.select(by, merged_json(F.col(line), hit, overlay).alias("value")).write.mode(mode).partitionBy(by).text(path)


def escaped_line(c):
    """A text as one line: backslash, line feed and carriage return as ``\\\\``, ``\\n``, ``\\r``."""
    for raw, esc in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(esc))
    return c


def unescaped_line(c):
    """The text that ``escaped_line`` made a line of."""
    def plain(p):
        return F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    # between escaped backslashes a backslash only stands before n or r
    return F.array_join(F.transform(F.split(c, r"\\\\"), plain), "\\")


def write_sorted_lines(df: DataFrame, col: str, path: str, mode: str = "overwrite",
                       by: str | None = None) -> None:
    """Distinct values of ``col`` as text lines in ascending order (a global
    range-partitioned sort: part files are in order). With ``by``, one
    folder per value of ``by`` (``by=value``), each sorted. A text is one line,
    whatever it holds (``escaped_line``); ``read_sorted_lines`` gives it back."""
    cols = ([by] if by else []) + [col]
    out = df.select(*[F.col(c).cast("string") for c in cols]).distinct().orderBy(*cols)
    w = out.withColumn(col, escaped_line(F.col(col))).write.mode(mode)
    if by:
        w = w.partitionBy(by)
    w.text(path)


def read_sorted_lines(spark: SparkSession, path: str, col: str) -> DataFrame:
    """The texts of ``write_sorted_lines`` as ``col``, and ``by`` if it was given."""
    return spark.read.text(path).withColumn("value", unescaped_line(F.col("value"))).withColumnRenamed("value", col)


def write_keyed(df: DataFrame, path: str, key: str, partitions: int | None = None,
                mode: str = "overwrite") -> None:
    """Parquet laid out by ``key``: hash-partitioned on the key and sorted
    within each file, so a later scan can prune and a join can merge.

    Meant for (near-)unique keys, such as a deduplicated index; a key that
    holds a large share of the rows would land in a single file. The number of
    files follows the data's size unless ``partitions`` is given."""
    dealt = df.repartition(partitions, key) if partitions else df.repartition(key)
    dealt.sortWithinPartitions(key).write.mode(mode).parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite",
                  path: str | None = None) -> None:
    """Catalog table bucketed and sorted by ``key``: joins of two tables
    bucketed alike on the key need no shuffle. ``path`` keeps the data at a
    chosen (shared) location instead of the warehouse folder."""
    w = df.write.mode(mode).bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def save_store(df: DataFrame, table: str, key: str, path: str | None = None, buckets: int | None = None) -> None:
    """A (near-)unique ``key``'s records as a table bucketed by the key's digest
    ``_kd``, which ``link.probe_store`` joins without a shuffle of the table. There are
    as many buckets as the session has shuffle partitions, so that the questions are dealt to them."""
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    save_bucketed(df.withColumn("_kd", digest(key)), table, "_kd", n, path=path)
