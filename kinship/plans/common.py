"""Shared input handling of the end-to-end jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from kinship.operators.strategy import spread, written
from kinship.sources.jsonl import read_jsonl, split_valid, typed_payload, with_dataset, with_payload
from kinship.sources.schemas import QUESTION_RECORD, SIMPLIFIED_RECORD


def corpus_schema(question_field: str = "question_text", base: StructType = SIMPLIFIED_RECORD) -> StructType:
    """``base`` with its question field renamed (some inputs call it ``question``)."""
    return StructType([StructField(question_field if f.name == "question_text" else f.name, f.dataType)
                       for f in base.fields])


def read_corpus(spark: SparkSession, paths, question_field: str = "question_text",
                base: StructType = SIMPLIFIED_RECORD, path_glob: str | None = None,
                recursive: bool = False, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(records, quarantine)``; records carry ``ord`` and ``question_text``.

    The lines are parsed once, spread and written: every reader of the records
    sees the same ``ord``, and an unsplittable file is read by one task only once. With ``whole``, annotations
    and candidates are written as VARIANT, and an aggregate over what was written
    finds the fields that ``base`` does not list; the records carry them.
    """
    schema = corpus_schema(question_field, base)
    df = read_jsonl(spark, paths, schema, path_glob, recursive)
    nested = [f.name for f in schema if isinstance(f.dataType, ArrayType)] if whole else []
    if whole:
        df = with_payload(df, nested)
    good, bad = split_valid(written(spread(df.drop("_line")), "corpus"))
    if whole:
        good = typed_payload(good, schema, nested)
    if question_field != "question_text":
        good = good.withColumnRenamed(question_field, "question_text")
    return good, bad


def read_questions(spark: SparkSession, sets: Mapping[str, Sequence[str] | str],
                   schema: StructType = QUESTION_RECORD) -> tuple[DataFrame, DataFrame]:
    """All question sets in one DataFrame with a ``dataset`` column and
    ``q_id`` = record order; plus the quarantined lines."""
    frames = {name: read_jsonl(spark, p, schema) for name, p in sets.items()}
    df = with_dataset(frames).withColumn("q_id", F.col("ord"))
    return split_valid(written(spread(df), "questions"))


def first_per_dataset(df: DataFrame, n: int = 5, order: str = "ord") -> DataFrame:
    """The first ``n`` rows of each dataset (a per-group top-n)."""
    from pyspark.sql import Window

    w = Window.partitionBy("dataset").orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
