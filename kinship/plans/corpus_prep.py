"""Corpus preparation jobs: raw annotated HTML records -> simplified token
records, and raw records -> short-answer QA pairs.

Both are narrow per-record projections (no shuffle) except the optional
seeded shuffle of the QA pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators.prepare import short_answers, shuffle_rows, simplify
from kinship.sources.jsonl import full_schema, read_jsonl, read_jsonl_strict, split_valid
from kinship.sources.schemas import RAW_RECORD
from kinship.sources.sinks import write_jsonl

REQUIRED = ("question_text", "example_id", "document_url", "document_tokens",
            "long_answer_candidates", "annotations")


def simplify_records(spark: SparkSession, paths, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(simplified, rejected)``. ``strict``: a malformed line, missing
    field or token-count mismatch fails the job; otherwise such records go
    to ``rejected`` with a reason. Fields of annotations and answers that
    this package does not know are carried along."""
    schema = full_schema(spark, paths, RAW_RECORD)
    if strict:
        raw = read_jsonl_strict(spark, paths, schema, REQUIRED)
        s = simplify(raw.withColumn("_source", F.col("_metadata.file_name")))
        s = s.where(F.assert_true(F.col("error").isNull(), F.col("error")).isNull())
        return s.drop("error"), spark.createDataFrame([], "error string")
    good, bad = split_valid(read_jsonl(spark, paths, schema))
    s = simplify(good.withColumn("_source", F.element_at(F.split("_file", "/"), -1)))
    rejected = s.where(F.col("error").isNotNull()).select("example_id", "error")
    rejected = rejected.unionByName(bad.select(F.lit(None).cast("long").alias("example_id"),
                                               F.col("_error").alias("error")))
    return s.where(F.col("error").isNull()).drop("error"), rejected


def qa_pairs(spark: SparkSession, paths, max_tokens: int = 5, seed: int | None = None,
             drop_blank: bool = False) -> DataFrame:
    """QA pairs ``(question, answer[])`` from raw records; shuffled when a
    seed is given."""
    raw = read_jsonl_strict(spark, paths, RAW_RECORD, ("question_text", "document_html", "annotations"))
    qa = short_answers(raw, max_tokens, drop_blank).select("question", "answer")
    return shuffle_rows(qa, seed) if seed is not None else qa


SIMPLIFIED_FIELDS = ("question_text", "example_id", "document_url", "document_text",
                     "long_answer_candidates", "annotations")


def run_simplify(spark: SparkSession, paths, out: str, per_input_file: bool = False, **kw) -> None:
    """Write simplified records as JSON lines: all into ``out``, or one
    folder per input file."""
    s, _ = simplify_records(spark, paths, **kw)
    if per_input_file:
        (s.select(*SIMPLIFIED_FIELDS, F.col("_source").alias("source_file"))
         .write.mode("overwrite").partitionBy("source_file").json(out))
        return
    write_jsonl(s.select(*SIMPLIFIED_FIELDS), out)


def run_convert(spark: SparkSession, paths, out: str, **kw) -> None:
    write_jsonl(qa_pairs(spark, paths, **kw), out)
