"""Explicit schemas of the record kinds (JSON is read with these, never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _span(with_bytes: bool) -> StructType:
    f = [StructField("start_token", IntegerType()), StructField("end_token", IntegerType())]
    if with_bytes:
        f += [StructField("start_byte", IntegerType()), StructField("end_byte", IntegerType())]
    return StructType(f)


def _candidate(with_bytes: bool) -> StructType:
    return StructType(_span(with_bytes).fields + [StructField("top_level", BooleanType())])


def _annotation(with_bytes: bool) -> StructType:
    return StructType([
        StructField("long_answer", _span(with_bytes)),
        StructField("short_answers", ArrayType(_span(with_bytes))),
        StructField("yes_no_answer", StringType()),
    ])


TOKEN = StructType([
    StructField("token", StringType()),
    StructField("start_byte", IntegerType()),
    StructField("end_byte", IntegerType()),
    StructField("html_token", BooleanType()),
])

# raw annotated corpus record (HTML + tokens + byte offsets)
RAW_RECORD = StructType([
    StructField("example_id", LongType()),
    StructField("question_text", StringType()),
    StructField("document_url", StringType()),
    StructField("document_title", StringType()),
    StructField("document_html", StringType()),
    StructField("document_tokens", ArrayType(TOKEN)),
    StructField("long_answer_candidates", ArrayType(_candidate(True))),
    StructField("annotations", ArrayType(_annotation(True))),
])

# simplified corpus record (blank-separated token text, token offsets only)
SIMPLIFIED_RECORD = StructType([
    StructField("example_id", LongType()),
    StructField("question_text", StringType()),
    StructField("document_url", StringType()),
    StructField("document_title", StringType()),
    StructField("document_text", StringType()),
    StructField("long_answer_candidates", ArrayType(_candidate(False))),
    StructField("annotations", ArrayType(_annotation(False))),
])

# question record of the QA side
QUESTION_RECORD = StructType([
    StructField("question", StringType()),
    StructField("answer", ArrayType(StringType())),
])
