"""JSON-lines reading with quarantine and record order (FIXTURES F4)."""

import gzip
import os

from pyspark.sql import functions as F

from kinship.sources.jsonl import read_jsonl, split_valid, with_dataset, select_datasets
from kinship.sources.schemas import QUESTION_RECORD

LINES = [
    '{"question": "good one", "answer": ["a"]}',
    'not json',
    '',
    '[{"question": "in an array"}]',
    '{"question": null, "answer": ["x"]}',
    '{"answer": ["no question"]}',
    '{"question": "empty answer", "answer": []}',
    '{"question": "dup", "question": "dup2", "answer": ["d"]}',
    '{"question": "extra", "answer": ["e"], "more": 1}',
]


def test_quarantine_and_order(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "q.jsonl")
    with open(p, "w") as f:
        f.write("\n".join(LINES) + "\n")
    gz = os.path.join(tmpdir_run, "r.jsonl.gz")
    with gzip.open(gz, "wt") as f:
        f.write('{"question": "from gz", "answer": ["g"]}\n')
    df = read_jsonl(spark, [p, gz], QUESTION_RECORD)
    good, bad = split_valid(df)
    g = [r.question for r in good.orderBy("ord").collect()]
    assert g == ["good one", None, None, "empty answer", "dup2", "extra", "from gz"]
    b = sorted(r._error for r in bad.collect())
    assert b == ["Malformed JSON", "Not a JSON object"]
    assert good.where(F.col("question") == "empty answer").first().answer == []


def test_dataset_selector(spark):
    a = spark.createDataFrame([("x",)], "question string")
    b = spark.createDataFrame([("y",)], "question string")
    both = with_dataset({"train": a, "dev": b})
    assert {r.dataset for r in select_datasets(both, "dev").collect()} == {"dev"}
    assert both.count() == select_datasets(both, "both").count() == 2


def test_strict_reader_fails_on_bad_input(spark, tmpdir_run):
    import pytest

    from kinship.sources.jsonl import read_jsonl_strict

    ok = os.path.join(tmpdir_run, "ok.jsonl")
    with open(ok, "w") as f:
        f.write('{"question": "a", "answer": ["x"]}\n')
    assert read_jsonl_strict(spark, ok, QUESTION_RECORD, ["question"]).count() == 1
    bad = os.path.join(tmpdir_run, "bad.jsonl")
    with open(bad, "w") as f:
        f.write('{"question": "a", "answer": ["x"]}\nnot json\n')
    with pytest.raises(Exception):
        read_jsonl_strict(spark, bad, QUESTION_RECORD).collect()
    missing = os.path.join(tmpdir_run, "missing.jsonl")
    with open(missing, "w") as f:
        f.write('{"answer": ["x"]}\n')
    with pytest.raises(Exception):
        read_jsonl_strict(spark, missing, QUESTION_RECORD, ["question"]).collect()
