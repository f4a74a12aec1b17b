"""Writers: sorted text lines (optionally per dataset), keyed parquet, JSON lines."""

import glob
import json
import os

from kinship.sources.sinks import write_jsonl, write_keyed, write_sorted_lines


def _lines(folder):
    out = []
    for f in sorted(glob.glob(os.path.join(folder, "part-*"))):
        out += [x for x in open(f, encoding="utf-8").read().split("\n") if x]
    return out


def test_sorted_lines_per_dataset(spark, tmpdir_run):
    rows = [("dev", "b"), ("dev", "a"), ("test", "z"), ("dev", "b"), ("test", "é"), ("test", "c")]
    df = spark.createDataFrame(rows, "dataset string, question string").repartition(3)
    write_sorted_lines(df, "question", tmpdir_run, by="dataset")
    assert _lines(os.path.join(tmpdir_run, "dataset=dev")) == ["a", "b"]
    assert _lines(os.path.join(tmpdir_run, "dataset=test")) == ["c", "z", "é"]


def test_keyed_parquet_and_jsonl(spark, tmpdir_run):
    df = spark.createDataFrame([(k % 7, f"v{k}") for k in range(50)], "key int, v string")
    write_keyed(df, os.path.join(tmpdir_run, "keyed"), "key", partitions=4)
    back = spark.read.parquet(os.path.join(tmpdir_run, "keyed"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    write_jsonl(spark.createDataFrame([("q", None)], "question string, answer string"),
                os.path.join(tmpdir_run, "j"))
    assert [json.loads(x) for x in _lines(os.path.join(tmpdir_run, "j"))] == [{"question": "q", "answer": None}]


def test_jsonl_append_mode(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "a")
    one = spark.createDataFrame([("q1",)], "question string")
    write_jsonl(one, p)
    write_jsonl(spark.createDataFrame([("q2",)], "question string"), p, mode="append")
    assert sorted(json.loads(x)["question"] for x in _lines(p)) == ["q1", "q2"]
    write_jsonl(one, p)      # overwrite replaces
    assert [json.loads(x)["question"] for x in _lines(p)] == ["q1"]


def test_bucketed_tables_join_without_shuffle(spark, tmpdir_run):
    from kinship.sources.sinks import save_bucketed

    a = spark.createDataFrame([(k, f"a{k}") for k in range(40)], "key int, va string")
    b = spark.createDataFrame([(k, f"b{k}") for k in range(0, 40, 2)], "key int, vb string")
    save_bucketed(a, "kinship_test_a", "key", 4, path=os.path.join(tmpdir_run, "ta"))
    save_bucketed(b, "kinship_test_b", "key", 4, path=os.path.join(tmpdir_run, "tb"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("kinship_test_a").join(spark.table("kinship_test_b"), "key")
        assert j.count() == 20
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.sql("DROP TABLE IF EXISTS kinship_test_a")
        spark.sql("DROP TABLE IF EXISTS kinship_test_b")


def test_sorted_lines_hold_whole_texts(spark, tmpdir_run):
    from kinship.sources.sinks import read_sorted_lines

    texts = ["a\nb", "a\nc", "a\\nb", "a\\\nb", "a\\\\n", "\r\n", "\\", "\\\\r", "é\\r\r\\", "a", "\n\\\\\n"]
    write_sorted_lines(spark.createDataFrame([("d", t) for t in texts + texts], "dataset string, question string"),
                       "question", tmpdir_run, by="dataset")
    assert len(_lines(os.path.join(tmpdir_run, "dataset=d"))) == len(texts)
    assert sorted(r.question for r in read_sorted_lines(spark, tmpdir_run, "question").collect()) == sorted(texts)
