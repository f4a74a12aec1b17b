"""Streaming exact linkage over arriving question files."""

import json
import os

from kinship.operators.link import prepare_corpus
from kinship.streaming.link_stream import linked_stream, materialize_index, question_stream, start


def test_stream_links_new_files(spark, tmpdir_run):
    corpus = spark.createDataFrame([(0, "Who built the Mill?", "u0"), (1, "who built the mill?", "u1"),
                                    (2, "What is Rust", "u2")],
                                   "ord long, question_text string, document_url string")
    idx = materialize_index(prepare_corpus(corpus), ["document_url"])
    qdir = os.path.join(tmpdir_run, "q")
    os.makedirs(qdir)
    with open(os.path.join(qdir, "a.jsonl"), "w") as f:
        f.write(json.dumps({"question": "WHO BUILT THE MILL?", "answer": ["S"]}) + "\n")
        f.write(json.dumps({"question": "nothing", "answer": ["n"]}) + "\n")
    out = os.path.join(tmpdir_run, "out")
    q = start(linked_stream(question_stream(spark, qdir), idx, ["document_url"]), out,
              checkpoint=os.path.join(tmpdir_run, "cp"))
    q.awaitTermination(120)
    with open(os.path.join(qdir, "b.jsonl"), "w") as f:
        f.write(json.dumps({"question": "what is rust", "answer": ["r"]}) + "\n")
    q = start(linked_stream(question_stream(spark, qdir), idx, ["document_url"]), out,
              checkpoint=os.path.join(tmpdir_run, "cp"))
    q.awaitTermination(120)
    got = {(r.question, r.matched, r.document_url) for r in spark.read.parquet(out).collect()}
    assert got == {("WHO BUILT THE MILL?", True, "u1"), ("nothing", False, None), ("what is rust", True, "u2")}


def test_fuzzy_stream(spark, tmpdir_run):
    from kinship.streaming.link_stream import fuzzy_stream, materialize_corpus

    corpus = spark.createDataFrame(
        [(0, "where do the grey geese fly in winter", "u0"), (1, "who built the mill", "u1")],
        "ord long, question_text string, document_url string")
    cs = prepare_corpus(corpus, normalizer="text", url_col="document_url", require_url=True)
    static = materialize_corpus(cs, ["key", "ord", "document_url", "corpus_question"])
    qdir = os.path.join(tmpdir_run, "q")
    os.makedirs(qdir)
    with open(os.path.join(qdir, "a.jsonl"), "w") as f:
        f.write(json.dumps({"question": "where do grey geese in the winter fly", "answer": ["south"]}) + "\n")
        f.write(json.dumps({"question": "Who built the Mill?", "answer": ["S"]}) + "\n")
        f.write(json.dumps({"question": "nothing alike", "answer": ["n"]}) + "\n")
    out = os.path.join(tmpdir_run, "out")
    q = fuzzy_stream(question_stream(spark, qdir, normalizer="text"), static, out,
                     checkpoint=os.path.join(tmpdir_run, "cp"))
    q.awaitTermination(180)
    got = {(r.question, r.document_url, r.nq_similarity) for r in spark.read.parquet(out).collect()}
    assert got == {("where do grey geese in the winter fly", "u0", 1.0), ("Who built the Mill?", "u1", 1.0),
                   ("nothing alike", None, None)}
