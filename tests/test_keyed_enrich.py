"""The keyed job makes a record's key once, and indexes for its samples only what they show."""

import contextlib
import io
import json
import os

import pytest

from kinship.operators import link
from kinship.plans import keyed_enrich

CORPUS = ["What is the tallest tree?", "when the tallest tree", "the TALLEST tree.", "who is blue", "was grey", None, "  ", "the tallest tree"]
QUESTIONS = ["the tallest tree", "Where is the tallest tree", "grey!", "grey", "nobody", "", None, "blue"]


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture()
def outs(spark, tmpdir_run):
    corpus, questions = os.path.join(tmpdir_run, "corpus"), os.path.join(tmpdir_run, "q.jsonl")
    os.makedirs(corpus)
    for path, name, rows in ((os.path.join(corpus, "c.jsonl"), "question_text", CORPUS), (questions, "question", QUESTIONS)):
        with open(path, "w", encoding="utf-8") as f:
            f.writelines(json.dumps({name: r, "document_title": f"t{i}"}) + "\n" for i, r in enumerate(rows))
    return keyed_enrich.run(spark, [corpus], {"d": questions}, os.path.join(tmpdir_run, "out"), path_glob="*.jsonl")


def test_rows(outs):
    # the last record of a key wins; the last line of this corpus has the key of the first three
    got = sorted((r.question, r.document_title, r.nq_original_question, r.matched) for r in outs["enriched"].collect())
    assert [g[0] for g in got] == sorted(q.strip() if q else "" for q in QUESTIONS)
    assert {g[1:] for g in got if "tallest" in g[0]} == {("t7", "the tallest tree", True)}
    assert {g[1:] for g in got if "grey" in g[0]} == {("t4", "was grey", True)}
    assert {g[1:] for g in got if g[0] in ("", "nobody")} == {(None, None, False)}
    stored = {(r.key, r.nq_original_question) for r in outs["stored_samples"].collect()}
    assert stored == {("the tallest tree", "the tallest tree"), ("grey", "was grey"), ("blue", "who is blue")}
    assert [r.nq_original_question for r in outs["normalization_samples"].collect()] == CORPUS[:5]
    assert {r.questions for r in outs["per_file"].collect()} == {6}


def test_keys_are_made_once(outs):
    # these read written keys: no text of the corpus is normalised again
    assert "regexp_replace" not in plan(outs["normalization_samples"])
    assert "regexp_replace" not in plan(outs["per_file"])


def test_samples_index_their_own_keys_only(spark, outs):
    # the rows are cut to the samples' keys below the aggregate, not after it
    for df in (outs["stored_samples"], keyed_enrich.stored_samples(
            spark.createDataFrame([("b c",), ("a",)], "question string"),
            link.prepare_corpus(spark.createDataFrame([("A", 1), ("a.", 2), ("z", 3)], "question_text string, ord long"), normalizer="question")
            .withColumnRenamed("corpus_question", "nq_original_question"))):
        text = plan(df)
        assert 0 <= text.index("max_by") < text.index("LeftSemi")
    assert [tuple(r) for r in df.collect()] == [("a", "a.")]
