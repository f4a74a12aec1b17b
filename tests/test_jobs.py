"""End-to-end jobs on small JSON-lines fixtures (gzip corpus, plain questions)."""

import gzip
import json
import os


from kinship.plans import candidates, corpus_prep, exact_merge, fuzzy_link, keyed_enrich

CORPUS = [
    {"example_id": 1, "question_text": "who built the mill", "document_url": "u1", "document_text": "<P> H </P>",
     "annotations": [{"long_answer": {"start_token": 0, "end_token": 3},
                      "short_answers": [{"start_token": 1, "end_token": 2}], "yes_no_answer": "NONE"}],
     "long_answer_candidates": [{"start_token": 0, "end_token": 3, "top_level": True}]},
    {"example_id": 2, "question_text": "Who built the Mill", "document_url": "u2", "document_text": "<P> H2 </P>"},
    {"example_id": 3, "question_text": "where do the grey geese fly in winter", "document_url": "u3"},
    {"example_id": 4, "question_text": "what is tree of norway", "document_url": "u4"},
    {"example_id": 5, "question_text": "", "document_url": "u5"},
]
DEV = [
    {"question": "who built the mill", "answer": ["a miller"]},
    {"question": "where do grey geese in the winter fly", "answer": ["south"]},
    {"question": "Tree of Norway?", "answer": []},
    {"question": "something else entirely", "answer": ["x"]},
]
TEST = [{"question": "WHO BUILT THE MILL ", "answer": ["S"]}]


def write_lines(path, rows, gz=False):
    op = gzip.open if gz else open
    with op(path, "wt", encoding="utf-8") as f:
        for r in rows:
            f.write((json.dumps(r) if isinstance(r, dict) else r) + "\n")


def fixture(d):
    os.makedirs(os.path.join(d, "train"))
    os.makedirs(os.path.join(d, "dev"))
    write_lines(os.path.join(d, "train", "c1.jsonl.gz"), CORPUS[:3] + ["{broken"], gz=True)
    write_lines(os.path.join(d, "dev", "c2.jsonl.gz"), CORPUS[3:], gz=True)
    write_lines(os.path.join(d, "dev.jsonl"), DEV)
    write_lines(os.path.join(d, "test.jsonl"), TEST)
    corpus = [os.path.join(d, "train", "c1.jsonl.gz"), os.path.join(d, "dev", "c2.jsonl.gz")]
    qsets = {"dev": os.path.join(d, "dev.jsonl"), "test": os.path.join(d, "test.jsonl")}
    return corpus, qsets


def test_exact_merge_job(spark, tmpdir_run):
    corpus, qsets = fixture(tmpdir_run)
    outs = exact_merge.run(spark, corpus, qsets, os.path.join(tmpdir_run, "out"))
    m = {(r.dataset, r.question): r for r in outs["matched"].collect()}
    assert set(m) == {("dev", "who built the mill"), ("test", "WHO BUILT THE MILL")}
    assert m[("dev", "who built the mill")].document_url == "u2"        # last record of the key
    assert m[("dev", "who built the mill")].annotations == []             # default for a missing field
    first = exact_merge.build(spark, corpus, qsets, keep="first")["matched"]
    assert {r.document_url for r in first.collect()} == {"u1"}
    rep = {r.dataset: (r.processed, r.matched, r.unmatched) for r in outs["report"].collect()}
    assert rep == {"dev": (4, 1, 3), "test": (1, 1, 0)}
    assert outs["quarantine"].count() == 1
    assert os.path.isdir(os.path.join(tmpdir_run, "out", "matched", "dataset=dev"))


def test_keyed_enrich_job(spark, tmpdir_run):
    _, qsets = fixture(tmpdir_run)
    dirs = [os.path.join(tmpdir_run, "train"), os.path.join(tmpdir_run, "dev")]
    outs = keyed_enrich.run(spark, dirs, qsets, os.path.join(tmpdir_run, "out"))
    e = {(r.dataset, r.question): r for r in outs["enriched"].collect()}
    assert len(e) == 5
    assert e[("dev", "Tree of Norway?")].document_url == "u4"   # question words dropped from both keys
    assert e[("dev", "something else entirely")].document_url is None
    assert e[("dev", "who built the mill")].nq_original_question == "Who built the Mill"
    lines = open([os.path.join(p, f) for p, _, fs in os.walk(os.path.join(tmpdir_run, "out", "unmatched", "dataset=dev"))
                  for f in fs if f.startswith("part")][0]).read().split("\n")
    assert "something else entirely" in lines


def test_fuzzy_job(spark, tmpdir_run):
    corpus, qsets = fixture(tmpdir_run)
    outs = fuzzy_link.run(spark, corpus, qsets, os.path.join(tmpdir_run, "out"))
    e = {(r.dataset, r.question): r for r in outs["enriched"].collect()}
    assert e[("dev", "where do grey geese in the winter fly")].nq_similarity == 1.0   # same keyword set
    assert e[("dev", "where do grey geese in the winter fly")].document_url == "u3"
    assert e[("dev", "who built the mill")].nq_similarity == 1.0
    u = {r.question: r.answer for r in outs["unmatched"].collect()}
    assert u["Tree of Norway?"] is None            # empty answer list: kept, no first answer
    assert u["something else entirely"] == "x"


def test_candidates_job(spark, tmpdir_run):
    corpus, qsets = fixture(tmpdir_run)
    outs = candidates.run(spark, corpus, qsets["dev"], os.path.join(tmpdir_run, "out"))
    c = outs["candidates"].collect()
    assert {(r.target, r.rank, r.nq_question) for r in c if r.target.startswith("where")} == {
        ("where do grey geese in the winter fly", 1, "where do the grey geese fly in winter")}
    cnt = outs["counts"].first()
    assert cnt.questions_with_matches + cnt.questions_without_matches == 4


def test_corpus_prep_jobs(spark, tmpdir_run):
    html = "<p>é</p><b>Paris</b>"
    b = html.encode()
    s = b.index(b"<b>")
    rec = {"example_id": 9, "question_text": "capital?", "document_url": "u", "document_title": "t",
           "document_html": html,
           "document_tokens": [{"token": t} for t in ["<p>", "é", "</p>", "<b>", "Paris", "</b>"]],
           "long_answer_candidates": [{"start_token": 0, "end_token": 6, "start_byte": 0, "end_byte": len(b),
                                       "top_level": True}],
           "annotations": [{"long_answer": {"start_token": 3, "end_token": 6, "start_byte": s, "end_byte": len(b)},
                            "short_answers": [{"start_token": 3, "end_token": 6, "start_byte": s,
                                               "end_byte": len(b)}],
                            "yes_no_answer": "NONE"}]}
    p = os.path.join(tmpdir_run, "raw.jsonl.gz")
    write_lines(p, [rec], gz=True)
    simp, rej = corpus_prep.simplify_records(spark, p)
    r = simp.first()
    assert r.document_text == "<p> é </p> <b> Paris </b>" and rej.count() == 0
    qa = corpus_prep.qa_pairs(spark, p, seed=1).collect()
    assert [(x.question, x.answer) for x in qa] == [("capital?", ["Paris"])]
    corpus_prep.run_simplify(spark, p, os.path.join(tmpdir_run, "simple"), per_input_file=True)
    assert os.listdir(os.path.join(tmpdir_run, "simple")).count("source_file=raw.jsonl.gz") == 1
    corpus_prep.run_convert(spark, p, os.path.join(tmpdir_run, "qa"))
    assert any(f.startswith("part") for f in os.listdir(os.path.join(tmpdir_run, "qa")))


def test_candidates_job_samples(spark, tmpdir_run):
    corpus, qsets = fixture(tmpdir_run)
    outs = candidates.build(spark, list(reversed(corpus)), qsets["dev"], num_files=1, num_questions=2)
    # first file in sorted path order only: dev/c2 (one non-empty question, one empty)
    assert outs["index_stats"].first().n_questions == 1
    assert outs["counts"].first().questions_with_matches + outs["counts"].first().questions_without_matches == 2


def test_cli_runs_jobs(spark, tmpdir_run):
    from kinship.cli import main

    corpus, qsets = fixture(tmpdir_run)
    qargs = [f"--questions={k}={v}" for k, v in qsets.items()]
    main(["exact", "--corpus", *corpus, *qargs, "--out", os.path.join(tmpdir_run, "e"), "--with-error"])
    main(["fuzzy", "--corpus", *corpus, *qargs, "--out", os.path.join(tmpdir_run, "f")])
    assert os.path.isdir(os.path.join(tmpdir_run, "e", "matched", "dataset=dev"))
    rows = spark.read.json(os.path.join(tmpdir_run, "f", "enriched")).collect()
    assert len(rows) == 5
