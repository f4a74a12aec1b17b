"""Nothing that is read may vanish unseen: unknown fields, odd lines, odd answers."""

import json
import os

from kinship.plans import corpus_prep, exact_merge, fuzzy_link, keyed_enrich
from kinship.sources.jsonl import first_files, read_jsonl, sample_files, split_valid
from kinship.sources.schemas import QUESTION_RECORD

CORPUS = [{"example_id": 1, "question_text": "which river is the longest", "document_url": "u1", "document_title": "T"}]
LINES = [
    '{"question": " Which river is the longest? ", "answer": ["Nile"], "id": 7, "source": {"page": 3, "tags": ["x", null]}, '
    '"document_title": "mine"}',
    '\t{"question": "led by a tab", "answer": ["t"], "big": 12345678901234567890}',
    '{"question": "first of two", "answer": []}{"question": "second of two"}',
    '{"question": "one string", "answer": "scalar", "document_title": "kept"}',
    '{"question": 5, "answer": [1, "b"]}',
    '{"question": {"a": 1}}',
    '["not", "an", "object"]',
    '12',
    '{"question": "cut off',
    ' \t ',
]


def write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return path


def lines_of(folder):
    return [json.loads(x) for p, _, fs in os.walk(folder) for f in fs if f.startswith("part")
            for x in open(os.path.join(p, f), encoding="utf-8")]


def test_reader_accounts_for_every_line(spark, tmpdir_run):
    good, bad = split_valid(read_jsonl(spark, write(os.path.join(tmpdir_run, "q.jsonl"), LINES), QUESTION_RECORD))
    g = {r.question: r.answer for r in good.collect()}
    assert g["led by a tab"] == ["t"] and g["one string"] == ["scalar"]
    reasons = {r._corrupt_record: r._error for r in bad.collect()}
    assert reasons[LINES[2]] == "More than one JSON value on a line"
    assert reasons[LINES[6]] == reasons[LINES[7]] == "Not a JSON object"
    assert reasons[LINES[8]] == "Malformed JSON"
    assert good.count() + bad.count() == len(LINES) - 1           # all but the blank line


def test_all_fields_reach_the_outputs(spark, tmpdir_run):
    c = write(os.path.join(tmpdir_run, "c.jsonl"), CORPUS)
    q = write(os.path.join(tmpdir_run, "q.jsonl"), LINES)
    given = [json.loads(LINES[0]), json.loads(LINES[1]), json.loads(LINES[3])]
    fuzzy = os.path.join(tmpdir_run, "fuzzy")
    outs = fuzzy_link.run(spark, [c], {"d": q}, fuzzy)
    got = {r.get("question"): r for r in lines_of(os.path.join(fuzzy, "enriched")) if isinstance(r.get("question"), str)}
    assert got[given[0]["question"]] == {**given[0], "document_url": "u1", "nq_similarity": 1.0,
                                         "nq_question": "which river is the longest"}
    assert got["led by a tab"] == given[1] and got["one string"] == given[2]
    assert len(lines_of(os.path.join(fuzzy, "enriched"))) + outs["quarantine"].count() == len(LINES) - 1

    folder = os.path.join(tmpdir_run, "corpus")
    os.makedirs(folder)
    write(os.path.join(folder, "a.jsonl"), CORPUS)
    keyed = os.path.join(tmpdir_run, "keyed")
    outs = keyed_enrich.run(spark, [folder], {"d": q}, keyed, path_glob="*.jsonl")
    rows = lines_of(os.path.join(keyed, "enriched"))
    got = {r.get("question"): r for r in rows if isinstance(r.get("question"), str)}
    assert got[given[0]["question"]] == {**given[0], "document_url": "u1", "document_title": "T", "annotations": [],
                                         "long_answer_candidates": [], "nq_original_question": "which river is the longest"}
    assert got["one string"] == given[2]                            # its own document_title stays
    assert not any(k.startswith("_") or k in ("first_ord", "n_records", "win_ord", "key") for r in rows for k in r)
    sample = {r.question: r.key for r in outs["unmatched_samples"].collect()}
    assert sample["one string"] == "one string"


def test_unknown_annotation_fields(spark, tmpdir_run):
    span = {"start_token": 0, "end_token": 1, "start_byte": 0, "end_byte": 3}
    rec = {"example_id": 1, "question_text": "q", "document_url": "u", "document_html": "<p>", "document_title": "t",
           "document_tokens": [{"token": "<p>", "start_byte": 0, "end_byte": 3, "html_token": True}],
           "long_answer_candidates": [dict(span, top_level=True, note="n")],
           "annotations": [{"annotation_id": 99, "long_answer": dict(span, candidate_index=4), "short_answers": [dict(span, extra="e")],
                            "yes_no_answer": "NONE", "judge": {"name": "x"}}]}
    path = write(os.path.join(tmpdir_run, "r.jsonl"), [rec])
    out = os.path.join(tmpdir_run, "out")
    corpus_prep.run_simplify(spark, path, out)
    got = lines_of(out)[0]
    short = {"start_token": 0, "end_token": 1}
    assert got["annotations"] == [{"annotation_id": 99, "long_answer": dict(short, candidate_index=4),
                                   "short_answers": [dict(short, extra="e")], "yes_no_answer": "NONE", "judge": {"name": "x"}}]
    assert got["long_answer_candidates"] == [dict(short, top_level=True, note="n")]


def test_file_samples_from_folders(spark, tmpdir_run):
    for d, names in (("train", "cab"), ("dev", "zy")):
        os.makedirs(os.path.join(tmpdir_run, d))
        for n in names:
            write(os.path.join(tmpdir_run, d, f"{n}.jsonl"), CORPUS)
    train, dev = (os.path.join(tmpdir_run, d) for d in ("train", "dev"))
    base = lambda ps: [os.path.basename(p) for p in ps]      # noqa: E731
    assert base(first_files(spark, train, 2)) == ["a.jsonl", "b.jsonl"]
    assert base(first_files(spark, train + "/*.jsonl", 2)) == ["a.jsonl", "b.jsonl"]
    assert base(sample_files(spark, {train: 2, dev: 1})) == ["a.jsonl", "b.jsonl", "y.jsonl"]


def test_unknown_annotation_fields_reach_linked_outputs(spark, tmpdir_run):
    span = {"start_token": 0, "end_token": 1}
    ann = [{"annotation_id": 99, "long_answer": dict(span, candidate_index=4), "short_answers": [dict(span, extra="e")],
            "yes_no_answer": "NONE", "judge": {"name": "x"}}]
    cand = [dict(span, top_level=True, note="n")]
    folder = os.path.join(tmpdir_run, "corpus")
    os.makedirs(folder)
    # a quarantined record does not hide the fields of the others
    write(os.path.join(folder, "a.jsonl"), [dict(CORPUS[0], annotations=ann, long_answer_candidates=cand),
                                            dict(CORPUS[0], annotations="odd", long_answer_candidates=3), "cut {"])
    q = write(os.path.join(tmpdir_run, "q.jsonl"), [{"question": "Which river is the longest", "answer": ["Nile"]}])
    exact, keyed = (os.path.join(tmpdir_run, x) for x in ("exact", "keyed"))
    assert exact_merge.run(spark, [folder], {"d": q}, exact)["quarantine"].count() == 2
    keyed_enrich.run(spark, [folder], {"d": q}, keyed, path_glob="*.jsonl")
    for out in (os.path.join(exact, "matched"), os.path.join(keyed, "enriched")):
        got = lines_of(out)[0]
        assert got["annotations"] == ann and got["long_answer_candidates"] == cand


def test_unknown_fields_at_any_depth_in_one_scan(spark, tmpdir_run):
    """Payloads are VARIANT until written; names that SQL would misread, several types, repeated names."""
    from kinship.plans.common import read_corpus

    deep = [{"yes_no_answer": "NO", "a`b": {"OBJECT<": [{"z": 1}]}, "mixed": 1, "never": None},
            {"yes_no_answer": "YES", "mixed": {"k": "v"}, "n": 12345678901234567890}]
    path = write(os.path.join(tmpdir_run, "c.jsonl"), [
        dict(CORPUS[0], annotations=deep), dict(CORPUS[0], annotations=None), CORPUS[0], dict(CORPUS[0], annotations=[7]),
        '{"example_id": 5, "question_text": "twice", "annotations": [{"yes_no_answer": "NO"}], "question_text": "named twice"}'])
    good, bad = read_corpus(spark, path, whole=True)
    got = [json.loads(x) for x, in good.selectExpr("to_json(struct(example_id, annotations))").collect()]
    one = next(r["annotations"] for r in got if r["example_id"] == 1 and r.get("annotations"))
    assert one == [{**{k: v for k, v in deep[0].items() if v is not None}}, deep[1]]
    assert [a["yes_no_answer"] for r in got if r["example_id"] == 5 for a in r["annotations"]] == ["NO"]
    assert len(got) == 4 and [r._error for r in bad.collect()] == ["A field does not fit its type"]
    nothing, _ = read_corpus(spark, write(os.path.join(tmpdir_run, "e.jsonl"), [CORPUS[0]]), whole=True)
    assert nothing.first().annotations is None
