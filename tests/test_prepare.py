"""Simplification, answer spans and short-answer extraction (FIXTURES F1/F2)."""

from pyspark.sql import functions as F

from kinship.operators.prepare import ERR_EMPTY_TOKENS, short_answers, simplify, span_text
from kinship.sources.schemas import RAW_RECORD


def tok(t):
    return {"token": t, "start_byte": 0, "end_byte": 0, "html_token": t.startswith("<")}


def span(s, e, sb=-1, eb=-1):
    return {"start_token": s, "end_token": e, "start_byte": sb, "end_byte": eb}


def raw(example_id, tokens, html="", annotations=None, question="q"):
    return {
        "example_id": example_id, "question_text": question, "document_url": f"http://x/{example_id}",
        "document_title": "t", "document_html": html,
        "document_tokens": [tok(t) for t in tokens],
        "long_answer_candidates": [dict(span(0, len(tokens), 0, 5), top_level=True)],
        "annotations": annotations if annotations is not None else
        [{"long_answer": span(0, len(tokens), 0, 5), "short_answers": [span(1, 2, 1, 2)],
          "yes_no_answer": "NONE"}],
    }


def test_simplify_tokens_and_errors(spark):
    rows = [
        raw(1, ['<Td colspan="2">', "a b", "x"]),
        raw(2, []),
        raw(3, "<P> The mill by the river turns all night long . </P>".split(" ")),
    ]
    df = spark.createDataFrame(rows, RAW_RECORD)
    out = {r.example_id: r for r in simplify(df).collect()}
    assert out[1].document_text == '<Td_colspan="2"> a b x'
    assert out[1].error is None
    assert out[2].error == ERR_EMPTY_TOKENS
    assert out[3].error is None
    # byte offsets are gone from every span
    assert set(out[3].annotations[0].long_answer.asDict()) == {"start_token", "end_token"}
    assert set(out[3].long_answer_candidates[0].asDict()) == {"start_token", "end_token", "top_level"}
    assert set(out[3].annotations[0].short_answers[0].asDict()) == {"start_token", "end_token"}


def test_span_text_worked_example(spark):
    text = "<P> The mill by the river turns all night long . </P>"
    df = spark.createDataFrame([(text, 0, 12), (text, 5, 8), (text, -1, -1), (text, 3, 2)],
                               "t string, s int, e int")
    got = [r[0] for r in df.select(span_text("t", F.col("s"), F.col("e"))).collect()]
    assert got == [text, "river turns all", None, ""]


ENT = "a &lt;b&gt; &eacute;t&eacute; &amp;amp;"   # needs the Python decoding path


def test_short_answers(spark):
    html = "<p>é ü ß</p><b>Short answer</b><i>one two three four five six</i><u>Short answer</u>"
    b = html.encode("utf-8")

    def bspan(frag, s_tok, e_tok):
        i = b.index(frag.encode("utf-8"))
        return span(s_tok, e_tok, i, i + len(frag.encode("utf-8")))

    ok = bspan("<b>Short answer</b>", 5, 9)          # 4 tokens: kept
    long6 = bspan("<i>one two three four five six</i>", 9, 15)   # 6 tokens: dropped
    dup = bspan("<u>Short answer</u>", 17, 21)        # same text again: one answer
    five = bspan("<i>one two three four five six</i>", 9, 14)    # exactly 5 tokens: kept
    rows = [
        raw(1, ["x"] * 25, html, [
            {"long_answer": span(-1, -1), "short_answers": [ok, long6], "yes_no_answer": "NONE"},
            {"long_answer": span(-1, -1), "short_answers": [dup, five], "yes_no_answer": "NONE"},
        ]),
        raw(2, ["x"] * 25, html, [
            {"long_answer": span(-1, -1), "short_answers": [long6], "yes_no_answer": "NONE"},
        ]),
        raw(3, ["x"], ENT, [
            {"long_answer": span(-1, -1), "short_answers": [span(0, 1, 0, len(ENT.encode()))],
             "yes_no_answer": "NONE"},
        ]),
    ]
    df = spark.createDataFrame(rows, RAW_RECORD)
    out = {r.example_id: r.answer for r in short_answers(df).collect()}
    assert out[1] == ["Short answer", "one two three four five six"]
    assert 2 not in out
    assert out[3] == ["a <b> été &amp;"]
