"""Normalisers and keyword sets: tables of inputs and outputs, and properties
that hold whatever the text."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinship.functions.sets import explain_pair
from kinship.functions.text import (
    LEADING_AUX,
    QUESTION_WORDS,
    STOP_WORDS_14,
    STOP_WORDS_35,
    keywords,
    normalize_basic,
    normalize_question,
    normalize_text,
)


def _run(spark, texts, col):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(col(F.col("t"))).collect()]


BASIC = {
    "  Deep Blue Sea\t\n": "deep blue sea", "　X ": "x", "\x1cA\x1f": "a", "᠎B": "᠎b",
    "In  ner": "in  ner", "": "", " \t": "", "ÄÖ ß": "äö ß",
}
QUESTION = {
    "What is the tallest tree in Norway?": "the tallest tree in norway", "is it snowing?": "it snowing", "who was": "was",
    "What": "", "  WHERE   were you, really?!": "you really", "what's up": "what's up", "a. b , c": "a b c",
    "how how much": "how much", "whichever way": "whichever way", "was is now": "is now", "isnt it": "isnt it",
    "Is": "is", "?!.,": "", "whom": "", "n.a.s.a. was": "nasa was",
}
TEXT = {
    "a\\b": "a\\b", "x[y]z": "x y z", "Don't-stop! ok?": "don t stop ok", "tab\there  now": "tab here now", " lead": "lead",
    "A_b{c}~d`e": "a b c d e", "3.5%": "3 5", "«é»": "«é»", "...": "",
}


def test_tables(spark):
    for rule, table in ((normalize_basic, BASIC), (normalize_question, QUESTION), (normalize_text, TEXT)):
        assert _run(spark, list(table), rule) == list(table.values())


KEYWORDS = {
    "The cat and the hat": ({"cat", "and", "hat"}, {"cat", "hat"}),
    "Who IS at the door, who?": ({"who", "door"}, {"door"}),
    "a an the": (set(), set()),
    "": (set(), set()),
    "red-red RED": ({"red"}, {"red"}),
}


def test_keyword_table(spark):
    for i, stop in enumerate(("14", "35")):
        got = _run(spark, list(KEYWORDS), lambda c: keywords(c, stop))
        assert [set(g) for g in got] == [v[i] for v in KEYWORDS.values()]
        assert all(len(g) == len(set(g)) for g in got)


def test_pairs(spark):
    pairs = [("green apples grow on old trees", "old trees grow green apples"), ("red kites fly high", "red foxes run fast"),
             ("one two three", "four five six"), ("the a of", "is was"),
             ("w1 w2 w3 w4 w5 w6 w7 w8 w9 w10", "w1 w2 w3 w4 w5 w6 w7 w8 w9")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = df.orderBy("i").select(*explain_pair(keywords("a"), keywords("b"))).collect()
    assert [(r.n_common, r.n_union) for r in rows] == [(5, 5), (1, 7), (0, 6), (0, 0), (9, 10)]
    assert [r.similarity for r in rows] == [1.0, 1 / 7, 0.0, 0.0, 0.9]
    assert rows[1].common == "red"


piece = st.sampled_from(list("abcXYZ .,?!'-\\\t\n  éß")
                       + ["what ", "is ", "was ", "who ", "Where "])
text_st = st.lists(piece, max_size=15).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(text_st, min_size=1, max_size=25))
def test_properties(spark, texts):
    padded = [" \t" + t + " \n" for t in texts]
    for rule in (normalize_basic, normalize_question, normalize_text):
        once = _run(spark, texts, rule)
        assert _run(spark, padded, rule) == once                            # space around a text changes nothing
        assert _run(spark, [t.swapcase() for t in texts if t.isascii()], rule) == [k for k, t in zip(once, texts) if t.isascii()]
        assert all(k == k.strip() and k == k.lower() for k in once)
    for rule in (normalize_basic, normalize_text):
        assert _run(spark, _run(spark, texts, rule), rule) == _run(spark, texts, rule)          # idempotent
    key = _run(spark, texts, normalize_question)
    assert not any(c in k for k in key for c in ".,?!\t\n") and not any("  " in k for k in key)
    led = [w + " " + k for w in QUESTION_WORDS for k in key if not k.startswith(tuple(a + " " for a in LEADING_AUX))]
    assert _run(spark, led, normalize_question) == [x.split(" ", 1)[1] for x in led]            # one leading word goes
    flat = _run(spark, texts, normalize_text)
    for stop, words in (("14", STOP_WORDS_14), ("35", STOP_WORDS_35)):
        got = [set(g) for g in _run(spark, texts, lambda c: keywords(c, stop))]
        assert [g | (set(k.split(" ")) & {*words, ""}) for g, k in zip(got, flat)] == [set(k.split(" ")) for k in flat]
        assert not any(g & {*words, ""} for g in got)
