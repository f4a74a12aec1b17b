"""Entity decoding equals html.unescape (native fast path + Python fallback); fragments are read as by html.parser."""

import html
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from kinship.functions.html import _needs_reader, decode_entities, html_text, html_text_all
from kinship.functions.html_tokens import text_of

PARTS = ["&amp", "&amp;", "&lt", "&lt;", "&ltimes;", "&ampx", "&apos", "&apos;", "&#39", "&#39;",
         "&#390;", "&copy", "&middot.", "&nbsp", "x", " ", ";", "amp", "&", "&quot", "&gt;", "lt", "é"]


def test_decode_equals_unescape(spark):
    rng = random.Random(3)
    cases = ["&amp;&amp;&amp", "&amp;lt;", "&amplt;", "", "plain"] + [
        "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 8))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = {r.i: r.d for r in df.select("i", decode_entities("t").alias("d")).collect()}
    assert [got[i] for i in range(len(cases))] == [html.unescape(c) for c in cases]


class Reader(HTMLParser):
    """The library's tokenizer, without what script, style and template hold."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in HIDDEN

    def handle_endtag(self, tag):
        self.skip -= tag in HIDDEN and self.skip > 0

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


HIDDEN = ("script", "style", "template")
# closed constructs, on which every version of the library's tokenizer agrees
CLOSED = ["text ", "é", "a &amp; b ", "&copy; ", "<b>", "</b>", '<a href="x">', "<a title='1 > 0'>", '<a title="<i>" b=c>', "<br/>", "</a>",
          "<p class=x id = 'y>z' >", "<!-- > <b> -->", "<!-- a -- b -->", "<!DOCTYPE html>", "<?pi x?>", '<script>if (a < b) "</b>"</script>',
          "<STYLE>a>b{}</STYLE>", "<template>hidden <b>x</b></template>", "x > y ", " = ", '"', "'", "<a\nhref=\"q?a=1&b=2\"\n>"]


def test_tokenizer_equals_html_parser(spark):
    rng = random.Random(11)
    cases = ["", *CLOSED] + ["".join(rng.choice(CLOSED) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    want = []
    for c in cases:
        r = Reader()
        r.feed(c)
        r.close()
        want.append("".join(r.out))
    assert [html.unescape(text_of(c)) for c in cases] == want
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = {r.i: (r.one, r.all) for r in df.select("i", html_text("t").alias("one"), html_text_all(F.array("t", F.lit("<b>z"))).alias("all")).collect()}
    assert [got[i][0] for i in range(len(cases))] == want
    assert [got[i][1] for i in range(len(cases))] == [[w, "z"] for w in want]


def test_what_is_not_closed(spark):
    cases = {"a<!-- b <i>c</i>": "a", "a<script>b</scrip>": "a", "a<b title='>": "a", "a<": "a<", "a</": "a</", "1 < 2": "1 < 2", "a<3": "a<3",
             "a<!-->b": "ab", "a<!--->b": "ab", "a<!--x--!>b": "ab", "a</ x>b": "ab", "a</>b": "ab", "<b =\"x>\">y": "\">y",
             "a<script>x</script foo='>'>b": "ab", "a<template>b<template>c</template>d</template>e": "ae", "a</template>b": "ab",
             "<scripty>a</scripty>": "a", "a<b c=d>e": "ae", "<a b>c": "c", "x" * 100000 + "<" * 1000: "x" * 100000 + "<" * 1000, "a<!x": "a"}
    assert {c: text_of(c) for c in cases} == cases
    df = spark.createDataFrame([(c,) for c in cases] + [(None,)], "t string")
    got = {r.t: r.x for r in df.select("t", html_text("t").alias("x")).collect()}
    assert got == {**cases, None: None}


def test_plain_fragments_send_nothing_to_python(spark):
    df = spark.createDataFrame([('<a href="x?a=1&b=2" class=\'c\'>say "hi" &amp; go</a>',), ("1 > 0",)], "t string")
    assert [r.o for r in df.select(_needs_reader(F.col("t")).alias("o")).collect()] == [False, False]
