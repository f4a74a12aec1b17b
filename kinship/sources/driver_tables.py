"""Stand-ins built from the driver's parquet tables.

No driver table is shaped like a QA set, so ``documents`` plays both roles
(every row takes part, none is dropped to save work):

* even ``doc_id`` rows are the *questions*: ``question`` = text,
  ``answer`` = [lang], ``dataset`` = lang, ``ord`` = doc_id;
* odd ``doc_id`` rows are the *corpus*: ``question_text`` = text,
  ``document_url`` = source, ``document_title`` = lang,
  ``document_text`` = text, ``example_id`` = ``ord`` = doc_id.

Queries with one side only take every row of the table (``whole=True``).

``pages`` supplies raw annotated HTML records (see ``raw_pages``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.session import table

# Token pattern of the raw-record stand-in: a whole tag, or a run of
# characters that are neither '<' nor ASCII blank (tab, LF, VT, FF, CR, space).
TOKEN_PATTERN = r"<[^>]*>|[^<\t\n\x0B\f\r ]+"


# columns of ``documents`` any stand-in reads (``n_chars`` is never read)
DOC_COLUMNS = ["doc_id", "text", "lang", "source"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", columns=DOC_COLUMNS)


def is_question_row() -> Column:
    return F.col("doc_id") % 2 == 0


def questions(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Even rows, where the others are the corpus; ``whole``: every row."""
    d = documents(spark, sf_dir)
    return (d if whole else d.where(is_question_row())).select(
        F.col("doc_id").alias("q_id"),
        F.col("doc_id").alias("ord"),
        F.col("text").alias("question"),
        F.array(F.col("lang")).alias("answer"),
        F.col("lang").alias("dataset"),
    )


def corpus(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Odd rows, where the others are the questions; ``whole``: every row."""
    d = documents(spark, sf_dir)
    return (d if whole else d.where(~is_question_row())).select(
        F.col("doc_id").alias("example_id"),
        F.col("doc_id").alias("ord"),
        F.col("text").alias("question_text"),
        F.col("source").alias("document_url"),
        F.col("lang").alias("document_title"),
        F.col("text").alias("document_text"),
    )


# Elements of a page that stand in for annotated short answers, and the pattern of each.
ANSWER_ELEMENTS = (("title", r"(?s)<title>.*?</title>"), ("h1", r"(?s)<h1>.*?</h1>"), ("a", r"(?s)<a .*?</a>"))


def _n_tokens(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0))


def _element_spans(html: Column, pattern: str) -> Column:
    """Spans (token and UTF-8 byte offsets) of all elements that match, in page order.

    The page is cut into what stands between the elements and the elements;
    an element starts after the tokens and bytes of all pieces before it.
    """
    pieces = F.arrays_zip(
        F.transform(F.split(html, pattern, -1), lambda g: F.struct(_n_tokens(g).alias("t"), F.octet_length(g).alias("b"))).alias("gap"),
        F.transform(F.regexp_extract_all(html, F.lit(pattern), 0),
                    lambda m: F.struct(_n_tokens(m).alias("t"), F.octet_length(m).alias("b"))).alias("el"))
    none = F.array().cast("array<struct<start_token:int,end_token:int,start_byte:int,end_byte:int>>")

    def add(acc: Column, p: Column) -> Column:
        t, b = acc["t"] + p["gap"]["t"], acc["b"] + p["gap"]["b"]
        span = F.struct(t.alias("start_token"), (t + p["el"]["t"]).alias("end_token"),
                        b.alias("start_byte"), (b + p["el"]["b"]).alias("end_byte"))
        # after the last gap there is no element
        return F.struct(F.coalesce(t + p["el"]["t"], t).alias("t"), F.coalesce(b + p["el"]["b"], b).alias("b"),
                        F.when(p["el"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    start = F.struct(F.lit(0).alias("t"), F.lit(0).alias("b"), none.alias("out"))
    return F.aggregate(pieces, start, add, lambda acc: acc["out"])


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as raw annotated records.

    Tokens are the tags and blank-free words of the HTML. Annotation 1 has
    the whole page as long answer and all ``title``, ``h1`` and ``a`` elements
    as short answers; annotation 2 has a null long answer (-1) and the ``h1``
    elements again.
    """
    p = table(spark, sf_dir, "pages", columns=["page_id", "url", "html"])
    html = F.col("html")
    toks = F.regexp_extract_all(html, F.lit(TOKEN_PATTERN), 0)
    spans = {n: _element_spans(html, pattern) for n, pattern in ANSWER_ELEMENTS}
    null_span = F.struct(*[F.lit(-1).alias(n) for n in ("start_token", "end_token", "start_byte", "end_byte")])
    whole = F.struct(F.lit(0).alias("start_token"), F.size(toks).alias("end_token"),
                     F.lit(0).alias("start_byte"), F.octet_length(html).alias("end_byte"))

    ann1 = F.struct(whole.alias("long_answer"),
                    F.concat(*spans.values()).alias("short_answers"),
                    F.lit("NONE").alias("yes_no_answer"))
    ann2 = F.struct(null_span.alias("long_answer"),
                    spans["h1"].alias("short_answers"),
                    F.lit("NONE").alias("yes_no_answer"))
    cand = F.struct(*[whole[n].alias(n) for n in ("start_token", "end_token", "start_byte", "end_byte")],
                    F.lit(True).alias("top_level"))
    return p.select(
        F.col("page_id").alias("example_id"),
        F.col("url").alias("question_text"),
        F.col("url").alias("document_url"),
        F.lit(None).cast("string").alias("document_title"),
        html.alias("document_html"),
        F.transform(toks, lambda t: F.struct(t.alias("token"))).alias("document_tokens"),
        F.array(cand).alias("long_answer_candidates"),
        F.array(ann1, ann2).alias("annotations"),
    )
