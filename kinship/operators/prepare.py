"""Corpus preparation: simplify raw annotated records, answer spans, short answers.

All of it is per-record nested-array work (``transform``/``filter``/
``flatten``), so it runs as narrow projections inside the scan's stage with
no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kinship.functions.html import byte_slice, html_text_all
from kinship.functions.text import _col

BYTE_FIELDS = ("start_byte", "end_byte")

ERR_EMPTY_TOKENS = "Token count does not fit the text."
ERR_NULL_TOKEN = "Null token."


def clean_token(tok) -> Column:
    """A token with each blank replaced by '_' (so tokens stay blank-separated)."""
    return F.replace(_col(tok), F.lit(" "), F.lit("_"))


def tokens_text(tokens) -> Column:
    """``document_text``: cleaned ``token`` fields joined by single blanks."""
    return F.array_join(F.transform(_col(tokens), lambda t: clean_token(t["token"])), " ")


def nq_tokens(text) -> Column:
    """Blank-separated tokens of ``document_text`` (empty pieces are kept)."""
    return F.split(_col(text), " ", -1)


def span_text(text, start, end) -> Column:
    """``' '.join(tokens[start:end])``; null for a null span (start < 0)."""
    s, e = _col(start), _col(end)
    toks = nq_tokens(text)
    n = F.size(toks)
    # Python slice bounds: clip to [0, n]
    s2 = F.least(F.greatest(s, F.lit(0)), n)
    e2 = F.least(F.greatest(e, F.lit(0)), n)
    length = F.greatest(e2 - s2, F.lit(0))
    return F.when(s < 0, F.lit(None).cast("string")).otherwise(
        F.array_join(F.slice(toks, s2 + F.lit(1), length), " "))


def _drop_bytes(struct_col: Column, dtype) -> Column:
    names = [f.name for f in dtype.fields] if isinstance(dtype, StructType) else []
    drop = [n for n in BYTE_FIELDS if n in names]
    return struct_col.dropFields(*drop) if drop else struct_col


def simplify(df: DataFrame) -> DataFrame:
    """Raw records -> simplified records, plus ``n_tokens`` and ``error`` (null when valid).

    Invalid records (empty token list: the blank-joined text always splits
    into one piece; or a null token) keep their row and get a reason, so
    the caller can route them to a quarantine table.
    """
    schema = df.schema
    cand_t = schema["long_answer_candidates"].dataType.elementType
    ann_t = schema["annotations"].dataType.elementType
    la_t = ann_t["long_answer"].dataType
    sa_t = ann_t["short_answers"].dataType.elementType

    def clean_ann(a: Column) -> Column:
        return (a.withField("long_answer", _drop_bytes(a["long_answer"], la_t))
                .withField("short_answers",
                           F.transform(a["short_answers"], lambda s: _drop_bytes(s, sa_t))))

    toks = F.col("document_tokens")
    text = tokens_text(toks)
    null_tok = F.exists(toks, lambda t: t["token"].isNull())
    error = (F.when(toks.isNull() | null_tok, F.lit(ERR_NULL_TOKEN))
             .when(F.size(nq_tokens(text)) != F.size(toks), F.lit(ERR_EMPTY_TOKENS)))
    keep = [c for c in ("_source",) if c in df.columns]
    return df.select(
        *keep,
        "question_text",
        "example_id",
        "document_url",
        text.alias("document_text"),
        F.transform("long_answer_candidates", lambda c: _drop_bytes(c, cand_t)).alias("long_answer_candidates"),
        F.transform("annotations", clean_ann).alias("annotations"),
        F.size(toks).alias("n_tokens"),
        error.alias("error"),
    )


def short_answer_texts(html, annotations, max_tokens: int = 5, drop_blank: bool = False) -> Column:
    """Distinct texts of the short answers with at most ``max_tokens`` tokens,
    cut from the UTF-8 bytes of ``html`` and converted to text; sorted."""
    sas = F.flatten(F.transform(_col(annotations), lambda a: a["short_answers"]))
    sas = F.filter(sas, lambda s: (s["end_token"] - s["start_token"]) <= F.lit(max_tokens))
    frags = F.transform(sas, lambda s: byte_slice(html, s["start_byte"], s["end_byte"]))
    texts = html_text_all(frags)
    if drop_blank:
        texts = F.filter(texts, lambda x: x != "")
    return F.array_sort(F.array_distinct(texts))


def short_answers(df: DataFrame, max_tokens: int = 5, drop_blank: bool = False) -> DataFrame:
    """Raw records -> QA pairs ``(question, answer)``; records without a
    surviving short answer are dropped."""
    ans = short_answer_texts(F.col("document_html"), F.col("annotations"), max_tokens, drop_blank)
    # decided on the spans, before any text is cut: a filter on the answers
    # would be pushed below the projection and cut and decode everything twice
    some = F.exists("annotations", lambda a: F.exists(
        a["short_answers"], lambda s: s["end_token"] - s["start_token"] <= F.lit(max_tokens)))
    out = df.where(some).select(F.col("question_text").alias("question"), ans.alias("answer"), "example_id")
    return out.where(F.size("answer") > 0) if drop_blank else out


def shuffle_rows(df: DataFrame, seed: int = 0) -> DataFrame:
    """Rows in a seeded pseudo-random order (repeatable for a given seed)."""
    return df.orderBy(F.xxhash64(*[F.col(c) for c in df.columns], F.lit(seed)))
