"""Exact linkage of questions to a deduplicated corpus index.

Join shapes: inner (matched), left-anti (unmatched), left outer (enriched).
The index has one row per key, so every question matches at most once and
duplicate questions are all kept. Joins go through ``hot_join``: a key that
a third of all questions share is split over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.functions.text import normalizer as _normalizer
from kinship.functions.text import has_text, strip_ws
from kinship.operators.dedupe import attach_payload, build_index, digest_index
from kinship.operators.strategy import digest, hot_join

NO_MATCH = "No match found"


def prepare_corpus(corpus: DataFrame, question_col: str = "question_text", normalizer: str = "basic",
                   url_col: str | None = None, require_url: bool = False) -> DataFrame:
    """Corpus rows with a non-empty stripped question (and url if required),
    plus ``corpus_question`` (stripped original) and ``key``."""
    # filter with a cheap test on the raw text, then strip once
    out = corpus.where(has_text(question_col))
    out = out.withColumn("corpus_question", strip_ws(F.col(question_col)))
    if require_url:
        out = out.where(F.coalesce(F.col(url_col), F.lit("")) != "")
    return out.withColumn("key", _normalizer(normalizer)(F.col("corpus_question")))


def prepare_questions(questions: DataFrame, question_col: str = "question",
                      normalizer: str = "basic") -> DataFrame:
    """Questions with ``question`` replaced by its stripped form (null -> '')
    and a ``key`` column. Rows are never dropped here."""
    q = strip_ws(F.coalesce(F.col(question_col), F.lit("")))
    out = questions.withColumn("question", q)
    return out.withColumn("key", _normalizer(normalizer)(F.col("question")))


def corpus_index(corpus: DataFrame, order: str, payload: Sequence[str] = (), keep: str = "last",
                 drop_empty_keys: bool = False) -> DataFrame:
    """Deduplicated index of prepared corpus rows (see ``build_index``)."""
    return build_index(corpus, "key", order, payload, keep=keep, drop_empty_keys=drop_empty_keys)


def key_index(corpus: DataFrame, order: str, keep: str = "last") -> DataFrame:
    """Which record of each key counts, the key as its digest: no text is shuffled."""
    return digest_index(corpus.select("key", order), "key", order, keep=keep)


def unmatched(questions: DataFrame, index: DataFrame) -> DataFrame:
    """Questions whose key is not in the index."""
    return hot_join(questions, index.select("_kd" if "_kd" in index.columns else "key"), "key", "left_anti")


def with_reason(unmatched_rows: DataFrame, reason: str = NO_MATCH) -> DataFrame:
    """Unmatched rows with an ``error`` reason column."""
    return unmatched_rows.withColumn("error", F.lit(reason))


def exact_merge(questions: DataFrame, corpus: DataFrame, order: str,
                payload: Sequence[str], keep: str = "last", how: str = "inner",
                late: bool = True, index: DataFrame | None = None) -> DataFrame:
    """Questions joined (``how`` = inner or left) with the payload of the
    kept corpus record of their key.

    ``late=True`` matches on an index of key digests and orders and then fetches
    the wide payload by the winners' order. ``index`` is that index (``key_index``)
    where it has been made from keys that are written; ``corpus`` then needs no key.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if late:
        idx = key_index(corpus, order, keep) if index is None else index
        return attach_payload(hot_join(questions, idx, "key", how), corpus, order, payload)
    return hot_join(questions, corpus_index(corpus, order, payload, keep=keep), "key", how)


def probe_store(questions: DataFrame, table: str, how: str = "left", key: str = "key") -> DataFrame:
    """``questions`` joined (inner, left or left_anti) with a table of ``sinks.save_store``,
    whose side is read bucket by bucket: only the questions are shuffled."""
    store = questions.sparkSession.table(table)
    return questions.withColumn("_kd", digest(key)).join(store.drop(key), "_kd", how).drop("_kd")
