"""Run statistics as DataFrames: match report per dataset, corpus counters,
keyword-index statistics and ordered example samples.

Every statistic is a distributed aggregate; nothing is counted on the driver.
The match rate is ``matched / processed * 100`` as an unrounded double, null
when nothing was processed (no division by zero).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.functions.text import has_text, keywords, normalizer, strip_ws
from kinship.operators.strategy import hot_join


def _rate(matched, processed):
    return F.when(processed > 0, matched.cast("double") / processed.cast("double") * F.lit(100.0))


def match_report(questions: DataFrame, index: DataFrame, by: str | None = "dataset") -> DataFrame:
    """processed / matched / unmatched / match_rate, per ``by`` or overall."""
    named = "_kd" if "_kd" in index.columns else "key"
    j = hot_join(questions, index.select(named).withColumn("_hit", F.lit(1)), "key", "left")
    aggs = [
        F.count(F.lit(1)).alias("processed"),
        F.count("_hit").alias("matched"),
    ]
    g = j.groupBy(by).agg(*aggs) if by else j.agg(*aggs)
    g = g.withColumn("unmatched", F.col("processed") - F.col("matched"))
    g = g.withColumn("match_rate", _rate(F.col("matched"), F.col("processed")))
    cols = ([by] if by else []) + ["processed", "matched", "unmatched", "match_rate"]
    return g.select(*cols)


def corpus_counters(raw: DataFrame, question_col: str = "question_text", norm: str = "basic") -> DataFrame:
    """One row, in one pass: records read, records with a non-empty question, distinct keys."""
    kept = has_text(question_col)
    key = F.when(kept, F.sha2(normalizer(norm)(strip_ws(F.col(question_col))), 256))
    return raw.agg(F.count(F.lit(1)).alias("corpus_records"), F.count_if(kept).alias("corpus_nonempty"),
                   F.count_distinct(key).alias("corpus_keys"))


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """The columns of several one-row frames as one row, without a join."""
    out = one_row[0]
    for df in one_row[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def keyword_postings(corpus: DataFrame, text_col: str, stop_words="35") -> DataFrame:
    """Inverted-index sizes: ``keyword`` -> number of corpus questions."""
    ex = corpus.select(F.explode(keywords(F.col(text_col), stop_words)).alias("keyword"))
    return ex.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_questions"))


def keyword_index_stats(corpus: DataFrame, text_col: str, stop_words="35") -> DataFrame:
    """One row: indexed questions, distinct keywords, postings."""
    p = keyword_postings(corpus, text_col, stop_words).agg(
        F.count(F.lit(1)).alias("n_keywords"), F.sum("n_questions").alias("n_postings"))
    questions = corpus.agg(F.count(F.lit(1))).scalar()  # scalar subquery, no join
    return p.select(questions.alias("n_questions"), "n_keywords", "n_postings")


def first_n(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order`` (a top-n, not a full sort)."""
    return df.orderBy(order).limit(n)
