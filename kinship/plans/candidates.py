"""Candidate search job: keyword inverted index over the corpus and the top
3 corpus questions (Jaccard >= 0.3, 35 stop words) for each question.

Optional samples as in an exploratory run: the first k files of each folder
(``{folder: k}``) or the first ``num_files`` corpus files in sorted order and the first ``num_questions`` questions; both
default to everything.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.functions.text import keywords, sorted_joined
from kinship.operators import link
from kinship.operators.fuzzy import match_counts, top_k_candidates
from kinship.operators.report import keyword_index_stats, keyword_postings
from kinship.operators.strategy import cut_lineage
from kinship.plans.common import read_corpus, read_questions
from kinship.sources.jsonl import first_files, first_records, sample_files
from kinship.sources.sinks import write_jsonl


def build(spark: SparkSession, corpus_paths: Sequence[str] | Mapping[str, int], question_paths, threshold: float = 0.3,
          k: int = 3, stop_words="35", num_files: int | None = None,
          num_questions: int | None = None) -> dict[str, DataFrame]:
    if isinstance(corpus_paths, Mapping):
        corpus_paths = sample_files(spark, corpus_paths)
    paths = first_files(spark, corpus_paths, num_files) if num_files else list(corpus_paths)
    corpus, corpus_bad = read_corpus(spark, paths)
    questions, q_bad = read_questions(spark, {"questions": question_paths})
    if num_questions:
        questions = first_records(questions, num_questions)
    cs = link.prepare_corpus(corpus)
    qs = link.prepare_questions(questions)
    top = cut_lineage(top_k_candidates(qs, cs, threshold, k, stop_words))
    with_q = top.join(qs.select("q_id", F.col("question").alias("target")), "q_id")
    no_match = (qs.join(top.select("q_id"), "q_id", "left_anti")
                .select("q_id", "question", sorted_joined(keywords("question", stop_words)).alias("keywords")))
    return {
        "candidates": with_q,
        "counts": match_counts(qs, top),
        "index_stats": keyword_index_stats(cs, "corpus_question", stop_words),
        "postings": keyword_postings(cs, "corpus_question", stop_words),
        "no_match_examples": no_match.orderBy("q_id").limit(5),
        "quarantine": corpus_bad.select("_file", "_corrupt_record", "_error")
        .unionByName(q_bad.select("_file", "_corrupt_record", "_error")),
    }


def run(spark: SparkSession, corpus_paths, question_paths, out_dir: str, **kw) -> dict[str, DataFrame]:
    outs = build(spark, corpus_paths, question_paths, **kw)
    for name, df in outs.items():
        write_jsonl(df.drop("q_id") if name == "candidates" else df, os.path.join(out_dir, name))
    return outs
