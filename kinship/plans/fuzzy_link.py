"""Fuzzy linkage job: exact key first, else the best keyword-set Jaccard
match at or above the threshold (default 0.9, 14 stop words).

Every question record is written with all its fields; matched ones gain ``document_url``,
``nq_similarity`` and ``nq_question``. Unmatched rows are also written as
``(question, first answer)``. The corpus keeps rows with a question and a
url; the last record of a key gives its payload, the first its rank.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators import link
from kinship.operators.fuzzy import best_match
from kinship.operators.strategy import cut_lineage
from kinship.plans.common import first_per_dataset, read_corpus, read_questions
from kinship.sources.sinks import write_jsonl, write_merged


ADDED = ["document_url", "nq_similarity", "nq_question"]


def first_answer(answer) -> F.Column:
    """``answer[0]``; '' when the field is absent, null when the list is empty."""
    a = F.col(answer) if isinstance(answer, str) else answer
    return F.when(a.isNull(), F.lit("")).otherwise(F.get(a, 0))


def build(spark: SparkSession, corpus_paths, question_sets: Mapping[str, Sequence[str] | str],
          threshold: float = 0.9, stop_words="14", question_field: str = "question_text") -> dict[str, DataFrame]:
    corpus, corpus_bad = read_corpus(spark, corpus_paths, question_field)
    questions, q_bad = read_questions(spark, question_sets)
    cs = link.prepare_corpus(corpus, normalizer="text", url_col="document_url", require_url=True)
    qs = link.prepare_questions(questions, normalizer="text")
    # several outputs read the linked rows: compute them once, keep them in
    # the shared checkpoint folder (survives executor loss, short lineage)
    res = cut_lineage(best_match(qs, cs, threshold, stop_words))
    res = res.withColumnRenamed("corpus_question", "nq_question")
    hit = F.col("nq_similarity").isNotNull()
    enriched = res.select("dataset", "ord", "question", "answer", *ADDED, "_line")
    unmatched = res.where(~hit).select("dataset", "ord", "question", first_answer("answer").alias("answer"))
    report = (res.groupBy("dataset")
              .agg(F.count(F.lit(1)).alias("processed"), F.count_if(hit).alias("matched"))
              .withColumn("match_rate", F.when(F.col("processed") > 0,
                                               F.col("matched") / F.col("processed") * F.lit(100.0))))
    examples = first_per_dataset(res.where(hit).select(
        "dataset", "ord", "question", first_answer("answer").alias("answer"), "nq_question",
        "document_url", "nq_similarity"))
    return {
        "enriched": enriched,
        "unmatched": unmatched,
        "report": report,
        "examples": examples,
        "corpus_keys": cs.agg(F.count_distinct("key").alias("questions_loaded")),
        "quarantine": corpus_bad.select("_file", "_corrupt_record", "_error")
        .unionByName(q_bad.select("_file", "_corrupt_record", "_error")),
    }


def run(spark: SparkSession, corpus_paths, question_sets, out_dir: str, **kw) -> dict[str, DataFrame]:
    outs = build(spark, corpus_paths, question_sets, **kw)
    write_merged(outs["enriched"], os.path.join(out_dir, "enriched"), F.col("nq_similarity").isNotNull(), ADDED)
    outs["unmatched"].drop("ord").write.mode("overwrite").partitionBy("dataset").json(os.path.join(out_dir, "unmatched"))
    for name in ("report", "examples", "corpus_keys", "quarantine"):
        write_jsonl(outs[name], os.path.join(out_dir, name))
    return outs
