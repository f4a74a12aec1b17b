"""Keyed-store enrichment job: every question is written, enriched with the
stored payload of its key where one exists.

Key = the question normaliser (punctuation, leading question word and
auxiliary removed). The store is the corpus deduplicated by key, last record
wins (an upsert). Outputs: enriched rows, sorted distinct unmatched question
texts, distinct matched/unmatched counts, per-file counts with a total, and
small ordered samples.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators import link
from kinship.operators.distinct_state import distinct_by_digest
from kinship.operators.strategy import cut_lineage, written
from kinship.plans.common import read_corpus, read_questions
from kinship.sources.sinks import write_jsonl, write_merged, write_sorted_lines

STORED = ("document_url", "document_title", "annotations", "long_answer_candidates")


def store(corpus: DataFrame) -> DataFrame:
    """Prepared corpus rows carrying the stored payload with its defaults."""
    s = corpus.schema
    return corpus.select(
        "key", "ord", "_file",
        F.col("corpus_question").alias("nq_original_question"),
        F.coalesce("document_url", F.lit("")).alias("document_url"),
        F.coalesce("document_title", F.lit("")).alias("document_title"),
        F.coalesce("annotations", F.array().cast(s["annotations"].dataType)).alias("annotations"),
        F.coalesce("long_answer_candidates", F.array().cast(s["long_answer_candidates"].dataType))
        .alias("long_answer_candidates"),
    )


def distinct_counts(rows: DataFrame, hit) -> DataFrame:
    """Distinct questions with and without a stored record, per dataset."""
    return distinct_by_digest(rows, "question", ["dataset"], {"questions_with_refs": hit, "questions_without_refs": ~hit})


def records_per_file(corpus: DataFrame) -> DataFrame:
    """Usable records of each file and of all (``TOTAL``)."""
    return (corpus.rollup("_file").agg(F.count(F.lit(1)).alias("questions"))
            .withColumn("_file", F.coalesce("_file", F.lit("TOTAL"))))


def unmatched_samples(unmatched: DataFrame, n: int = 5) -> DataFrame:
    """The first unmatched questions in text order and what they were looked up by."""
    first = unmatched.select("question").distinct().orderBy("question").limit(n)
    return link.prepare_questions(first, normalizer="question")


def stored_samples(matched: DataFrame, keyed: DataFrame, n: int = 5) -> DataFrame:
    """The stored originals of the first matched questions in text order. Only the
    records of their (at most ``n``) keys are indexed, not the whole store."""
    first = matched.select("question").distinct().orderBy("question").limit(n)
    keys = link.prepare_questions(first, normalizer="question").select("key").distinct()
    idx = link.corpus_index(keyed.join(F.broadcast(keys), "key", "left_semi"), "ord", ["nq_original_question"], keep="last")
    return idx.select("key", "nq_original_question")


def build(spark: SparkSession, corpus_dirs: Sequence[str], question_sets: Mapping[str, Sequence[str] | str],
          path_glob: str = "*.jsonl.gz", question_field: str = "question_text") -> dict[str, DataFrame]:
    corpus, corpus_bad = read_corpus(spark, list(corpus_dirs), question_field, path_glob=path_glob, whole=True)
    questions, q_bad = read_questions(spark, question_sets)
    cs = store(link.prepare_corpus(corpus, normalizer="question"))
    # a key is a normalised text: it is made once and written, for all that looks records up by it
    keyed = written(cs.select("key", "ord", "_file", "nq_original_question"), "keyed")
    qs = link.prepare_questions(questions, normalizer="question")
    payload = list(STORED) + ["nq_original_question"]
    # question fields of the same names stay in the record; on matched rows the payload replaces them
    qs = qs.select("dataset", "ord", "q_id", "question", "answer", "key", "_line")
    merged = link.exact_merge(qs, cs, "ord", payload, keep="last", how="left", index=link.key_index(keyed, "ord", keep="last"))
    enriched = cut_lineage(merged.drop("key"))      # no output has it: it need not travel with the rows
    hit = F.col("win_ord").isNotNull()
    matched_q = enriched.where(hit).select("dataset", "question").distinct()
    unmatched_q = enriched.where(~hit).select("dataset", "question").distinct()
    norm_samples = keyed.orderBy("ord").limit(5).select("key", "nq_original_question")
    return {
        "enriched": enriched.select("dataset", "ord", "question", "answer", *payload, hit.alias("matched"), "_line"),
        "unmatched_questions": unmatched_q,
        "matched_questions": matched_q,
        "counts": distinct_counts(enriched, hit),
        "per_file": records_per_file(keyed),
        "stored_samples": stored_samples(matched_q, keyed),
        "unmatched_samples": unmatched_samples(unmatched_q),
        "normalization_samples": norm_samples,
        "quarantine": corpus_bad.select("_file", "_corrupt_record", "_error")
        .unionByName(q_bad.select("_file", "_corrupt_record", "_error")),
    }


def run(spark: SparkSession, corpus_dirs, question_sets, out_dir: str, **kw) -> dict[str, DataFrame]:
    outs = build(spark, corpus_dirs, question_sets, **kw)
    write_merged(outs["enriched"], os.path.join(out_dir, "enriched"), F.col("matched"), [*STORED, "nq_original_question"])
    write_sorted_lines(outs["unmatched_questions"], "question", os.path.join(out_dir, "unmatched"),
                       by="dataset")
    for name in ("counts", "per_file", "stored_samples", "unmatched_samples", "normalization_samples", "quarantine"):
        write_jsonl(outs[name], os.path.join(out_dir, name))
    return outs
