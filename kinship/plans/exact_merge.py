"""Exact linkage job: questions -> matched records, unmatched, report.

Key = lower + strip; the corpus is deduplicated by key (last record wins by
default, ``keep='first'`` for the re-scan variants). All question sets are
linked in one join and split by ``dataset`` afterwards.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators import link
from kinship.operators.report import corpus_counters
from kinship.operators.strategy import cut_lineage
from kinship.plans.common import first_per_dataset, read_corpus, read_questions
from kinship.sources.sinks import write_jsonl

MERGED_FIELDS = ("question", "answer", "document_text", "document_url", "annotations",
                 "long_answer_candidates", "example_id")


def merged_record(df: DataFrame) -> DataFrame:
    """The 7-field merged record with defaults for absent corpus fields."""
    s = df.schema
    empty = {c: F.array().cast(s[c].dataType) for c in ("annotations", "long_answer_candidates")}
    return df.select(
        "dataset", "ord",
        F.col("question"),
        F.coalesce("answer", F.array().cast("array<string>")).alias("answer"),
        F.coalesce("document_text", F.lit("")).alias("document_text"),
        F.coalesce("document_url", F.lit("")).alias("document_url"),
        F.coalesce("annotations", empty["annotations"]).alias("annotations"),
        F.coalesce("long_answer_candidates", empty["long_answer_candidates"]).alias("long_answer_candidates"),
        F.col("example_id"),
    )


def build(spark: SparkSession, corpus_paths, question_sets: Mapping[str, Sequence[str] | str],
          keep: str = "last", question_field: str = "question_text", with_error: bool = False,
          normalizer: str = "basic") -> dict[str, DataFrame]:
    corpus, corpus_bad = read_corpus(spark, corpus_paths, question_field, whole=True)
    questions, q_bad = read_questions(spark, question_sets)
    cs = link.prepare_corpus(corpus, normalizer=normalizer)
    qs = link.prepare_questions(questions, normalizer=normalizer)
    payload = ["document_text", "document_url", "annotations", "long_answer_candidates", "example_id",
               "question_text"]
    # one left join feeds matched, unmatched and the report; checkpointed
    # once into the shared folder instead of recomputed per output
    linked = cut_lineage(link.exact_merge(qs, cs, "ord", payload, keep=keep, how="left"))
    hit = F.col("win_ord").isNotNull()
    matched = linked.where(hit)
    unmatched = linked.where(~hit).select(
        "dataset", "ord", "question", F.coalesce("answer", F.array().cast("array<string>")).alias("answer"))
    if with_error:
        unmatched = link.with_reason(unmatched)
    report = (linked.groupBy("dataset")
              .agg(F.count(F.lit(1)).alias("processed"), F.count_if(hit).alias("matched"))
              .withColumn("unmatched", F.col("processed") - F.col("matched"))
              .withColumn("match_rate", F.when(F.col("processed") > 0,
                                               F.col("matched") / F.col("processed") * F.lit(100.0))))
    examples = first_per_dataset(matched.select("dataset", "ord", "question",
                                                F.col("question_text").alias("nq_question")))
    return {
        "matched": merged_record(matched),
        "unmatched": unmatched,
        "report": report,
        "corpus_stats": corpus_counters(corpus, norm=normalizer),
        "examples": examples,
        "quarantine": corpus_bad.select("_file", "_corrupt_record", "_error")
        .unionByName(q_bad.select("_file", "_corrupt_record", "_error")),
    }


def run(spark: SparkSession, corpus_paths, question_sets, out_dir: str, **kw) -> dict[str, DataFrame]:
    """Build and write every output under ``out_dir`` (one folder each;
    matched/unmatched partitioned by dataset)."""
    outs = build(spark, corpus_paths, question_sets, **kw)
    for name in ("matched", "unmatched"):
        outs[name].drop("ord").write.mode("overwrite").partitionBy("dataset").option(
            "ignoreNullFields", "false").json(os.path.join(out_dir, name))
    for name in ("report", "corpus_stats", "examples", "quarantine"):
        write_jsonl(outs[name], os.path.join(out_dir, name))
    return outs
