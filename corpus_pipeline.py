"""A training corpus from ``documents``: five stages, each one written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.llm import block_names, bpe_codec, decontaminate, parity_join, toxicity
from kinship.llm.common import materialise, read_table, without
from kinship.llm.queries import tokenizer_file

REJECT_FROM = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar, fitted on ``labels``, scores as toxic go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    column = "toxicity"
    while column in docs.columns:
        column += "_"
    return toxicity.with_score(docs, model, column).filter(F.col(column) < REJECT_FROM).drop(column)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal after lower-casing A-Z the row with the largest id stays."""
    rows = materialise(block_names.exact_groups(docs), "exact")
    twice = rows.groupBy("doc_id", "th").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    return without(docs, twice.filter("not kept"), twice.filter("kept and n > 1"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarities of 0.8 over five-word shingles connect, the first stays.

    Documents without words are linked with nothing and stay.
    """
    rows = materialise(parity_join.jaccard_components(docs, words=5, percent=80), "near")
    twice = rows.groupBy("doc_id", "th").agg(F.count("*").alias("n"), F.max("is_first").alias("kept"),
                                             F.max("n_shingles").alias("n_shingles"))
    return without(docs, twice.filter("not kept"), twice.filter("kept and n > 1 and n_shingles > 0"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row, or a whole shorter item, of ``benchmark`` go."""
    hits = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return without(docs, materialise(hits.filter("contaminated").select("doc_id", "th"), "contaminated"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digests of ids and decoded bytes."""
    import public_tokenizers

    coded = bpe_codec.encode(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, and_decode=True)
    return coded.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", encoded),
]

#: Neither the learned grammar nor the tokenizer can be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
