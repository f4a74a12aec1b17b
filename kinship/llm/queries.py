"""The dealt operators as registered queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.llm import (
    block_names, bpe_codec, decontaminate, filter_audit, main_text, oracle_sql, parity_join, pii, prefix_trie, substring_dedup,
    suffix_dedup, toxicity, warc,
)
from kinship.llm import token_counts as counts
from kinship.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_suffix_array_dedup", oracle_sql.OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.dedup(read_table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    order = F.array(*map(F.lit, pii.KINDS))
    everything = F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(
        x["start"].alias("start"), F.array_position(order, x["kind"]).alias("nth"),
        x["end"].alias("end"), x["kind"].alias("kind"))))
    return found.select(
        "doc_id", *(F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}")
                    for k in pii.KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(everything).alias("spans"))


@query("op4_decontamination", oracle_sql.OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op5_warc", oracle_sql.OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    back = warc.read_archives(warc.write_archives(pages, warc.archive_folder(pages)))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_byte_bpe_codec")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe_codec.encode(read_table(spark, sf_dir, "documents"), *ranks, and_decode=True)
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_substring_dedup", oracle_sql.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.dedup(read_table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_words", F.expr("cast(aggregate(spans, 0L, (n, x) -> n + x.end - x.start) as bigint)").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_exact_dedup", oracle_sql.OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.exact_groups(read_table(spark, sf_dir, "documents")).drop("th")


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels)).drop("th")


@query("op10_jaccard_join", oracle_sql.OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.jaccard_components(read_table(spark, sf_dir, "documents"), words=3, percent=90).drop("th", "is_first")


@query("op11_html_extraction")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(read_table(spark, sf_dir, "pages"), main_text.fit())


@query("op12_filter_audit", oracle_sql.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op13_prefix_trie", oracle_sql.OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))
