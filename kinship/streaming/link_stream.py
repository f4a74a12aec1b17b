"""Exact linkage of question files as they arrive (Structured Streaming).

The corpus index is static: it is built once, written as a keyed parquet
table in the shared checkpoint folder and read back, so each micro-batch
joins against a scan instead of recomputing the dedupe. The question stream
is left-joined to it (stream-static join: no streaming state is kept), and
every question comes out once with ``matched`` and the kept record's
payload. Progress is tracked in a checkpoint under ``spark.checkpoint.dir``
so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinship.operators import link
from kinship.session import checkpoint_dir
from kinship.sources.schemas import QUESTION_RECORD
from kinship.sources.sinks import write_keyed


def materialize_index(corpus: DataFrame, payload: Sequence[str], keep: str = "last",
                      path: str | None = None) -> DataFrame:
    """Build the keyed index of prepared ``corpus`` once and return a scan of it."""
    spark = corpus.sparkSession
    path = path or os.path.join(checkpoint_dir(spark), "index-" + uuid.uuid4().hex)
    idx = link.corpus_index(corpus, "ord", list(payload), keep=keep)
    write_keyed(idx, path, "key")
    return spark.read.parquet(path)


def question_stream(spark: SparkSession, directory: str, normalizer: str = "basic",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of prepared questions from JSON-lines files."""
    r = spark.readStream.schema(QUESTION_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.json(directory).withColumn("_file", F.col("_metadata.file_path"))
    return link.prepare_questions(df, normalizer=normalizer)


def linked_stream(questions: DataFrame, index: DataFrame, payload: Sequence[str]) -> DataFrame:
    out = questions.join(index.select("key", "win_ord", *payload), "key", "left")
    return out.withColumn("matched", F.col("win_ord").isNotNull()).drop("win_ord")


def start(df: DataFrame, out_path: str, name: str = "linked", once: bool = True,
          checkpoint: str | None = None) -> StreamingQuery:
    """Write the linked stream as parquet; ``once`` processes what is there
    now and stops (``availableNow``), else it keeps running."""
    cp = checkpoint or os.path.join(checkpoint_dir(df.sparkSession), f"stream-{name}")
    w = df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", cp)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")
    return w.start()


def materialize_corpus(corpus: DataFrame, columns: Sequence[str], path: str | None = None) -> DataFrame:
    """Write prepared corpus rows once to the shared checkpoint folder and
    return a scan of them (the static side of a streaming join)."""
    spark = corpus.sparkSession
    path = path or os.path.join(checkpoint_dir(spark), "corpus-" + uuid.uuid4().hex)
    corpus.select(*columns).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fuzzy_stream(questions: DataFrame, corpus: DataFrame, out_path: str, threshold: float = 0.9,
                 stop_words="14", name: str = "fuzzy", once: bool = True,
                 checkpoint: str | None = None) -> StreamingQuery:
    """Exact-then-fuzzy best match of each micro-batch of ``questions``
    (prepared with the keyword normaliser) against a static prepared corpus
    (``key``, ``ord``, ``document_url``, ``corpus_question``).

    Each batch is written under ``batch_id=<n>`` with dynamic partition
    overwrite, so a batch replayed after a failure replaces its own output
    instead of duplicating it.
    """
    from kinship.operators.fuzzy import best_match

    spark = questions.sparkSession
    cp = checkpoint or os.path.join(checkpoint_dir(spark), f"stream-{name}")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        # ids unique across batches: (batch, row id within the batch)
        qs = batch.withColumn("q_id", F.struct(F.lit(batch_id).alias("batch"),
                                               F.monotonically_increasing_id().alias("row")))
        res = best_match(qs, corpus, threshold, stop_words).withColumn("batch_id", F.lit(batch_id))
        (res.drop("q_id", "key").withColumnRenamed("corpus_question", "nq_question")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    w = questions.writeStream.foreachBatch(run_batch).option("checkpointLocation", cp)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
