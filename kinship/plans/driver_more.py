"""More registered queries: whole output records, written and re-read tables, samples and counts.

JSON lines are written from ``documents`` into the shared checkpoint folder
and read back by the package's readers, some of them broken on purpose.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators import link
from kinship.plans import sql_text as S
from kinship.plans.driver import _exact_inputs, _whole_corpus, register
from kinship.session import checkpoint_dir
from kinship.sources import driver_tables as T

#: Annotated fields for the corpus stand-in; missing in every third row.
_ANNOTATED = """
  CASE WHEN doc_id % 3 <> 0 THEN doc_id::VARCHAR || ':' || (doc_id + 2)::VARCHAR || ':' || lang ELSE '' END AS annotations,
  CASE WHEN doc_id % 3 <> 0 THEN '0:' || n_chars::VARCHAR ELSE '' END AS long_answer_candidates"""


def _annotated_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.table(spark, sf_dir, "documents", columns=[*T.DOC_COLUMNS, "n_chars"]).where("doc_id % 2 = 1")
    some = F.col("doc_id") % 3 != 0
    span = F.struct(F.col("doc_id").alias("start_token"), (F.col("doc_id") + 2).alias("end_token"))
    ann = F.array(F.struct(span.alias("long_answer"), F.col("lang").alias("yes_no_answer")))
    cand = F.array(F.struct(F.lit(0).cast("long").alias("start_token"), F.col("n_chars").alias("end_token")))
    return d.select(
        F.col("doc_id").alias("example_id"), F.col("doc_id").alias("ord"), F.col("text").alias("question_text"),
        F.when(some, F.col("source")).alias("document_url"), F.col("lang").alias("document_title"),
        F.when(some, F.col("text")).alias("document_text"), F.when(some, ann).alias("annotations"),
        F.when(some, cand).alias("long_answer_candidates"), F.lit("f").alias("_file"))


def _flat(df: DataFrame) -> DataFrame:
    """The annotated arrays as text."""
    ann = F.transform("annotations", lambda a: F.concat_ws(
        ":", a["long_answer"]["start_token"], a["long_answer"]["end_token"], a["yes_no_answer"]))
    cand = F.transform("long_answer_candidates", lambda c: F.concat_ws(":", c["start_token"], c["end_token"]))
    return df.withColumn("annotations", F.array_join(ann, ",")).withColumn("long_answer_candidates", F.array_join(cand, ","))


def _merged_sql(keep: str) -> str:
    return f"""
WITH {S.prepared('basic')},
idx AS (SELECT key, {keep}(ord) AS win_ord FROM pc GROUP BY key),
c AS (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN text ELSE '' END AS document_text,
             CASE WHEN doc_id % 3 <> 0 THEN source ELSE '' END AS document_url,{_ANNOTATED} FROM documents)
SELECT pq2.q_id, pq2.question, array_to_string(pq2.answer, ' ') AS answer, c.document_text, c.document_url,
       c.annotations, c.long_answer_candidates, c.doc_id AS example_id
FROM pq2 JOIN idx USING (key) JOIN c ON c.doc_id = idx.win_ord"""


def _merged(keep: str):
    def fn(spark, sf_dir):
        from kinship.plans.exact_merge import merged_record

        qs, _ = _exact_inputs(spark, sf_dir)
        cs = link.prepare_corpus(_annotated_corpus(spark, sf_dir))
        m = link.exact_merge(qs.drop("ord").withColumn("ord", F.col("q_id")), cs, "ord",
                             ["document_text", "document_url", "annotations", "long_answer_candidates", "example_id"], keep=keep)
        return _flat(merged_record(m)).select(
            F.col("ord").alias("q_id"), "question", F.array_join("answer", " ").alias("answer"), "document_text",
            "document_url", "annotations", "long_answer_candidates", "example_id")
    return fn


register("merged_record", _merged_sql("max"))(_merged("last"))
register("merged_record_first", _merged_sql("min"))(_merged("first"))


@register("stored_payload", f"""
WITH {S.prepared('question')},
idx AS (SELECT key, max(ord) AS win_ord FROM pc GROUP BY key),
c AS (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN source ELSE '' END AS document_url, lang AS document_title,{_ANNOTATED}
      FROM documents)
SELECT pq2.q_id, c.document_url, c.document_title, c.annotations, c.long_answer_candidates, pc.corpus_question AS nq_original_question
FROM pq2 LEFT JOIN idx USING (key) LEFT JOIN c ON c.doc_id = idx.win_ord LEFT JOIN pc ON pc.ord = idx.win_ord""")
def q_stored_payload(spark, sf_dir):
    from kinship.plans.keyed_enrich import STORED, store

    qs, _ = _exact_inputs(spark, sf_dir, norm="question")
    cs = store(link.prepare_corpus(_annotated_corpus(spark, sf_dir), normalizer="question"))
    out = link.exact_merge(qs.select("q_id", "key"), cs, "ord", [*STORED, "nq_original_question"], how="left")
    return _flat(out).select("q_id", *STORED, "nq_original_question")


@register("simplified_spans", f"""
WITH {S.element_spans()},
page AS (SELECT page_id, url, len({S.tokens('html')}) AS n FROM pages),
short AS (SELECT page_id, string_agg(start_token::VARCHAR || '-' || (start_token + n_tok)::VARCHAR, ' ' ORDER BY elem, k) AS s
          FROM spans GROUP BY page_id)
SELECT page_id AS example_id, url AS question_text, '0-' || n::VARCHAR AS candidate, '0-' || n::VARCHAR || ' -1--1' AS long_answers,
       coalesce(s, '') AS short_answers, 'start_token end_token' AS span_fields
FROM page LEFT JOIN short USING (page_id)""")
def q_simplified_spans(spark, sf_dir):
    from kinship.operators.prepare import simplify

    def text(s):
        return F.concat_ws("-", s["start_token"], s["end_token"])

    s = simplify(T.raw_pages(spark, sf_dir))
    fields = s.schema["annotations"].dataType.elementType["long_answer"].dataType.names
    return s.select(
        "example_id", "question_text", text(F.col("long_answer_candidates")[0]).alias("candidate"),
        F.array_join(F.transform("annotations", lambda a: text(a["long_answer"])), " ").alias("long_answers"),
        F.array_join(F.transform(F.col("annotations")[0]["short_answers"], text), " ").alias("short_answers"),
        F.lit(" ".join(fields)).alias("span_fields"))


@register("linked_counts", f"""
WITH {S.prepared('question')},
m AS (SELECT dataset, question, key IN (SELECT key FROM pc) AS hit FROM pq2)
SELECT dataset, count(DISTINCT question) FILTER (WHERE hit) AS questions_with_refs,
       count(DISTINCT question) FILTER (WHERE NOT hit) AS questions_without_refs FROM m GROUP BY dataset""")
def q_linked_counts(spark, sf_dir):
    from kinship.plans.keyed_enrich import distinct_counts

    qs, cs = _exact_inputs(spark, sf_dir, norm="question")
    out = link.exact_merge(qs, cs, "ord", ["document_url"], how="left")
    return distinct_counts(out, F.col("win_ord").isNotNull())


@register("records_per_file", f"""
WITH {S.prepared('question', whole=True)}
SELECT coalesce(document_url, 'TOTAL') AS file, count(*) AS questions FROM pc GROUP BY ROLLUP (document_url)""")
def q_records_per_file(spark, sf_dir):
    from kinship.plans.keyed_enrich import records_per_file

    cs = _whole_corpus(spark, sf_dir, "question").withColumn("_file", F.col("document_url"))
    return records_per_file(cs).withColumnRenamed("_file", "file")


@register("unmatched_samples", f"""
WITH {S.prepared('question')},
u AS (SELECT DISTINCT question FROM pq2 WHERE key NOT IN (SELECT key FROM pc) ORDER BY question LIMIT 5)
SELECT question, {S.norm_question('question')} AS key FROM u""")
def q_unmatched_samples(spark, sf_dir):
    from kinship.plans.keyed_enrich import unmatched_samples

    qs, cs = _exact_inputs(spark, sf_dir, norm="question")
    idx = link.key_index(cs, "ord")
    return unmatched_samples(link.unmatched(qs, idx).select("question"))


@register("stored_samples", f"""
WITH {S.prepared('question')},
idx AS (SELECT key, arg_max(corpus_question, ord) AS nq_original_question FROM pc GROUP BY key),
m AS (SELECT DISTINCT question FROM pq2 WHERE key IN (SELECT key FROM pc) ORDER BY question LIMIT 5)
SELECT key, nq_original_question FROM idx WHERE key IN (SELECT {S.norm_question('question')} FROM m)""")
def q_stored_samples(spark, sf_dir):
    from kinship.plans.keyed_enrich import stored_samples

    qs, cs = _exact_inputs(spark, sf_dir, norm="question")
    cs = cs.withColumn("nq_original_question", F.col("corpus_question"))
    matched = link.exact_merge(qs, cs, "ord", ["nq_original_question"]).select("question")
    return stored_samples(matched, cs)


@register("first_answers", """
SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE lang END AS answer FROM documents""")
def q_first_answers(spark, sf_dir):
    from kinship.plans.fuzzy_link import first_answer

    n = F.col("doc_id") % 7
    answer = F.when(n == 1, F.array().cast("array<string>")).when(n > 1, F.array("lang", "source"))
    return T.documents(spark, sf_dir).select("doc_id", first_answer(answer).alias("answer"))


@register("first_questions", """
SELECT doc_id AS q_id, text AS question FROM documents ORDER BY doc_id LIMIT 50""")
def q_first_questions(spark, sf_dir):
    from kinship.sources.jsonl import first_records

    return first_records(T.questions(spark, sf_dir, whole=True), 50).select("q_id", "question")


# ---------------------------------------------------------------------------
# Written and read again

def _folder(spark: SparkSession, what: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{what}-{uuid.uuid4().hex}")


def _json_lines(spark: SparkSession, sf_dir: str) -> str:
    """``documents`` as question lines: even ids gzipped under train, odd ones
    plain under dev; some cut off, in a list, or with a second value."""
    root = _folder(spark, "lines")
    d = T.documents(spark, sf_dir)
    answer = F.when(F.col("doc_id") % 5 == 0, F.array()).otherwise(F.array("lang", "source"))
    line = F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("question"), answer.alias("answer")))
    n = F.col("doc_id") % 11
    odd = (F.when(n == 3, F.substring(line, 1, 12)).when(n == 5, F.concat(F.lit("["), line, F.lit("]")))
           .when(n == 7, F.concat(line, F.lit('{"question": "x"}'))).when(n == 9, F.concat(F.lit("\t "), line)).otherwise(line))
    lines = d.select("doc_id", odd.alias("value"))
    lines.where("doc_id % 2 = 0").select("value").write.option("compression", "gzip").text(os.path.join(root, "train"))
    lines.where("doc_id % 2 = 1").select("value").write.text(os.path.join(root, "dev"))
    return root


def _read_lines(spark, sf_dir):
    from kinship.plans.common import read_questions

    root = _json_lines(spark, sf_dir)
    return read_questions(spark, {n: os.path.join(root, n) for n in ("train", "dev")})


@register("jsonl_questions", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'train' ELSE 'dev' END AS dataset, text AS question,
       CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang || ' ' || source END AS answer
FROM documents WHERE doc_id % 11 NOT IN (3, 5, 7)""")
def q_jsonl_questions(spark, sf_dir):
    good, _ = _read_lines(spark, sf_dir)
    return good.select(F.get_json_object("_line", "$.id").cast("long").alias("doc_id"), "dataset", "question",
                       F.array_join("answer", " ").alias("answer"))


@register("jsonl_quarantine", """
SELECT CASE WHEN doc_id % 2 = 0 THEN 'train' ELSE 'dev' END AS dataset,
       CASE doc_id % 11 WHEN 3 THEN 'Malformed JSON' WHEN 5 THEN 'Not a JSON object'
                        ELSE 'More than one JSON value on a line' END AS reason, count(*) AS n
FROM documents WHERE doc_id % 11 IN (3, 5, 7) GROUP BY ALL""")
def q_jsonl_quarantine(spark, sf_dir):
    _, bad = _read_lines(spark, sf_dir)
    return bad.groupBy("dataset", F.col("_error").alias("reason")).agg(F.count("*").alias("n"))


@register("merged_lines", """
SELECT doc_id AS id, text AS question, lang, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'other' END AS source,
       CASE WHEN doc_id % 2 = 0 THEN doc_id::DOUBLE / 2 END AS similarity FROM documents""")
def q_merged_lines(spark, sf_dir):
    from kinship.sources.sinks import write_merged

    path = _folder(spark, "merged")
    d = T.documents(spark, sf_dir).withColumn("hit", F.col("doc_id") % 2 == 0)
    line = F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("question"), "lang", F.lit("other").alias("source")))
    rows = d.select(line.alias("_line"), "source", (F.col("doc_id").cast("double") / 2).alias("similarity"), "hit", F.lit("d").alias("dataset"))
    write_merged(rows, path, F.col("hit"), ["source", "similarity"])
    return spark.read.schema("id long, question string, lang string, source string, similarity double").json(path + "/dataset=d")


@register("keyed_store", f"""
WITH {S.prepared('basic', whole=True)},
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord DESC) AS rn FROM pc)
SELECT key, example_id, document_url FROM r WHERE rn = 1""")
def q_keyed_store(spark, sf_dir):
    from kinship.sources.sinks import write_keyed

    path = _folder(spark, "store")
    write_keyed(link.corpus_index(_whole_corpus(spark, sf_dir), "ord", ["example_id", "document_url"]), path, "key")
    return spark.read.parquet(path).select("key", "example_id", "document_url")


@register("sorted_texts", f"""
WITH {S.prepared('question')}
SELECT DISTINCT question FROM pq2 WHERE key NOT IN (SELECT key FROM pc)""")
def q_sorted_texts(spark, sf_dir):
    from kinship.sources.sinks import read_sorted_lines, write_sorted_lines

    path = _folder(spark, "texts")
    qs, cs = _exact_inputs(spark, sf_dir, norm="question")
    idx = link.key_index(cs, "ord")
    write_sorted_lines(link.unmatched(qs, idx), "question", path)
    return read_sorted_lines(spark, path, "question")
