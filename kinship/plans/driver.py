"""Registered queries over the driver tables, and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables. Arrays are emitted as sorted, blank-joined strings and ratios as
unrounded doubles, so the Spark and DuckDB results hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.operators import link
from kinship.plans import sql_text as S
from kinship.sources import driver_tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# Exact linkage (lower + strip key, last record per key wins)

def _whole_corpus(spark, sf_dir, norm="basic"):
    return link.prepare_corpus(T.corpus(spark, sf_dir, whole=True), normalizer=norm, url_col="document_url")


def _exact_inputs(spark, sf_dir, norm="basic", require_url=False):
    qs = link.prepare_questions(T.questions(spark, sf_dir), normalizer=norm)
    cs = link.prepare_corpus(T.corpus(spark, sf_dir), normalizer=norm,
                             url_col="document_url", require_url=require_url)
    return qs, cs


@register("exact_match", f"""
WITH {S.prepared('basic')},
idx AS (SELECT key, max(ord) AS win_ord FROM pc GROUP BY key)
SELECT pq2.q_id, pq2.question, c.example_id, c.document_url, c.document_text
FROM pq2 JOIN idx USING (key) JOIN corpus c ON c.ord = idx.win_ord
""")
def q_exact_match(spark, sf_dir):
    qs, cs = _exact_inputs(spark, sf_dir)
    out = link.exact_merge(qs, cs, "ord", ["example_id", "document_url", "document_text"])
    return out.select("q_id", "question", "example_id", "document_url", "document_text")


@register("unmatched", f"""
WITH {S.prepared('basic')}
SELECT q_id, question, array_to_string(answer, ' ') AS answer
FROM pq2 WHERE key NOT IN (SELECT key FROM pc)
""")
def q_unmatched(spark, sf_dir):
    qs, cs = _exact_inputs(spark, sf_dir)
    idx = link.key_index(cs, "ord")
    out = link.unmatched(qs, idx)
    return out.select("q_id", "question", F.array_join("answer", " ").alias("answer"))


# ---------------------------------------------------------------------------
# Fuzzy linkage: exact key first, else best Jaccard >= 0.9 (14 stop words)

def _sims_sql(qrows: str, qid: str, qtext: str, crows: str, cid: str, ctext: str,
              stop: str) -> str:
    """CTEs computing exact Jaccard for every (question, corpus) pair that
    shares a keyword, by unnest + join + count (brute force)."""
    return f"""qkw AS (SELECT {qid} AS lid, unnest({S.keywords(qtext, stop)}) AS w FROM {qrows}),
qsz AS (SELECT lid, count(*) AS sz FROM qkw GROUP BY lid),
ckw AS (SELECT {cid} AS rid, unnest({S.keywords(ctext, stop)}) AS w FROM {crows}),
csz AS (SELECT rid, count(*) AS sz FROM ckw GROUP BY rid),
inter AS (SELECT lid, rid, count(*) AS n FROM qkw JOIN ckw USING (w) GROUP BY lid, rid),
sims AS (SELECT lid, rid, n::DOUBLE / (qsz.sz + csz.sz - n)::DOUBLE AS sim
         FROM inter JOIN qsz USING (lid) JOIN csz USING (rid))"""


@register("best_match", f"""
WITH {S.prepared('text', require_url=True)},
idx AS (SELECT key, min(ord) AS first_ord, max(ord) AS win_ord FROM pc GROUP BY key),
ex AS (SELECT pq2.*, idx.win_ord FROM pq2 LEFT JOIN idx USING (key)),
resid AS (SELECT * FROM ex WHERE win_ord IS NULL),
{_sims_sql('resid', 'q_id', 'key', 'idx', 'first_ord', 'key', '14')},
ranked AS (SELECT lid, rid, sim, row_number() OVER (PARTITION BY lid ORDER BY sim DESC, rid) AS rn
           FROM sims WHERE sim >= 0.9),
fz AS (SELECT ranked.lid AS q_id, idx.win_ord, ranked.sim FROM ranked JOIN idx ON idx.first_ord = ranked.rid
       WHERE rn = 1),
res AS (SELECT q_id, question, win_ord, 1.0::DOUBLE AS sim FROM ex WHERE win_ord IS NOT NULL
        UNION ALL
        SELECT resid.q_id, resid.question, fz.win_ord, fz.sim FROM resid LEFT JOIN fz USING (q_id))
SELECT res.q_id, res.question, pc.document_url, res.sim AS nq_similarity, pc.corpus_question AS nq_question
FROM res LEFT JOIN pc ON pc.ord = res.win_ord
""")
def q_best_match(spark, sf_dir):
    from kinship.operators.fuzzy import best_match

    qs, cs = _exact_inputs(spark, sf_dir, norm="text", require_url=True)
    out = best_match(qs, cs, 0.9, "14")
    return out.select("q_id", "question", "document_url", "nq_similarity",
                      F.col("corpus_question").alias("nq_question"))


# ---------------------------------------------------------------------------
# Candidate search: top 3 per question at Jaccard >= 0.3 (35 stop words)

TOP3_SQL = f"""
WITH {S.prepared('basic')},
texts AS (SELECT corpus_question AS t, min(ord) AS first_ord, arg_min(document_url, ord) AS document_url
          FROM pc GROUP BY corpus_question),
{_sims_sql('pq2', 'q_id', 'question', 'texts', 'first_ord', 't', '35')},
r AS (SELECT lid, rid, sim, row_number() OVER (PARTITION BY lid ORDER BY sim DESC, rid) AS rank
      FROM sims WHERE sim >= 0.3),
top3 AS (SELECT r.lid AS q_id, r.rank, texts.t AS nq_question, texts.document_url, r.sim AS similarity
         FROM r JOIN texts ON texts.first_ord = r.rid WHERE r.rank <= 3)"""


def _top3(spark, sf_dir):
    from kinship.operators.fuzzy import top_k_candidates

    qs, cs = _exact_inputs(spark, sf_dir)
    return qs, top_k_candidates(qs, cs, 0.3, 3, "35")


@register("top3_matches", TOP3_SQL + "\nSELECT * FROM top3")
def q_top3(spark, sf_dir):
    return _top3(spark, sf_dir)[1]


@register("match_counts", TOP3_SQL + """
SELECT count(*) FILTER (WHERE q_id IN (SELECT q_id FROM top3)) AS questions_with_matches,
       count(*) FILTER (WHERE q_id NOT IN (SELECT q_id FROM top3)) AS questions_without_matches
FROM pq2""")
def q_match_counts(spark, sf_dir):
    from kinship.operators.fuzzy import match_counts

    qs, top = _top3(spark, sf_dir)
    return match_counts(qs, top)


# ---------------------------------------------------------------------------
# Scalar normalisers and keyword sets

def _docs(spark, sf_dir):
    return T.documents(spark, sf_dir)


def _norm_query(kind):
    from kinship.functions.text import normalizer

    def fn(spark, sf_dir):
        return _docs(spark, sf_dir).select("doc_id", normalizer(kind)(F.col("text")).alias("key"))
    return fn


for _kind, _name in (("basic", "norm_basic"), ("question", "norm_question"), ("text", "norm_text")):
    register(_name, f"SELECT doc_id, {S.NORM[_kind]('text')} AS key FROM documents")(_norm_query(_kind))


def _kw_query(stop):
    from kinship.functions.text import keywords, sorted_joined

    def fn(spark, sf_dir):
        c = T.table(spark, sf_dir, "conversations", columns=["conv_id", "turn", "text"])
        kw = keywords(F.col("text"), stop)
        return c.select("conv_id", "turn", sorted_joined(kw).alias("keywords"),
                        F.size(kw).cast("bigint").alias("n_keywords"))
    return fn


for _stop in ("14", "35"):
    register(f"keywords_{_stop}", f"""
SELECT conv_id, turn, {S.sorted_joined(S.keywords('text', _stop))} AS keywords,
       len({S.keywords('text', _stop)}) AS n_keywords
FROM conversations""")(_kw_query(_stop))


@register("nonempty_filter", f"""
SELECT doc_id, {S.strip_ws("coalesce(text, '')")} AS question FROM documents
WHERE {S.strip_ws("coalesce(text, '')")} <> '' AND coalesce(source, '') <> ''
""")
def q_nonempty(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumnRenamed("text", "question_text").withColumnRenamed("source", "document_url")
    out = link.prepare_corpus(d, normalizer="basic", url_col="document_url", require_url=True)
    return out.select("doc_id", F.col("corpus_question").alias("question"))


@register("jaccard_pairs", f"""
WITH k AS (SELECT doc_id, {S.keywords('text', '14')} AS kw FROM documents),
p AS (SELECT a.doc_id AS pair_id, a.kw AS kw1, b.kw AS kw2, list_intersect(a.kw, b.kw) AS c
      FROM k a JOIN k b ON b.doc_id = a.doc_id + 1)
SELECT pair_id, len(kw1) AS n_kw1, len(kw2) AS n_kw2, len(c) AS n_common,
       len(kw1) + len(kw2) - len(c) AS n_union, {S.sorted_joined('c')} AS common,
       CASE WHEN len(kw1) = 0 OR len(kw2) = 0 THEN 0.0::DOUBLE
            ELSE len(c)::DOUBLE / (len(kw1) + len(kw2) - len(c))::DOUBLE END AS similarity
FROM p""")
def q_jaccard_pairs(spark, sf_dir):
    from kinship.functions.sets import explain_pair
    from kinship.functions.text import keywords

    k = _docs(spark, sf_dir).select("doc_id", keywords(F.col("text"), "14").alias("kw"))
    a = k.select(F.col("doc_id").alias("pair_id"), F.col("kw").alias("kw1"))
    b = k.select((F.col("doc_id") - 1).alias("pair_id"), F.col("kw").alias("kw2"))
    return a.join(b, "pair_id").select("pair_id", *explain_pair("kw1", "kw2"))


# ---------------------------------------------------------------------------
# Keyed index (first / last record per key)

def _index_query(keep):
    def fn(spark, sf_dir):
        idx = link.corpus_index(_whole_corpus(spark, sf_dir), "ord", ["example_id", "document_url"], keep=keep)
        return idx.select("key", "example_id", "document_url", "first_ord", "n_records")
    return fn


for _keep, _dir in (("last", "DESC"), ("first", "ASC")):
    register(f"index_{_keep}", f"""
WITH {S.prepared('basic', whole=True)},
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord {_dir}) AS rn,
             min(ord) OVER (PARTITION BY key) AS first_ord, count(*) OVER (PARTITION BY key) AS n_records
      FROM pc)
SELECT key, example_id, document_url, first_ord, n_records FROM r WHERE rn = 1""")(_index_query(_keep))


# ---------------------------------------------------------------------------
# Unmatched with reason; left enrichment by the question key

@register("unmatched_reason", f"""
WITH {S.prepared('basic')}
SELECT q_id, question, array_to_string(answer, ' ') AS answer, 'No match found' AS error
FROM pq2 WHERE key NOT IN (SELECT key FROM pc)
""")
def q_unmatched_reason(spark, sf_dir):
    qs, cs = _exact_inputs(spark, sf_dir)
    idx = link.key_index(cs, "ord")
    out = link.with_reason(link.unmatched(qs, idx))
    return out.select("q_id", "question", F.array_join("answer", " ").alias("answer"), "error")


@register("enrich_left", f"""
WITH {S.prepared('question')},
idx AS (SELECT key, max(ord) AS win_ord FROM pc GROUP BY key)
SELECT pq2.q_id, pq2.question, c.document_url, c.document_title, c.corpus_question AS nq_original_question
FROM pq2 LEFT JOIN idx USING (key) LEFT JOIN pc c ON c.ord = idx.win_ord
""")
def q_enrich_left(spark, sf_dir):
    qs, cs = _exact_inputs(spark, sf_dir, norm="question")
    out = link.exact_merge(qs, cs, "ord", ["document_url", "document_title", "corpus_question"], how="left")
    return out.select("q_id", "question", "document_url", "document_title",
                      F.col("corpus_question").alias("nq_original_question"))


@register("unmatched_text_sorted", f"""
WITH {S.prepared('question')}
SELECT DISTINCT question FROM pq2 WHERE key NOT IN (SELECT key FROM pc)
""")
def q_unmatched_text_sorted(spark, sf_dir):
    qs, cs = _exact_inputs(spark, sf_dir, norm="question")
    idx = link.key_index(cs, "ord")
    return link.unmatched(qs, idx).select("question").distinct().orderBy("question")


# ---------------------------------------------------------------------------
# Keyword index statistics (candidate-search corpus, 35 stop words)

KW_INDEX_SQL = f"""
WITH {S.prepared('basic', whole=True)},
e AS (SELECT ord, unnest({S.keywords('corpus_question', '35')}) AS w FROM pc)"""


@register("keyword_index_stats", KW_INDEX_SQL + """
SELECT (SELECT count(*) FROM pc) AS n_questions, count(DISTINCT w) AS n_keywords, count(*) AS n_postings FROM e""")
def q_keyword_index_stats(spark, sf_dir):
    from kinship.operators.report import keyword_index_stats

    return keyword_index_stats(_whole_corpus(spark, sf_dir), "corpus_question", "35")


@register("keyword_postings", KW_INDEX_SQL + """
SELECT w AS keyword, count(*) AS n_questions FROM e GROUP BY w""")
def q_keyword_postings(spark, sf_dir):
    from kinship.operators.report import keyword_postings

    return keyword_postings(_whole_corpus(spark, sf_dir), "corpus_question", "35")


# ---------------------------------------------------------------------------
# Match report per dataset (lang) and totals

REPORT_SQL = f"""
WITH {S.prepared('basic')},
m AS (SELECT dataset, key IN (SELECT key FROM pc) AS hit FROM pq2),
agg AS (SELECT dataset, count(*) AS processed, count(*) FILTER (WHERE hit) AS matched,
               count(*) FILTER (WHERE NOT hit) AS unmatched FROM m GROUP BY ALL)"""

RATE_SQL = "CASE WHEN processed = 0 THEN NULL ELSE matched::DOUBLE / processed::DOUBLE * 100.0 END AS match_rate"


@register("match_report", REPORT_SQL + f"\nSELECT dataset, processed, matched, unmatched, {RATE_SQL} FROM agg")
def q_match_report(spark, sf_dir):
    from kinship.operators.report import match_report

    qs, cs = _exact_inputs(spark, sf_dir)
    idx = link.key_index(cs, "ord")
    return match_report(qs, idx, by="dataset")


@register("match_report_total", f"""
WITH {S.prepared('basic')},
m AS (SELECT key IN (SELECT key FROM pc) AS hit FROM pq2),
agg AS (SELECT count(*) AS processed, count(*) FILTER (WHERE hit) AS matched,
               count(*) FILTER (WHERE NOT hit) AS unmatched FROM m)
SELECT (SELECT count(*) FROM corpus) AS corpus_records, (SELECT count(*) FROM pc) AS corpus_nonempty,
       (SELECT count(DISTINCT key) FROM pc) AS corpus_keys, processed, matched, unmatched, {RATE_SQL}
FROM agg""")
def q_match_report_total(spark, sf_dir):
    from kinship.operators.report import corpus_counters, match_report, side_by_side

    qs, cs = _exact_inputs(spark, sf_dir)
    idx = link.key_index(cs, "ord")
    return side_by_side(corpus_counters(T.corpus(spark, sf_dir)), match_report(qs, idx, by=None))


# ---------------------------------------------------------------------------
# Dataset selection, ordered samples

@register("dataset_select", """
SELECT doc_id AS q_id, lang AS dataset FROM documents WHERE lang IN ('en', 'de')""")
def q_dataset_select(spark, sf_dir):
    from kinship.sources.jsonl import select_datasets

    return select_datasets(T.questions(spark, sf_dir, whole=True), ["en", "de"]).select("q_id", "dataset")


@register("examples_first5", f"""
WITH {S.prepared('basic')},
idx AS (SELECT key, max(ord) AS win_ord FROM pc GROUP BY key)
SELECT pq2.q_id, pq2.question, c.question_text AS nq_question, c.document_url
FROM pq2 JOIN idx USING (key) JOIN corpus c ON c.ord = idx.win_ord
ORDER BY pq2.ord LIMIT 5""")
def q_examples_first5(spark, sf_dir):
    from kinship.operators.report import first_n

    qs, cs = _exact_inputs(spark, sf_dir)
    m = link.exact_merge(qs, cs, "ord", ["question_text", "document_url"])
    return first_n(m, "ord", 5).select("q_id", "question", F.col("question_text").alias("nq_question"),
                                      "document_url")


@register("normalization_samples", f"""
WITH {S.prepared('question', whole=True)}
SELECT example_id, corpus_question AS original_question, key FROM pc ORDER BY ord LIMIT 5""")
def q_normalization_samples(spark, sf_dir):
    from kinship.operators.report import first_n

    return first_n(_whole_corpus(spark, sf_dir, "question"), "ord", 5).select("example_id", F.col("corpus_question").alias("original_question"), "key")


# ---------------------------------------------------------------------------
# Corpus preparation over pages

@register("simplify_pages", f"""
SELECT page_id AS example_id, url AS document_url, {S.simplified_text('html')} AS document_text,
       len({S.tokens('html')}) AS n_tokens,
       CASE WHEN len(string_split({S.simplified_text('html')}, ' ')) <> len({S.tokens('html')})
            THEN 'Token count does not fit the text.' END AS error
FROM pages""")
def q_simplify_pages(spark, sf_dir):
    from kinship.operators.prepare import simplify

    s = simplify(T.raw_pages(spark, sf_dir))
    return s.select("example_id", "document_url", "document_text", F.col("n_tokens").cast("bigint").alias("n_tokens"), "error")


@register("span_text", f"""
WITH {S.element_spans()},
doc AS (SELECT page_id, string_split({S.simplified_text('html')}, ' ') AS toks FROM pages)
SELECT s.page_id AS example_id, (row_number() OVER (PARTITION BY s.page_id ORDER BY s.elem, s.k) - 1)::BIGINT AS span_no, s.start_token::BIGINT AS start_token,
       (s.start_token + s.n_tok)::BIGINT AS end_token,
       array_to_string(list_slice(doc.toks, s.start_token + 1, s.start_token + s.n_tok), ' ') AS text
FROM spans s JOIN doc USING (page_id)
UNION ALL
SELECT page_id, -1, -1, -1, NULL FROM pages""")
def q_span_text(spark, sf_dir):
    from kinship.operators.prepare import simplify, span_text

    s = simplify(T.raw_pages(spark, sf_dir))
    a1 = s.select("example_id", "document_text", F.posexplode(F.col("annotations")[0]["short_answers"])
                  .alias("span_no", "sp"))
    a1 = a1.select("example_id", F.col("span_no").cast("bigint").alias("span_no"),
                   F.col("sp.start_token").cast("bigint").alias("start_token"),
                   F.col("sp.end_token").cast("bigint").alias("end_token"),
                   span_text("document_text", F.col("sp.start_token"), F.col("sp.end_token")).alias("text"))
    la = F.col("annotations")[1]["long_answer"]
    a2 = s.select("example_id", F.lit(-1).cast("bigint").alias("span_no"),
                  la["start_token"].cast("bigint").alias("start_token"),
                  la["end_token"].cast("bigint").alias("end_token"),
                  span_text("document_text", la["start_token"], la["end_token"]).alias("text"))
    return a1.unionByName(a2)


SHORT_SQL = f"""
WITH {S.element_spans()},
txt AS (SELECT page_id, url, {S.decode_native(S.strip_tags('el'))} AS t
        FROM spans WHERE n_tok <= 5)
SELECT page_id AS example_id, url AS question, array_to_string(list_sort(list_distinct(list(t))), ' | ') AS answer
FROM txt GROUP BY page_id, url"""


@register("short_answers", SHORT_SQL)
def q_short_answers(spark, sf_dir):
    from kinship.operators.prepare import short_answers

    qa = short_answers(T.raw_pages(spark, sf_dir), max_tokens=5)
    return qa.select("example_id", "question", F.array_join("answer", " | ").alias("answer"))


@register("shuffle_seeded", SHORT_SQL)
def q_shuffle_seeded(spark, sf_dir):
    from kinship.operators.prepare import shuffle_rows

    return shuffle_rows(q_short_answers(spark, sf_dir), seed=42)
