"""Skewed inputs: one key holds a third of the rows; near-copy clusters.
Results must stay exact (no rows dropped, capped or sampled)."""

import random
from collections import Counter

import pytest

from kinship.operators.fuzzy import top_k_candidates
from kinship.operators.link import exact_merge, prepare_corpus, prepare_questions, unmatched, corpus_index
from kinship.operators.simjoin import ranked_tokens, similarity_join, token_counts
from kinship.operators.strategy import hot_join
from tests.test_simjoin import brute


def test_hot_key_exact_linkage(spark):
    n = 3000
    rows = [(i, "Hot question?" if i % 3 == 0 else f"question {i}", f"u{i}") for i in range(n)]
    corpus = prepare_corpus(spark.createDataFrame(rows, "ord long, question_text string, document_url string"))
    qrows = [(i, "hot question?" if i % 3 else f"question {i * 7}") for i in range(n)]
    qs = prepare_questions(spark.createDataFrame(qrows, "q_id long, question string"))
    m = exact_merge(qs, corpus, "ord", ["document_url"])
    got = {r.q_id: r.document_url for r in m.collect()}
    hot_last = f"u{max(i for i in range(n) if i % 3 == 0)}"
    expected_cold = {i: f"u{i * 7}" for i in range(0, n, 3) if i * 7 < n and (i * 7) % 3 != 0}
    assert sum(1 for v in got.values() if v == hot_last) == len([i for i in range(n) if i % 3])
    assert {k: v for k, v in got.items() if v != hot_last} == expected_cold
    u = unmatched(qs, corpus_index(corpus.select("key", "ord"), "ord"))
    assert u.count() + m.count() == n


def _near_copies(rng, base, n):
    out = []
    for _ in range(n):
        s = set(base)
        s.discard(rng.choice(base))
        s.add(f"w{rng.randint(0, 40)}")
        out.append(sorted(s))
    return out


def test_near_copy_cluster_join(spark):
    rng = random.Random(11)
    base = [f"b{i}" for i in range(12)]
    vocab = [f"w{i}" for i in range(60)]
    L = _near_copies(rng, base, 50) + [sorted(rng.sample(vocab, rng.randint(1, 10))) for _ in range(100)]
    R = _near_copies(rng, base, 60) + [sorted(rng.sample(vocab, rng.randint(1, 10))) for _ in range(90)]
    ldf = spark.createDataFrame(list(enumerate(L)), "lid int, kw array<string>")
    rdf = spark.createDataFrame(list(enumerate(R)), "rid int, kw array<string>")
    for t in (0.6, 0.8):
        got = {(r.lid, r.rid, r.n_common, r.sim) for r in similarity_join(ldf, rdf, t).collect()}
        assert got == brute(L, R, t)


def test_hot_question_top_k(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    corpus = [(o, " ".join(rng.sample(words, rng.randint(2, 5))) + f" x{o % 7}", f"u{o}") for o in range(300)]
    questions = [(i, "alpha beta gamma" if i % 3 == 0 else f"delta x{i % 7}") for i in range(90)]
    cs = prepare_corpus(spark.createDataFrame(corpus, "ord long, question_text string, document_url string"),
                        url_col="document_url")
    qs = prepare_questions(spark.createDataFrame(questions, "q_id long, question string"))
    got = {}
    for r in top_k_candidates(qs, cs, 0.3, 3, "none").collect():
        got.setdefault(r.q_id, []).append((r.rank, r.nq_question))

    def kw(s):
        return set(s.split())
    texts = {}
    for o, q, u in corpus:
        texts.setdefault(q, o)
    for qid, q in questions:
        c = []
        for t, o in texts.items():
            a, b = kw(q), kw(t)
            s = len(a & b) / len(a | b)
            if s >= 0.3:
                c.append((-s, o, t))
        exp = [(i + 1, x[2]) for i, x in enumerate(sorted(c)[:3])]
        assert sorted(got.get(qid, [])) == exp


@pytest.fixture()
def eager_skew(spark):
    """Thresholds at which a few thousand rows on one key count as skewed."""
    new = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
           "spark.sql.adaptive.coalescePartitions.enabled": "false",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_over_tasks(spark, eager_skew):
    """Two thirds of the questions on one key, an index too large to broadcast:
    every join shape deals that key's rows to several tasks."""
    n = 30_000
    qs = prepare_questions(spark.range(n).repartition(16).selectExpr(
        "id as q_id", "if(id % 3 = 0, concat('question ', id), 'hot question') as question"))
    cs = prepare_corpus(spark.range(n).repartition(16).selectExpr(
        "id as ord", "if(id = 7, 'Hot question', concat('question ', id)) as question_text", "concat('u', id) as document_url"))
    idx = corpus_index(cs.select("key", "ord"), "ord")
    for how in ("inner", "left", "left_anti"):
        rows, plan = final_plan(hot_join(qs, idx, "key", how))
        assert "skew=true" in plan, how
        assert len(rows) == {"inner": n, "left": n, "left_anti": 0}[how]
    rows, plan = final_plan(exact_merge(qs, cs, "ord", ["document_url"]))
    assert plan.count("skew=true") >= 2          # the index and the payload
    assert len(rows) == n and sum(r.document_url == "u7" for r in rows) == 2 * n // 3
    assert unmatched(qs, idx).count() == 0


def test_frequent_token_is_split_over_tasks(spark, eager_skew):
    """One word in every set: its occurrences meet their count in several tasks."""
    n = 20_000
    side = spark.range(n).repartition(16).selectExpr("id as lid", "array('common', concat('w', id), concat('v', id % 500)) as kw")
    freq = token_counts(side.selectExpr("explode(kw) as token"))
    rows, plan = final_plan(ranked_tokens(side.selectExpr("lid", "3 as sz", "kw"), "lid", freq))
    assert "skew=true" in plan
    times = Counter(r.code for r in rows)
    assert len(rows) == 3 * n and sorted(times.values())[-2:] == [n // 500, n]
    assert max(times, key=times.get) == max(times)          # the most frequent comes last in a set
