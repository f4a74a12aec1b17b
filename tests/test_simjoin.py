"""Prefix-filter similarity join equals brute force; best match and top-k
take the best pair, ties to the earliest record."""

import random

import pytest

from kinship.functions.text import STOP_WORDS_14, STOP_WORDS_35
from kinship.operators.fuzzy import best_match, top_k_candidates
from kinship.operators.link import prepare_corpus, prepare_questions
from kinship.operators.simjoin import similarity_join
from kinship.operators.topk_join import TopKJoin, top_k_join

VOCAB = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "the", "of"]


def rand_sets(rng, n, lo=1, hi=9):
    return [sorted(set(rng.sample(VOCAB, rng.randint(lo, hi)))) for _ in range(n)]


def brute(L, R, t):
    out = set()
    for i, a in enumerate(L):
        for j, b in enumerate(R):
            a_, b_ = set(a), set(b)
            if a_ and b_:
                s = len(a_ & b_) / len(a_ | b_)
                if s >= t:
                    out.add((i, j, len(a_ & b_), s))
    return out


@pytest.mark.parametrize("t", [0.3, 0.5, 0.75, 0.9, 1.0])
def test_join_equals_brute_force(spark, t):
    rng = random.Random(int(t * 100))
    L, R = rand_sets(rng, 60), rand_sets(rng, 70)
    L.append([])
    ldf = spark.createDataFrame([(i, s) for i, s in enumerate(L)], "lid int, kw array<string>")
    rdf = spark.createDataFrame([(j, s) for j, s in enumerate(R)], "rid int, kw array<string>")
    got = {(r.lid, r.rid, r.n_common, r.sim) for r in similarity_join(ldf, rdf, t).collect()}
    assert got == brute(L, R, t)


WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "the", "of", "is"]


def _sentences(rng, n):
    """Texts and their words: some repeat in other writing, some are empty."""
    out = []
    for _ in range(n):
        ws = [rng.choice(WORDS) for _ in range(rng.randint(0, 7))]
        out.append((" ".join(ws).upper() + "?" if rng.random() < 0.3 else " ".join(ws), ws))
    return out


def _sim(a, b, stop):
    a, b = set(a) - set(stop), set(b) - set(stop)
    return len(a & b) / len(a | b) if a and b else 0.0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_best_match_semantics(spark, seed):
    rng = random.Random(seed)
    texts, asked = _sentences(rng, 80), _sentences(rng, 40)
    corpus = [(o, s, rng.choice(["u1", "u2", "", "u3"])) for o, (s, _) in enumerate(texts)]
    cdf = spark.createDataFrame(corpus, "ord long, question_text string, document_url string")
    qdf = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(asked)], "q_id long, question string")
    cs = prepare_corpus(cdf, normalizer="text", url_col="document_url", require_url=True)
    qs = prepare_questions(qdf, normalizer="text")
    got = {r.q_id: (r.nq_similarity, r.document_url, r.corpus_question)
           for r in best_match(qs, cs, 0.5, "14").collect()}

    # every usable corpus record: its words, the first and the last of those with the same words in the same order
    usable = {o: tuple(ws) for (o, s, u), (_, ws) in zip(corpus, texts) if s and u}
    first = {ws: min(o for o, x in usable.items() if x == ws) for ws in usable.values()}
    last = {ws: max(o for o, x in usable.items() if x == ws) for ws in usable.values()}
    for i, (_, ws) in enumerate(asked):
        scored = [(1.0 if x == tuple(ws) else _sim(ws, x, STOP_WORDS_14), x == tuple(ws), -first[x], x) for x in first]
        sim, _, _, key = max((c for c in scored if c[0] >= 0.5), key=lambda c: (c[1], c[0], c[2]), default=(None, None, None, None))
        assert got[i] == ((sim, corpus[last[key]][2], corpus[last[key]][1]) if key is not None else (None, None, None))


def test_top_k_matches_brute_force(spark):
    rng = random.Random(7)
    texts, asked = _sentences(rng, 90), _sentences(rng, 30)
    distinct = {}
    for o, (s, ws) in enumerate(texts):
        if s:
            distinct.setdefault(s, (o, ws))
    exp = set()
    for i, (_, ws) in enumerate(asked):
        near = sorted((-_sim(ws, x, STOP_WORDS_35), o, s) for s, (o, x) in distinct.items() if _sim(ws, x, STOP_WORDS_35) >= 0.3)
        exp |= {(i, rank, s, f"url{o}", -d) for rank, (d, o, s) in enumerate(near[:3], 1)}
    cdf = spark.createDataFrame([(o, s, f"url{o}") for o, (s, _) in enumerate(texts)],
                                "ord long, question_text string, document_url string")
    qdf = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(asked)], "q_id long, question string")
    got = {tuple(r) for r in top_k_candidates(prepare_questions(qdf), prepare_corpus(cdf, url_col="document_url"), 0.3, 3, "35").collect()}
    assert got == exp


def _sets(spark, L, R):
    return (spark.createDataFrame([(i, s) for i, s in enumerate(L)], "lid int, kw array<string>"),
            spark.createDataFrame([(j, s) for j, s in enumerate(R)], "rid int, kw array<string>"))


@pytest.mark.parametrize("k,t,rounds", [(1, 0.3, (0.8, 0.5)), (3, 0.3, (0.8, 0.5)), (3, 0.2, (0.9, 0.7, 0.4)),
                                        (2, 0.5, (0.3,)), (40, 0.3, (0.6,)), (3, 1.0, (0.8,))])
def test_rising_bound_equals_brute_force(spark, k, t, rounds):
    rng = random.Random(k)
    L, R = rand_sets(rng, 50) + [[], None], rand_sets(rng, 60) + rand_sets(rng, 20, 3, 4) + [[], None]
    exp = set()
    near = brute([s or [] for s in L], [s or [] for s in R], t)
    for i in range(len(L)):
        mine = sorted(((-s, j, n) for a, j, n, s in near if a == i))[:k]
        exp |= {(i, j, n, -s, rank) for rank, (s, j, n) in enumerate(mine, 1)}
    got = {(r.lid, r.rid, r.n_common, r.sim, r["rank"]) for r in top_k_join(*_sets(spark, L, R), k, t, rounds).collect()}
    assert got == exp


def test_bounds_are_reached_by_k_partners_and_shorten_the_join(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    L = []
    for _ in range(12):         # groups of sets that differ by a few words
        base = rng.sample(words, 40)
        L += [sorted({*rng.sample(base, 36), *rng.sample(words, 3)}) for _ in range(12)]
    left, right = _sets(spark, L, L)
    join = TopKJoin(left, right, 3, 0.3, (0.8, 0.5))
    bounds = {r.lid: r.bound for r in join.bounds().collect()}
    assert len(bounds) > 0.9 * len(L)
    for i, b in bounds.items():
        sims = sorted((len({*L[i]} & {*s}) / len({*L[i]} | {*s}) for s in L), reverse=True)
        assert 0.3 <= b <= sims[2]
    assert join.met().count() * 2 < TopKJoin(left, right, 3, 0.3, ()).met().count()


def test_top_k_join_of_empty_sides(spark):
    none, some = _sets(spark, [], [["a"]])
    assert top_k_join(none, some, 2, 0.3).collect() == []
    left, empty = _sets(spark, [["a"]], [])
    assert top_k_join(left, empty, 2, 0.3).collect() == []
