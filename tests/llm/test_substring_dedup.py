"""Level-wise doubling against brute force over all windows."""

import random
import re

import numpy as np
import pytest

from kinship.llm import substring_dedup as sd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length=13):
    split = [WORD.findall(t or "") for _, t in rows]
    ids = [sd.NO_ID if i is None else i for i, _ in rows]
    first = {}
    for i, w in zip(ids, split):
        for s in range(len(w) - length + 1):
            k = tuple(w[s:s + length])
            first[k] = min(i, first.get(k, i))
    out = []
    for (orig, _), i, w in zip(rows, ids, split):
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s:s + length])] < i:
                gone[s:s + length] = True
        out.append((str(orig), len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def made(rng, n):
    vocab = ["the", "of", "and", "é", "中\x85x", "a"] + [f"w{i}" for i in range(200)]
    words = lambda k: [rng.choice(vocab) for _ in range(k)]      # noqa: E731
    passages = [words(rng.randint(12, 60)) for _ in range(8)]
    rows = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "x " * 300), (900, "x " * 40), (1004, "p q r " * 30), (1005, "p q r " * 6)]
    for i in range(n):
        w = words(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            w += p[a:len(p) - rng.randint(0, 5)] + words(rng.randint(0, 6))
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(None, rows[20][1]), (None, rows[21][1]), (5, rows[30][1]), rows[31], rows[31], (500, rows[31][1])]
    rng.shuffle(rows)
    return rows


def result(df, **kw):
    return sorted((str(r.doc_id), r.n_words, sum(s.end - s.start for s in r.spans), r.kept)
                  for r in sd.dedup(df, **kw).collect())


@pytest.mark.parametrize("batch", ["10000", "7", "1"])
def test_dedup(spark, batch):
    rows = made(random.Random(int(batch)), 150)
    df = spark.createDataFrame([(i, t, "x", 3, 4) for i, t in rows], "doc_id long, text string, th string, doc int, h int")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert result(df.repartition(3)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_one_passage_in_many(spark):
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(3000)]
    core = [rng.choice(vocab) for _ in range(20)]
    rows = [(i, " ".join([rng.choice(vocab) for _ in range(10)] + core + [rng.choice(vocab) for _ in range(10)])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df) == brute(rows)


def test_words_and_hashes():
    texts = ["a b\x0bc\x0cd", "", "  ", "b  a\r\n", "é"]
    w = sd.Words(texts)
    assert np.diff(w.first).tolist() == [4, 0, 0, 2, 1]
    assert w.hash[0] == w.hash[5] and w.hash[1] == w.hash[4] and len(set(w.hash.tolist())) == 5


def test_empty_table(spark):
    assert sd.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_many_texts_under_one_id(spark):
    rng = random.Random(14)
    words = lambda k: [f"w{rng.randrange(10**6)}" for _ in range(k)]      # noqa: E731
    passages = [words(20) for _ in range(3000)]
    rows = [(rng.choice([None, 1, 2, 3]), " ".join(words(rng.randint(0, 9)) + p + words(rng.randint(0, 9)))) for p in passages]
    for _ in range(20000):
        p, a = rng.choice(passages), rng.randint(0, 4)
        rows.append((7, " ".join(words(rng.randint(0, 12)) + p[a:a + rng.randint(13, 16)] + words(rng.randint(0, 12)))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df) == brute(rows)
