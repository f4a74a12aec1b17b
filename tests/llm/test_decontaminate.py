"""Phrase lookup against a scan of all texts."""

import random
import re

import pytest

from kinship.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = {c: c + 32 for c in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(UP))


def scan(docs, items, length):
    """What the contract asks for, by looking everywhere."""
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, b in items:
            bw = words(b)
            n = min(length, len(bw))
            wins = {tuple(bw[s:s + n]) for s in range(len(bw) - n + 1)} if n else set()
            for s in range(len(w) - n + 1):
                if n and tuple(w[s:s + n]) in wins:
                    hit.update(range(s, s + n))
                    ids.add("null" if item is None else str(item))
        out.append((i, len(w), len(hit), len(ids), sorted(ids), bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs],
                                  "doc_id long, text string, th string, wid int, words string"),
            spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id long, text string, wid int, len string"))


@pytest.mark.parametrize("length,limit", [(4, 200_000), (10, 0)])
def test_against_a_scan(spark, length, limit):
    rng = random.Random(4)
    vocab = ["the", "of", "And", "x", "éa", "中文", "z9", "rare"] + [f"w{i}" for i in range(30)]
    seps = [" ", ", ", "\n", "--", "."]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice(seps) for _ in range(n))      # noqa: E731
    items = [(i, text(rng.randint(1, 25))) for i in range(25)] + [(None, "no id here at all"), (3, "the of"), (90, None), (91, "  ?"),
                                                                  (92, "absent from everything"), (2, items_dup := text(14)), (93, items_dup)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    for i, (_, t) in enumerate(items):
        docs.append((100 + i, text(5) + (t or "").upper() + " " + text(5)))
    docs += [(None, items[0][1]), (7, None), (8, ""), docs[61], docs[61], (200, (items[1][1] + " ") * 300)]
    d, b = frames(spark, docs, items)
    got = dc.contamination(d, b, length, max_broadcast=limit).drop("th")
    assert sorted(map(tuple, got.collect()), key=str) == scan(docs, items, length)


def test_proximity(spark):
    d, b = frames(spark, [(1, "a b c d e"), (2, "a b x c d e"), (3, "a c b d e"), (4, "a b c"), (5, "e d c b a")],
                  [(1, "b c d")])
    hits = lambda **kw: {r.doc_id for r in dc.find_phrases(d, b, **kw)[0].collect() if r.matches}      # noqa: E731
    assert hits() == {1}
    assert hits(slack=1) == {1, 2, 3}


def test_empty_tables(spark):
    d, b = frames(spark, [(1, "a b c")], [(1, "a")])
    none_d, none_b = frames(spark, [], [])
    assert dc.contamination(none_d, b).collect() == []
    assert [tuple(r) for r in dc.contamination(d, none_b).drop("th").collect()] == [(1, 3, 0, 0, [], False)]
