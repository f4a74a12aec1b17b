"""The filter audit against running every order of the filters, one after the other."""

import random
from itertools import permutations

import numpy as np

from kinship.llm.filter_audit import COUNTS, audit, gray_walk

SCHEMA = "doc_id long, text string, source string, part string, mask int, n string, good int, digest string"
LABELS = "doc_id long, quality int, toxic int, part string, good string"


def docs_of(seed):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "d", "É"]
    rows = []
    for i in range(120):
        text = rng.choice(["", None, "a", "A B C $", "x" * 300_000, " ".join(rng.choices(words, k=rng.randint(1, 12))),
                           " ".join(f"w{j}" for j in range(230)), "\t".join(["same"] * 250) + "\x0b#", "copied " * 210])
        rows.append((i if i % 31 else None, text, rng.choice(["s1", "s1", "s1", "s2", None, ""])))
    return rows + [rows[5], rows[5], (5, "other text", "s1"), (5, "a", "s2")]


def brute(docs, labels):
    marks = {}
    for i, q, t in labels:
        if i is not None:
            old = marks.get(i, (False, False))
            marks[i] = (old[0] or q == 1, old[1] or t == 1)
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)

    def fails(i, t):
        for c in "\t\n\x0b\x0c\r":
            t = t.replace(c, " ")
        w = [x for x in t.split(" ") if x]
        return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                "D": any(c in "#$%&*|" for c in t)}

    rows = [(s or "", {**fails(i, t or ""), "E": i is not None and first[t or ""] < i}, marks.get(i, (False, False))) for i, t, s in docs]
    out = []
    for part in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == part]
        each, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                shapley[f] += len(gone)
                each.append((part, "".join(order), k + 1, len(left), len(gone), sum(r[1][f] for r in own) - len(gone),
                             sum(r[1][f] and sum(r[1].values()) == 1 for r in own), sum(r[2][0] for r in gone), sum(r[2][1] for r in gone), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in each]
    return sorted(out)


def check(spark, docs, labels):
    d = spark.createDataFrame([(i, t, s, "x", 1, "y", 2, "z") for i, t, s in docs], SCHEMA)
    lab = spark.createDataFrame([(*r, "x", "y") for r in labels], LABELS)
    got = audit(d, lab)
    assert got.columns == ["part", "filter_order", "step", *COUNTS]
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_all_orders(spark):
    rng = random.Random(2)
    labels = [(rng.choice([None, *range(120)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)]
    check(spark, docs_of(1), labels)


def test_a_hot_text(spark):
    check(spark, [(i, "one text for all" if i % 2 else f"text {i}", "s") for i in range(300)], [(i, 1, i % 2) for i in range(300)])


def test_empty(spark):
    check(spark, [], [(1, 1, 1)])
    check(spark, [(1, "a", "s"), (None, None, None)], [])


def test_walk_is_each_subset():
    rng = np.random.default_rng(3)
    weights = rng.integers(0, 50, (32, 3))
    states = gray_walk(np.arange(32), weights)
    for s in range(32):
        assert (states[s] == weights[(np.arange(32) & s) == 0].sum(0)).all()
