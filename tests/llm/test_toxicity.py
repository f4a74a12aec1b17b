"""The pattern grammar clause by clause, and held-out accuracy."""

import math
import random
import re
import zlib
from itertools import product

import pytest

from kinship.llm import toxicity as tx

SCHEMA = "doc_id long, text string, th string, score int"


def test_clauses():
    read = lambda s: tx.read_clause(s, [1.0] * sum(c in "IT" for c in s))      # noqa: E731
    assert read("") == {} and read("YNR") == {}
    assert read("I") == {"i": 1.0}
    assert read("YI") == {"i-at": 1.0}
    assert read("IY") == {"i": 1.0, "i-at": 1.0}
    assert read("NI") == {"i-neg": 1.0}
    assert read("YNI") == {"i-neg": 1.0}
    assert read("YRYI") == {"i-rep": 1.0}
    assert read("T") == {"t": 1.0}
    assert read("YT") == {"t-at": 1.0}
    assert read("RNT") == {"t-neg": 1.0}
    assert read("II") == {"i": 2.0}


def plain_clause(symbols, weights):
    """A clause by looking back from every word, without any machine."""
    out = {}

    def add(kind, weight):
        out[kind] = out.get(kind, 0.0) + weight

    hits = [i for i, s in enumerate(symbols) if s in "IT"]
    for i, s in enumerate(symbols):
        before = symbols[:i]
        if s in "IT":
            how = "-neg" if "N" in before else "-rep" if "R" in before else "-at" if "Y" in before else ""
            add(s.lower() + how, weights[hits.index(i)])
        elif s == "Y":
            earlier = [j for j in hits if j < i]
            if any("N" not in symbols[:j] and "R" not in symbols[:j] for j in earlier):
                add("i-at", weights[hits.index(earlier[-1])])
    return out


def test_every_short_clause_as_read_plainly():
    for n in range(7):
        for symbols in map("".join, product("ITYNR", repeat=n)):
            weights = [1.0 + j / 8 for j in range(sum(c in "IT" for c in symbols))]
            assert tx.read_clause(symbols, weights) == plain_clause(symbols, weights), symbols


def test_texts_as_read_plainly():
    lexicon = {"idiot": 2.0, "^scum": 3.0, "^scumb": 3.5, "kill": 1.5}
    words = ["idiot", "idiots", "scum", "scumbag", "kill", "hurt", "you", "them", "not", "said", "table", "Écrit", "x1y", "NEVER"]
    fixed = [(set(ws), c) for ws, c in ((tx.TARGETS, "Y"), (tx.NEGATIONS, "N"), (tx.REPORTS, "R"), (tx.THREATS, "T"))]
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", ". ", "; ", "!", "\n", "-"]) for _ in range(rng.randint(0, 40)))
        total = dict.fromkeys(tx.KINDS, 0.0)
        for clause in re.split(r"[.!?;:\n]", text.lower()):
            symbols, weights = "", []
            for w in re.findall(r"[^\W\d_]+", clause):
                weight = max([v for e, v in lexicon.items() if w == e or (e[0] == "^" and w.startswith(e[1:]) and len(w) >= len(e))],
                             default=0.0)
                c = "I" if weight else next((c for ws, c in fixed if w in ws), "")
                symbols += c
                weights += [weight or 1.0] if c in ("I", "T") else []
            for kind, v in plain_clause(symbols, weights).items():
                total[kind] += v
        assert tx.Reader(lexicon).features(text) == pytest.approx([math.log1p(total[k]) for k in tx.KINDS])


def test_scope_ends_with_the_clause():
    r = tx.Reader({"idiot": 2.0, "^scum": 3.0})
    kinds = lambda t: {k for k, v in zip(tx.KINDS, r.features(t)) if v}      # noqa: E731
    assert kinds("not an idiot") == {"i-neg"}
    assert kinds("not now. an idiot") == {"i"}
    assert kinds("she said idiot; you scumbag") == {"i-rep", "i-at"}
    assert kinds("") == kinds("nothing here") == set()


def test_composition_is_one_deterministic_machine():
    m = tx.grammar()
    states = {q for q, _ in m}
    assert all((q, s) in m for q in states for s in "ITYNR")
    assert {r for r, _ in m.values()} <= states


@pytest.mark.parametrize("sf,least", [("sf0.01", 0.75), ("sf0.1", 0.95)])
def test_held_out(spark, sf, least):
    d = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    y = {r.doc_id: r.toxic for r in labels.collect()}
    rows = tx.score(d, tx.fit(d, labels)).collect()
    assert len(rows) == d.count()
    for r in rows[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, y[r.doc_id]) for r in rows if r.held_out and r.doc_id in y]
    pos, neg = [s for s, t in held if t], [s for s, t in held if not t]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc >= least


def test_odd_tables(spark):
    rows = [(1, "you idiot", "x", 1), (1, "you idiot", "x", 1), (None, None, "x", 1), (2, "", "x", 1),
            (3, "fine words " * 5000, "x", 1)]
    d = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = tx.fit(d, none)
    assert model.lexicon == {} and [r.score for r in tx.score(d, model).collect()] == [0.5] * 5
    lab = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert tx.score(d, tx.fit(d, lab)).count() == 5
    assert tx.score(spark.createDataFrame([], SCHEMA), model).collect() == []
    assert tx.fit(spark.createDataFrame([], SCHEMA), none).lexicon == {}
