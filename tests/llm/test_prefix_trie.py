"""The conversation trie against sets of prefixes, with small shards and many partitions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from kinship.llm.prefix_trie import SlotTable, trie

SCHEMA = "conv_id long, turn long, role string, text string, d int, g string, pos string, words string"
WHITE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "g", "p", "w") for r in rows], SCHEMA)


def words(text):
    for c in WHITE:
        text = text.replace(c, " ")
    return len([w for w in text.split(" ") if w])


def brute(rows, family=20, heads=4):
    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]

    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    convs = {c: [t[3] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        built[c] = tuple(convs.get(c - c % family, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, m in members.items():
        worth = (len(m) - 1) * words(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += worth
            leaves[p[:d]] += p not in kids
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if built[c] == p))).encode()).hexdigest())
                  for p, m in members.items())


def rows_of(df):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"],
                   r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


def conversations(seed):
    rng = random.Random(seed)
    texts = ["", "a", "a b", " a\tb\x0bc ", "x y z w", "é ü", "a b"]
    rows = []
    for c in rng.sample(range(130), 90):
        turns = [(t, rng.choice(["user", "system", None]), rng.choice([*texts, None])) for t in range(rng.randint(1, 6))]
        if c % 3 == 0:                      # a third of all conversations is one
            turns = [(0, "user", "hot start"), (1, "assistant", "one two three"), (2, "user", "same")]
        rows += [(c, t, r, x) for t, r, x in turns]
    rows += [(500, t, "user", f"long {t % 5}") for t in range(300)] + [(501, t, "user", f"long {t % 5}") for t in range(290)]
    rows += [(502, None, "user", "null turn"), (502, 0, "user", "b"), (502, 0, "user", "a"), (502, 0, "user", "a")]
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None), (7000, 0, "user", "base is absent"), (7000, 0, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [2, 9, 4096])
def test_trie(spark, limit):
    rows = conversations(limit)
    assert rows_of(trie(frame(spark, rows).repartition(5), limit=limit)) == brute(rows)


def test_other_families(spark):
    rows = conversations(3)
    assert rows_of(trie(frame(spark, rows), family=7, heads=3, limit=30)) == brute(rows, 7, 3)


def test_a_conversation_over_many_partitions(spark):
    """Ranges split one conversation that holds nearly all rows, and one node's conversations."""
    rows = [(40, t, "user", f"{t % 3}") for t in range(900)] + [(c, 0, "user", "all alike") for c in range(1000, 1600)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(trie(frame(spark, rows), limit=50)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_turnless_and_empty(spark):
    # without a base, a conversation of at most h turns loses them all and is a member of the root only
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "x"), (c, 1, "user", "y")]
    none = hashlib.sha256(str(c).encode()).hexdigest()
    assert rows_of(trie(frame(spark, rows))) == [(c, 0, -1, 1, 0, 1, 0, none)] == brute(rows)
    assert trie(frame(spark, [])).collect() == []
    assert trie(frame(spark, [(None, 1, "a", "b")])).collect() == []


def test_slots():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    other = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    table = SlotTable(keys)
    assert sorted(table.slots(keys)) == list(range(5000))
    assert (table.slots(other) == -1).all()
    assert len(SlotTable(keys[:0]).slots(other)) == 5000
