"""The similarity join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kinship.llm import parity_join as pj
from kinship.llm.graph import components
from kinship.llm.suffix_dedup import U

UP = {c: c + 32 for c in range(65, 91)}


def shingles(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UP))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * len(sets[a] | sets[b]):
                top[root(a)] = root(b)
    ids = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            ids[root(x)] = min(i, ids.get(root(x), i))
    return sorted((str(i), len(sets[x]), str(ids.get(root(x)))) for x, (i, _) in enumerate(rows))


def near_copies(rng, n, families=6):
    vocab = [f"w{i}" for i in range(60)]
    rows = [(9000, None), (9001, ""), (9002, " \n"), (9003, "one"), (9004, "ONE"), (9005, "one two"), (9006, "One\ttwo"),
            (9007, "é É"), (9008, "é é"), (9009, "a b c"), (9010, "a b c d"), (9011, "a " * 2000)]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([11, 12, 13, 20, 80, 300, 700]))] for _ in range(families)]
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
            p = rng.randrange(len(w))
            if rng.random() < 0.5:
                w[p] = rng.choice(vocab)
            elif rng.random() < 0.5:
                w.insert(p, rng.choice(vocab))
            elif len(w) > 1:
                del w[p]
        t = " ".join(w)
        rows.append((i, t.upper() if rng.random() < 0.2 else t))
    rows += [(None, rows[15][1]), (None, "only here without id"), (20, rows[30][1]), rows[31], rows[31]]
    rng.shuffle(rows)
    return rows


def result(df, **kw):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in pj.jaccard_components(df, **kw).collect())


@pytest.mark.parametrize("k,percent,block", [(3, 90, 400_000), (5, 80, 3000), (3, 90, 2000)])
def test_against_all_pairs(spark, k, percent, block):
    rows = near_copies(random.Random(k + block), 160)
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, th string, n int, root int")
    assert result(df.repartition(3), words=k, percent=percent, block_items=block) == brute(rows, k, percent)


def test_bands_keep_similar_sizes_together():
    for percent in (80, 90):
        b = pj.Bands(percent)
        for n in list(range(1, 400)) + [1000, 12345]:
            for m in range(n, n * 100 // percent + 1):
                near = b.of(np.array([m]))[0] - b.of(np.array([n]))[0]
                assert near in (0, 1)
                # the pieces of the larger one's band outnumber what the two may differ in
                assert b.pieces(b.of(np.array([m])))[0] > b.differ(n + m)
                # exactly: more elements apart than this are less similar
                apart = b.differ(n + m) + 1
                assert 100 * (n + m - apart) < percent * (n + m + apart)


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = rng.integers(0, 1 << 60, 200).astype(U)
        b = np.concatenate([a[:180], rng.integers(0, 1 << 60, 10).astype(U)])
        x, y = (pj.sketch(s, np.zeros(len(s), np.int64), np.array([7]))[0] for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= 30


def key_batches(rows, size):
    for a in range(0, len(rows), size):
        k, s = zip(*rows[a:a + size])
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(s, pa.int64())], names=["key", "s1"])


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_keys_meet_over_batch_borders(monkeypatch, size):
    monkeypatch.setattr(pj, "GROUP", 4)
    rng = random.Random(size)
    rows = sorted((k, rng.randrange(30)) for k in range(40) for _ in range(rng.choice([1, 1, 2, 3, 5, 20, 40])))
    few, many = {}, {}
    for b in pj.meet(key_batches(rows, size)):
        for r in b.to_pylist():
            if r["first"] is None:
                few.setdefault(r["key"], []).append(r["s1"])
            else:
                many.setdefault(r["key"], set()).add((r["first"], r["s1"]))
    sets = {}
    for k, s in rows:
        sets.setdefault(k, set()).add(s)
    assert few == {k: sorted(v) for k, v in sets.items() if 1 < len(v) <= 4}
    assert many == {k: {(min(v), x) for x in v if x != min(v)} for k, v in sets.items() if len(v) > 4}


@pytest.mark.parametrize("size", [2, 5, 1000])
def test_comparing_keeps_similar_sets_connected(size):
    rng = np.random.default_rng(size)
    bands, rows, sets = pj.Bands(80), [], {}
    for key in range(30):
        base = rng.integers(0, 1 << 60, 60)
        for i in range(rng.integers(2, 9)):
            x = base.copy()
            other = rng.choice([0, 2, 3, 6, 40])
            x[:other] = rng.integers(0, 1 << 60, other)
            sid = len(sets)
            sets[sid] = (key, np.unique(x).astype(U))
            v = sets[sid][1]
            rows.append((key, sid, len(v), pj.short_sketches(v, np.zeros(len(v), np.int64), np.array([len(v)]))[0]))
    batches = (pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[a:a + size])], names=["key", "s1", "n", "bits"])
               for a in range(0, len(rows), size))
    top = {s: s for s in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for b in pj.compare(batches, bands):
        for a, c in zip(b["a"].to_pylist(), b["b"].to_pylist()):
            assert sets[a][0] == sets[c][0]
            top[root(a)] = root(c)
    for a, (ka, x) in sets.items():
        for c, (kc, y) in sets.items():
            if ka == kc and pj.similar(x, y, 80):
                assert root(a) == root(c)


def test_folded_sketches():
    """Sets of all sizes: the distance of two sketches never exceeds what the sets differ in."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 60, 4000).astype(U)
    sets = [np.unique(base[:k]) for k in (100, 850, 899, 901, 950, 1750, 1799, 1801, 1900, 3500, 3700, 4000)]
    value, text = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    s = pj.Sketches(pj.short_sketches(value, text, np.array([len(x) for x in sets])))
    assert sorted(set(s.size.tolist())) == [8, 16, 32, 64]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            apart = int(s.apart(np.array([i]), np.array([j]))[0])
            assert apart <= len(np.setxor1d(a, b))
    assert s.apart(np.array([3]), np.array([2]))[0] == 2 and s.apart(np.array([7]), np.array([6]))[0] == 2


def test_packed_items():
    v = np.sort(np.random.default_rng(1).integers(0, 1 << 48, 100)).astype(U)
    assert (pj.unpack(pj.pack(v)) == v).all()


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {x: x for e in edges for x in e}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        top[root(a)] = root(b)
    nodes = [x for x in top if any(x in e and e[0] != e[1] for e in edges)]
    assert set(got) == set(nodes)
    assert all((got[x] == got[y]) == (root(x) == root(y)) for x in nodes for y in nodes)


def test_empty_table(spark):
    assert pj.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_elements_keep_all_bits():
    from kinship.llm.parity_join import pack, unpack

    a = np.array([5, 5 + (1 << 50), (1 << 63) + 5, 7], np.uint64)
    assert unpack(pack(a)).tolist() == sorted(a.tolist())


def test_blocks_by_count(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(60)) + f" x{i} y{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in pj.jaccard_components(df, words=3, percent=80, block_docs=7).collect()}
    assert got == dict.fromkeys(range(40), 0)


def test_a_common_line_makes_no_cluster(spark, monkeypatch):
    """Over 512 texts share a key because a common line is alone in a piece: they are compared, in blocks, not connected unseen."""
    rng = random.Random(12)
    tables = {}
    monkeypatch.setattr(pj, "KEY_BLOCK", 256)
    monkeypatch.setattr(pj, "materialise", lambda df, what, made=pj.materialise: tables.setdefault(what, made(df, what)))
    rows = [(i, "one line that all have " + " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(8))) for i in range(12000)]
    rows += [(20000 + i, rows[100 * i][1] + " more") for i in range(20)]
    got = {r.doc_id: r.component_id for r in pj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 100 * (i - 20000) if i >= 20000 else i for i, _ in rows}
    assert tables["shared"].filter("first is not null").count() > 512
    clusters = [r["count"] for r in tables["members"].groupBy("root").count().collect()]
    assert len(clusters) >= 20 and max(clusters) < 10
