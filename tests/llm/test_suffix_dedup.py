"""Suffix arrays and repeated strings against brute force."""

import random

import numpy as np
import pytest

from kinship.llm import suffix_dedup as sd


def brute_spans(texts, length):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for i, b in enumerate(raw):
        for s in range(len(b) - length + 1):
            seen.setdefault(b[s:s + length], []).append((i, s))
    spans = [[] for _ in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                spans[i].append((s, s + length))
    out = []
    for b, sp in zip(raw, spans):
        keep = np.ones(len(b), bool)
        for a, z in sp:
            keep[a:z] = False
        out.append((len(b), bytes(np.frombuffer(b, np.uint8)[keep]), len(sd.runs(~keep)[0])))
    return out


def texts_with_repeats(rng, n=60):
    abc = "abcdefghijklmnop ééñ"
    text = lambda k: "".join(rng.choice(abc) for _ in range(k))      # noqa: E731
    passages = [text(rng.randint(300, 900)) for _ in range(5)]
    out = ["", "short", "x" * 2000, "ab" * 900, "xyz" * 200, None]
    for _ in range(n):
        t = text(rng.randint(0, 900))
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            t += p[a:a + rng.randint(200, 900)] + text(rng.randint(0, 60))
        out.append(t)
    return out + out[10:14]


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    strings = [bytes(rng.choices(b"ab\0\xff", k=rng.randint(0, 60))) for _ in range(30)] + [b"a" * 40, b"", b"a" * 41]
    sa = sd.SuffixArray(strings)
    key = lambda k, i: [c + 1 for c in strings[k][i:]] + [k - len(strings)]      # noqa: E731  own separators
    places = [(k, i) for k, s in enumerate(strings) for i in range(len(s) + 1)]
    assert [places[p] for p in sa.order] == sorted(places, key=lambda x: key(*x))
    got = sa.common_prefixes(np.array([len(s) for s in strings]))
    before = dict(zip(sa.order[1:], sa.order[:-1]))
    for p, (k, i) in enumerate(places):
        if i < len(strings[k]) and p in before:
            a, b = strings[k][i:], strings[places[before[p]][0]][places[before[p]][1]:]
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert got[p] == n


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 700)
    rng = random.Random(2)
    anchors = {}
    for t in texts_with_repeats(rng, 20):
        data = (t or "").encode()
        n = 0
        if len(data) < 400:
            continue
        for cols in sd.regions_of(data, 400, 64):
            for a, c, s0, k, own in zip(*cols):
                assert k <= sd.MOST
                for s in range(s0, s0 + k):
                    anchors.setdefault(data[s:s + 400], set()).add(a)
                n += k
        assert n == len(data) - 399
    assert all(len(v) == 1 for v in anchors.values())


@pytest.mark.parametrize("length,shard", [(400, 1 << 20), (300, 2500)])
def test_dedup(spark, length, shard):
    texts = texts_with_repeats(random.Random(3))
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    rows[5] = (None, rows[20][1], "x", 1)
    rows += [rows[30], (31, "z" * 700, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, th string, n int")
    got = sorted((str(r.doc_id), r.n_bytes, bytes(r.kept), len(r.spans))
                 for r in sd.dedup(df, length, gram=64, shard_bytes=shard).collect())
    assert got == sorted((str(r[0]), *b) for r, b in zip(rows, brute_spans([r[1] for r in rows], length)))


def test_hot_anchor_is_spread_and_merged(spark):
    rng = random.Random(4)
    text = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))      # noqa: E731
    core = text(330)
    texts = [text(200) + core + text(200) for _ in range(40)]
    texts += [t[:160] + text(300) + t[150:] for t in texts[:10]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, bytes(r.kept), len(r.spans))
                 for r in sd.dedup(df, 400, gram=64, shard_bytes=4000).collect())
    assert got == [(i, *b) for i, b in enumerate(brute_spans(texts, 400))]


def test_empty_table(spark):
    assert sd.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_what_may_repeat_holds_all_repeats(monkeypatch):
    rng = random.Random(8)
    for piece in (700, 1 << 19):
        monkeypatch.setattr(sd, "PIECE", piece)
        strings = [(t or "").encode() for t in texts_with_repeats(rng, 40)]
        starts = np.array([max(0, len(s) - 399) for s in strings])
        places = {}
        for i, s in enumerate(strings):
            for a in range(starts[i]):
                places.setdefault(s[a:a + 400], []).append((i, a))
        repeated = {p for v in places.values() if len(v) > 1 for p in v}
        kept = {(i, a + k) for i, a, n in sd.may_repeat(strings, starts, 400) for k in range(n)}
        assert repeated <= kept and all(a < starts[i] for i, a in kept)
        assert len(kept) < 1.5 * len(repeated)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_many_texts_under_one_id(spark, doc_id):
    rng = random.Random(15)
    text = lambda k: "".join(rng.choices("abcdefgh", k=k))      # noqa: E731
    texts = []
    for _ in range(2500):
        passage = text(262)
        texts += [text(rng.randint(0, 30)) + passage + text(rng.randint(0, 30)) for _ in range(2)]
    df = spark.createDataFrame([(doc_id, t) for t in texts], "doc_id long, text string").repartition(4)
    got = sorted((r.n_bytes, bytes(r.kept), len(r.spans)) for r in sd.dedup(df, 256, gram=64).collect())
    assert got == sorted(brute_spans(texts, 256))
