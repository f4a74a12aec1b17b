"""Base spans against the patterns run over whole texts; the field by brute force and on held-out rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from kinship.llm import pii

SCHEMA = "doc_id long, text string, th string, base int"
SF = "/root/testdata/sf0.001"


def plain_base(text):
    """The contract's patterns, straight over the text."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m[0].split("."))) <= 255:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    parts = ["a.b@c.de", "x@y", "@", "@@", " ", "\n", "4111 1111 1111 1111", "4111111111111112", "1.2.3.4", "300.1.1.1",
             "1.2.3.4.5", "+1 (042) 555-7845", "+1", "é", "word", "中", "(555) 123-4567", "-", "12", ".", "a_b%c+d@e-f.g.h",
             "　", "\x85", "\x1c"]
    return ["", " ", *("".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(300))]


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_base_spans(texts):
    for t in texts:
        assert pii.base_spans(t) == plain_base(t)


def test_words_do_not_cross_texts(texts):
    w = pii.Words(texts)
    for t, s, e in zip(w.text, w.start - w.offset[w.text], w.end - w.offset[w.text]):
        assert 0 <= s < e <= len(texts[t])


def test_viterbi_is_the_best_path():
    """Decoding, cuts included, against all paths of short chains."""
    rng = np.random.default_rng(0)
    n, tags = pii.N_SHAPES, pii.TAGS
    shape = rng.integers(0, 6, 40).astype(np.int32)
    text = np.repeat(np.arange(10), 4)
    for scale in (0.3, 3.0):
        own, prev, nxt = (rng.normal(size=(n + 1, tags)).astype(np.float32) for _ in range(3))
        own[:3, 0] += 6 * scale
        field = pii.Field(own, prev, nxt, (scale * rng.normal(size=(tags, tags))).astype(np.float32))
        got = field.decode(shape, text)
        before, after = pii.neighbours(shape, text)
        e = own[shape] + prev[before] + nxt[after]
        for a in range(0, 40, 4):
            best = max(itertools.product(range(tags), repeat=4), key=lambda p: sum(e[a + i, p[i]] for i in range(4))
                       + sum(field.step[p[i], p[i + 1]] for i in range(3)))
            assert tuple(got[a:a + 4]) == best


def test_the_field_learns(field):
    """Held-out rows: most base spans are found by the field alone, clean words are left alone."""
    import duckdb

    docs = [r[0] for r in duckdb.sql("select text from read_parquet('/root/testdata/sf0.01/documents.parquet')"
                                     " where doc_id >= 200").fetchall()]
    w = pii.Words(docs)
    found = set(zip(*(x.tolist() for x in w.spans_of(field.decode(w.shape, w.text)))))
    base = {(i, k, s, e) for i, t in enumerate(docs) for s, k, e in pii.base_spans(t)}
    assert len(found & base) >= 0.7 * len(base)
    assert len(found - base) <= 0.5 * len(base)


def test_added_formats(field):
    t = ["call (555) 123-4567 now", "tel 042-555-7845 ok", "plain words only", ""]
    assert pii.added_spans(field, t, [[]] * 4) == [[(5, 3, 19)], [(4, 3, 16)], [], []]


def test_find_and_query(spark, field, texts):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "mail a@b.cd", "x", 1), (5, None, "x", 1), (1, " ", "x", 1)]
    out = pii.find(spark.createDataFrame(rows, SCHEMA), field, batch_chars=500).collect()
    assert len(out) == len(rows)
    by_text = {}
    for r in out:
        by_text.setdefault(r.doc_id, []).append([(s.start, pii.KINDS.index(s.kind), s.end) for s in r.base])
    for i, t, *_ in rows:
        assert plain_base(t or "") in by_text[i]
    assert pii.find(spark.createDataFrame([], SCHEMA), field).collect() == []

    from kinship.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_pii"](spark, SF).collect():
        base = plain_base(docs[r.doc_id])
        named = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(named) <= set(r.spans.split(",")) | {""}


def test_fit_without_rows(spark):
    field = pii.fit(spark.createDataFrame([], SCHEMA))
    assert pii.added_spans(field, ["the of and"], [[]]) == [[]]


def test_all_pieces_of_a_text_train():
    from kinship.llm.pii import cuts

    text = " ".join(f"{'word ' * 40}mail{i}@example.org" for i in range(60))
    pieces = cuts(text, 20)
    assert len(pieces) == 60 and all(a < z for a, z in pieces) and pieces[0][0] > 0
    assert all(any(a <= text.index(f"mail{i}@") < z for a, z in pieces) for i in (0, 41, 59))
    assert cuts("no marks here", 20) == []
