"""Token counts and the byte-level BPE codec against the libraries themselves."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from kinship.llm import bpe_codec
from kinship.llm.token_counts import token_counts, units

HARD = ["", " ", "  a", "a  b ", "a\n b", "x <|endoftext|> y", "<|endoftext|>", "we'll they're I'm it's 'tis",
        "a" * 5000, " " * 700, "é ü 中文 текст x y", "tab\tand\r\nline\n\n\n  end", "1234 5 67,8  9",
        "a b c\x1cd\x85e f", "word " * 3000, "'" * 90, "''re''ll " * 400, "　" * 300 + "x"]
SCHEMA = "doc_id long, text string, th string, ids int"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    parts = ["the", " of", "  ", "\n", "'re", "'l", "l", "é", "中", "12", "!?", "\t", " ", "don't", " ", "x" * 40]
    return HARD + ["".join(rng.choices(parts, k=rng.randint(1, 900))) for _ in range(80)]


@pytest.fixture(scope="module")
def enc():
    ranks = bpe_codec.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def frame(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, "null id", "c", 2), (7, None, "c", 3), (3, texts[3], "c", 4)], SCHEMA)


def test_units_join_to_the_text(texts):
    for t in texts:
        assert "".join(units(t)) == t


def test_counts_equal_the_library(spark, texts):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    df = frame(spark, texts)
    out = token_counts(df, P.path("byte_bpe_50k.json"), keep_units=50, batch_bytes=2000)
    got = sorted(map(tuple, out.collect()), key=str)
    exp = []
    for r in df.collect():
        n = len(tok.encode(r.text or "", add_special_tokens=False))
        exp.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    assert got == sorted(exp, key=str)


@pytest.mark.parametrize("chunk,overlap", [(64, 20), (300, 50), (1 << 15, 1 << 10)])
def test_codec_equals_the_library(spark, texts, enc, chunk, overlap):
    df = frame(spark, texts)
    coded = bpe_codec.decode(
        bpe_codec.encode(df, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, chunk, overlap),
        P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    got = sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in coded.collect()), key=str)
    both = bpe_codec.encode(df, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, chunk, overlap, and_decode=True)
    assert got == sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in both.collect()), key=str)
    exp = sorted(((r.doc_id, np.array(enc.encode_ordinary(r.text or ""), "<u4").tobytes(), (r.text or "").encode())
                  for r in df.collect()), key=str)
    assert got == exp


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert token_counts(df, P.path("byte_bpe_50k.json")).collect() == []
    assert bpe_codec.encode(df, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect() == []


def test_queries_read_whole_tables(spark, enc):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    two = {r.doc_id: r.n_tokens for r in E.queries()["op2_token_counts"](spark, sf).collect()}
    assert two == {i: len(tok.encode(t, add_special_tokens=False)) for i, t in docs.items()}
    for r in E.queries()["op6_byte_bpe_codec"](spark, sf).collect():
        ids = enc.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_batches_are_balanced_by_bytes():
    from kinship.llm.token_counts import balanced

    assert list(balanced(["é" * 4, "é" * 4, "aaaa", "aaaa", "a" * 99], 10)) == [["é" * 4], ["é" * 4], ["aaaa", "aaaa"], ["a" * 99]]
