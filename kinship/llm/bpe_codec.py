"""Byte-level BPE encoding and decoding of whole texts in overlapping chunks.

Every text is cut into chunks that overlap; each chunk is pre-tokenised and
encoded on its own, wherever its row happens to be. Two neighbours are
stitched at the first pre-token boundary of the overlap on which both agree:
the pattern never looks back, so from a common boundary on both see the same
matches. Ids of one chunk then end, and those of the next begin, exactly
there. A pair of chunks that never agrees (one pre-token longer than the
overlap) is pre-tokenised again from the last sure boundary on.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import keyed, lean

ENCODED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("th", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])
DECODED = T.StructType([*ENCODED.fields, T.StructField("decoded", T.BinaryType())])
CHUNKS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("th", T.LongType()),
    T.StructField("at", T.LongType()),
    T.StructField("text", T.StringType()),
])
PIECES = T.StructType([
    *CHUNKS.fields,
    T.StructField("lens", T.BinaryType()),      # characters of each pre-token, int32
    T.StructField("sizes", T.BinaryType()),     # bytes of its ids, int32
    T.StructField("ids", T.BinaryType()),
])

#: A pre-token this far before the end of a chunk has been matched with all in
#: sight that the pattern may look at (the longest contraction has 3 characters).
MARGIN = 8
#: Documents of one chunk that are encoded, decoded and handed on together.
SLICE = 200

Piece = tuple[int, bytes]       # characters of a pre-token, its ids


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Pre-tokenise, encode and decode."""

    def __init__(self, path: str, pattern: str, keep: int = 120_000):
        import regex
        import tiktoken

        ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.core = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks,
                                      special_tokens={})._core_bpe
        self.raw = {i: b for b, i in ranks.items()}
        self.keep, self.cache = keep, {}

    def pretokens(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        cache = self.cache
        if len(cache) > self.keep:
            cache.clear()
        out = []
        for p in pieces:
            got = cache.get(p)
            if got is None:
                got = np.array(self.core.encode_single_piece(p.encode()), "<u4").tobytes()
                if len(p) <= 64:
                    cache[p] = got
            out.append(got)
        return out

    def decode(self, ids: bytes) -> bytes:
        """The raw bytes of the ids, concatenated."""
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec_of(path: str, pattern: str) -> Codec:
    """One codec per Python worker, which Spark reuses for many tasks."""
    return Codec(path, pattern)


def starts(n_chars: int, chunk: int, overlap: int) -> list[int]:
    """First characters of the chunks of a text; every text has one chunk at least."""
    return list(range(0, max(1, n_chars - overlap), chunk - overlap))


def stitch(cuts: list[int], chunks: list[list[Piece]],
           again: Callable[[int, int], list[Piece]]) -> list[Piece]:
    """Pre-tokens of the whole text from those of its overlapping chunks.

    ``again(a, b)`` pre-tokenises characters a to b anew, for neighbours that
    agree on no boundary of their overlap.
    """
    done = list(chunks[0])
    end = cuts[0] + sum(n for n, _ in done)
    for at, nxt in zip(cuts[1:], chunks[1:]):
        begins, x = {at: 0}, at
        for k, (n, _) in enumerate(nxt, 1):
            x += n
            begins[x] = k
        keep, e = len(done), end
        while keep and e > end - MARGIN:           # not sure yet: its match may go on
            keep -= 1
            e -= done[keep][0]
        sure, sure_end = keep, e
        while keep and e > at and e not in begins:
            keep -= 1
            e -= done[keep][0]
        if e in begins:
            done[keep:] = nxt[begins[e]:]
        else:
            done[sure:] = again(sure_end, x)
        end = x
    return done


def encode(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = 1 << 15,
           overlap: int = 1 << 10, and_decode: bool = False) -> DataFrame:
    """``doc_id, th, ids`` of every row, ids as little-endian uint32; with
    ``and_decode`` also ``decoded``, what :func:`decode` makes of the ids, from
    the same task.

    Each match of ``pattern`` is encoded separately, without special tokens.
    Texts of one chunk are encoded where they are read; the chunks of longer
    ones are spread over the cluster and only their ids and boundaries meet
    again, per document. Null and empty texts have no ids; repeated rows each
    get a row; an empty table gives an empty result.
    """
    k = keyed(docs)
    schema = DECODED if and_decode else ENCODED
    arrow = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("ids", pa.binary()),
                       ("decoded", pa.binary())][:len(schema)])

    def columns(codec: Codec, doc, th, ids: list[bytes]) -> list[pa.Array]:
        raw = [pa.array(map(codec.decode, ids), pa.binary())] if and_decode else []
        return [pa.array(doc, pa.int64()), pa.array(th, pa.int64()), pa.array(ids, pa.binary()), *raw]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks_path, pattern)
        for b in batches:
            for at in range(0, b.num_rows, SLICE):          # small slices: what is alive at once is bounded
                doc, th, texts = (b.column(c).slice(at, SLICE).to_pylist() for c in ("doc_id", "th", "text"))
                ids = [b"".join(codec.ids(codec.pretokens(t))) for t in texts]
                yield pa.RecordBatch.from_arrays(columns(codec, doc, th, ids), schema=arrow)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, th, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "text"))):
                at = starts(len(text), chunk, overlap)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(at), pa.int64()), pa.array([th] * len(at), pa.int64()),
                     pa.array(at, pa.int64()), pa.array([text[a:a + chunk] for a in at], pa.string())],
                    names=CHUNKS.names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks_path, pattern)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, SLICE // 4):
                b = whole_batch.slice(at, SLICE // 4)
                lens, sizes, ids = [], [], []
                for t in b.column("text").to_pylist():
                    found = codec.pretokens(t)
                    got = codec.ids(found)
                    lens.append(np.array([len(p) for p in found], "<i4").tobytes())
                    sizes.append(np.array([len(i) for i in got], "<i4").tobytes())
                    ids.append(b"".join(got))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, *(pa.array(x, pa.binary()) for x in (lens, sizes, ids))], names=PIECES.names)

    def join(doc: pa.Table) -> pa.Table:
        rows = doc.to_pylist()
        copies = sum(r["at"] == 0 for r in rows)
        rows = [by for _, by in sorted({r["at"]: r for r in rows}.items())]
        chunks = []
        for r in rows:
            stop = np.cumsum(np.frombuffer(r["sizes"], "<i4")).tolist()
            chunks.append([(n, r["ids"][a:z]) for n, a, z in
                           zip(np.frombuffer(r["lens"], "<i4").tolist(), [0, *stop], stop)])
        cuts = [r["at"] for r in rows]

        def again(a: int, b: int) -> list[Piece]:
            codec = codec_of(ranks_path, pattern)
            ends = [*cuts[1:], cuts[-1] + len(rows[-1]["text"])]
            text = "".join(r["text"][max(0, a - c):min(b, z) - c]
                           for r, c, z in zip(rows, cuts, ends) if c < b and z > a)
            found = codec.pretokens(text)
            return list(zip(map(len, found), codec.ids(found)))

        ids = b"".join(i for _, i in stitch(cuts, chunks, again))
        one = rows[0]
        out = columns(codec_of(ranks_path, pattern), [one["doc_id"]], [one["th"]], [ids])
        return pa.table([pa.concat_arrays([c] * copies) for c in out], schema=arrow)

    short = k.filter(F.length("text") <= chunk).mapInArrow(lean(whole), schema)
    long = (k.filter(F.length("text") > chunk).mapInArrow(lean(cut), CHUNKS)
            .repartition("doc_id", "th", "at").mapInArrow(lean(pieces), PIECES)
            .groupBy("doc_id", "th").applyInArrow(join, schema))
    return short.unionByName(long)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds ``decoded``, the concatenated raw bytes of ``ids``."""

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks_path, pattern)
        for b in batches:
            out = [codec.decode(i) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=DECODED.names)

    return encoded.select("doc_id", "th", "ids").mapInArrow(lean(raw), DECODED)
