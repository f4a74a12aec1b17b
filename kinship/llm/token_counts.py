"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries into units that the tokenizer encodes
independently: a U+0020 between two non-blank characters starts a new
pre-token in byte-level BPE whatever stands around it, and no special string
holds a blank. The units of one byte-balanced batch are encoded once each by
the library (``encode_batch_fast``), their lengths summed per document; a
bounded cache keeps the lengths of units seen before. A text without safe
boundaries is one unit and is encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kinship.llm.common import keyed

#: A blank next to other white space is not a safe boundary.
_UNSAFE = re.compile(r"\s |^ | $| \s")
_SAFE = re.compile(r"(?<=\S) (?=\S)")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("over_limit", T.BooleanType()),
])


def units(text: str) -> list[str]:
    """The text cut before every safe blank; the pieces join to the text."""
    parts = _SAFE.split(text) if _UNSAFE.search(text) else text.split(" ")
    return [parts[0], *(" " + p for p in parts[1:])]


def balanced(texts: Iterable[str], max_bytes: int) -> Iterator[list[str]]:
    """Consecutive texts grouped to about ``max_bytes`` of UTF-8 each (at least one text)."""
    group, size = [], 0
    for t in texts:
        n = len(t) if t.isascii() else len(t.encode())
        if group and size + n > max_bytes:
            yield group
            group, size = [], 0
        group.append(t)
        size += n
    if group:
        yield group


class UnitLengths(dict):
    """Token counts of units, filled batch-wise by the library's own encoder.

    ``keep`` bounds the number of cached units, ``longest`` their characters;
    longer ones are encoded each time they appear.
    """

    def __init__(self, path: str, keep: int, longest: int):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer, self.keep, self.longest = Tokenizer.from_file(path), keep, longest

    def lengths(self, found: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(found, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        cut = [units(t) for t in texts]
        new = set().union(*cut).difference(self)
        if len(self) + len(new) > self.keep:
            self.clear()
            new = set().union(*cut)
        long = [u for u in new if len(u) > self.longest]
        new.difference_update(long)
        for group in balanced(sorted(new), 1 << 20):
            self.update(zip(group, self.lengths(group)))
        extra = {u: n for g in balanced(long, 1 << 20) for u, n in zip(g, self.lengths(g))}
        if not extra:
            return [sum(map(self.__getitem__, c)) for c in cut]
        return [sum(extra[u] if u in extra else self[u] for u in c) for c in cut]


@lru_cache(maxsize=2)
def lengths_of(path: str, keep: int, longest: int) -> UnitLengths:
    """One cache per Python worker, which Spark reuses for many tasks."""
    return UnitLengths(path, keep, longest)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512,
                 batch_bytes: int = 4 << 20, keep_units: int = 400_000,
                 longest_unit: int = 64) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``tokenizer_path`` is a byte-level BPE file of the tokenizers library,
    readable on every executor. Null and empty texts have no bytes and no
    tokens; repeated rows each get a row; a null ``doc_id`` stays null; an
    empty table gives an empty result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # the task's core is the unit of work
        cache = lengths_of(tokenizer_path, keep_units, longest_unit)
        for b in batches:
            texts = b.column("text").to_pylist()
            n = [x for group in balanced(texts, batch_bytes) for x in cache.counts(group)]
            n_bytes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return keyed(docs).select("doc_id", "text").mapInArrow(count, SCHEMA)
