"""Substring deduplication by level-wise doubling.

A window of 13 words can only be repeated if every shorter window inside it
is. So windows are first judged by 4 words of theirs, those that are repeated
by 8 words, and what survives by all 13. A window is stood for, at a shorter
length, by the gram in it with the smallest hash, which equal windows share;
neighbouring windows with the same gram are one row, a run.

At each level the rows meet by gram, sorted, and are read as a stream. Before
they are shuffled, a batch is combined: of runs with equal words only the one
of the smallest document travels, the others are known to be repeated, and a
gram that a batch holds in several documents sends one mark. So a passage that
a third of all rows share costs a few rows per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm import common
from kinship.llm.common import materialise, small
from kinship.llm.suffix_dedup import U, mix, sliding_min

FIRST = 4
#: A null id, which counts as smaller than every other id.
NO_ID = -(1 << 63)
#: What a row says: removed, to be judged at the next length, met here, a gram of several documents.
GONE, NEXT, MEET, MARK = range(4)
#: Most windows of one run: its first and last window then cover all of its words.
MOST = 13


def place(start, n, kind):
    """First window, number of windows and what the row says, in 64 bits."""
    return (start << 6) | (n << 2) | kind


def unplace(p: np.ndarray) -> tuple[np.ndarray, ...]:
    return p >> 6, (p >> 2) & 15, p & 3


_RNG = np.random.Generator(np.random.PCG64(13))
_BYTE = _RNG.integers(0, 1 << 64, 256, U)
_R, _R_INV = U(0x9E3779B97F4A7C15 | 1), U(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, r in enumerate((_R, _R_INV)):
            _POWERS[i] = np.concatenate([np.ones(1, U), np.cumprod(np.full(max(n, 1 << 16) - 1, r, U))])
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """Words of several texts: 64-bit hashes, places in the joined bytes, first word of each text."""

    def __init__(self, texts: list[str]):
        self.data = "\n".join([*texts, ""]).encode()
        raw = np.frombuffer(self.data, np.uint8)
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[1], blank.view(np.int8), [1]]).astype(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        up, down = powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, U)
        np.cumsum(_BYTE[raw] * up[:len(raw)], out=total[1:])
        h = (total[self.end] - total[self.start]) * down[self.start]
        self.hash = mix(h, (self.end - self.start).astype(U))
        ends = np.cumsum([len(t.encode()) + 1 for t in texts])
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)]).astype(np.int64)

    def of_windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows that lie in one text, and the text of each."""
        n = np.maximum(np.diff(self.first) - length + 1, 0)
        text = np.repeat(np.arange(len(n)), n)
        return np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + self.first[text], text


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all grams of ``size`` words, by doubling."""
    g, k = words, 1
    while 2 * k <= size:
        g, k = (mix(g[:-k], g[k:]) if len(g) > k else g[:0]), 2 * k
    d = size - k
    return (mix(g[:-d], g[d:]) if len(g) > d else g[:0]) if d else g


def run_table(value: np.ndarray, start: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the runs of windows that follow each other in
    one text and share a value, cut to at most ``MOST``."""
    if not len(value):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(value)))
    cuts = -(-n // MOST)
    owner = np.repeat(np.arange(len(first)), cuts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    return first[owner] + nth * MOST, np.minimum(n[owner] - nth * MOST, MOST)


def groups(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the (sorted) keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def judge(h: np.ndarray, c: np.ndarray, doc: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, ...]:
    """For rows sorted by gram, content and document: whether a smaller document
    has the content, the gram is in several documents, and it has several contents."""
    new_h, new_c = groups(h), groups(h, c)
    gh, gc = np.cumsum(new_h) - 1, np.cumsum(new_c) - 1
    at_h, at_c = np.flatnonzero(new_h), np.flatnonzero(new_c)
    smaller = doc > doc[at_c][gc]
    marked = np.maximum.reduceat(mark, at_h) if len(at_h) else mark
    several = (np.minimum.reduceat(doc, at_h) < np.maximum.reduceat(doc, at_h)) | marked if len(at_h) else marked
    contents = (np.bincount(gh[at_c], minlength=len(at_h)) > 1) | marked
    return smaller, several[gh], contents[gh]


_ROWS = T.StructType([T.StructField(c, T.LongType()) for c in ("h", "c", "doc", "tag", "place")])
_PLACES = T.StructType([T.StructField(c, T.LongType()) for c in ("doc", "tag", "place")])
_RUNS = T.StructType([*(T.StructField(c, T.LongType()) for c in ("h", "doc", "tag", "place")), T.StructField("names", T.BinaryType())])


def batch_of(schema: T.StructType, *cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == U else c) for c in cols], names=schema.names)


def slices(batch: pa.RecordBatch, max_chars: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``max_chars`` of text."""
    at, size = 0, 0
    for i, t in enumerate(batch.column("text")):
        size += t.as_buffer().size
        if size >= max_chars:
            yield batch.slice(at, i + 1 - at)
            at, size = i + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def first_level(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Runs of windows by their smallest gram of ``FIRST`` words, combined per batch."""
    for b in batches:
        parts = []
        for s in slices(b):
            w = Words(s.column("text").to_pylist())
            start, text = w.of_windows(length)
            if not len(start):
                continue
            g = grams(w.hash, FIRST)
            low = sliding_min(g, length - FIRST + 1)[start]
            name = grams(w.hash, length)[start]
            at, n = run_table(low, start, text)
            last = at + n - 1
            t = text[at]
            doc = s.column("doc").to_numpy()[t]
            tag = s.column("tag").to_numpy()[t]
            parts.append((low[at], mix(mix(name[at], name[last]), n.astype(U)), doc, tag, start[at] - w.first[t], n))
        if not parts:
            continue
        h, c, doc, tag, start, n = (np.concatenate(x) for x in zip(*parts))
        by = np.lexsort((doc, c, h))
        h, c, doc, tag, start, n = (x[by] for x in (h, c, doc, tag, start, n))
        smaller, several, contents = judge(h, c, doc, np.zeros(len(h), bool))
        kind = np.where(smaller, GONE, np.where(several & contents, NEXT, MEET))
        # one mark for a gram that several documents of the batch hold in several contents
        marks = np.flatnonzero(groups(h) & several & contents)
        key = np.where(kind == MEET, h, c)          # what does not meet only passes through
        yield batch_of(_ROWS, np.concatenate([key, h[marks]]), np.concatenate([c, c[marks]]),
                       np.concatenate([doc, doc[marks]]), np.concatenate([tag, tag[marks]]),
                       np.concatenate([place(start, n, kind), np.full(len(marks), MARK)]))


def meet_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram, content and document: what is removed or goes on.

    A gram has at most a few rows per batch of the level before, so its rows
    fit together.
    """
    held = [np.zeros(0, np.int64)] * 5

    def out(h, c, doc, tag, p) -> pa.RecordBatch:
        kind = p & 3
        through = kind < MEET
        m = ~through
        h, c, doc_m, tag_m, pm = h[m], c[m], doc[m], tag[m], p[m]
        mark = (pm & 3) == MARK
        smaller, several, contents = judge(h, c, doc_m, mark)
        gone, nxt = ~mark & smaller, ~mark & ~smaller & several & contents
        return batch_of(_PLACES, np.concatenate([doc[through], doc_m[gone], doc_m[nxt]]),
                        np.concatenate([tag[through], tag_m[gone], tag_m[nxt]]),
                        np.concatenate([p[through], pm[gone] & ~3 | GONE, pm[nxt] & ~3 | NEXT]))

    for b in batches:
        cols = [np.concatenate([x, b.column(k).to_numpy()]) for x, k in zip(held, _ROWS.names)]
        whole = int(np.searchsorted(cols[0], cols[0][-1], "left")) if len(cols[0]) else 0
        held = [x[whole:] for x in cols]
        if whole:
            yield out(*(x[:whole] for x in cols))
    if len(held[0]):
        yield out(*held)


def second_level(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Surviving windows as runs by their smallest gram of twice ``FIRST`` words,
    with the names of the windows at the next length."""
    for b in batches:
        for s in slices(b):
            w = Words(s.column("text").to_pylist())
            lists = s.column("places")
            of = np.repeat(np.arange(s.num_rows), lists.value_lengths().to_numpy())
            p = lists.flatten().to_numpy()
            start, n, kind = unplace(p)
            doc, tag = s.column("doc").to_numpy(), s.column("tag").to_numpy()
            gone = kind == GONE
            i = np.flatnonzero(~gone)
            n_i = n[i]
            win = np.repeat(start[i] + w.first[of[i]], n_i) + (np.arange(n_i.sum()) - np.repeat(np.cumsum(n_i) - n_i, n_i))
            text = np.repeat(of[i], n_i)
            by = np.unique(win, return_index=True)[1]
            win, text = win[by], text[by]
            low = sliding_min(grams(w.hash, 2 * FIRST), length - 2 * FIRST + 1)
            name = grams(w.hash, length)
            at, size = run_table(low[win], win, text) if len(win) else (np.zeros(0, np.int64),) * 2
            t = text[at]
            raw = name[win].tobytes()
            names = [raw[8 * a:8 * (a + k)] for a, k in zip(at.tolist(), size.tolist())]
            g = of[gone]
            spread = mix(mix(p[gone].view(U), doc[g].view(U)), tag[g].view(U))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([low[win[at]], spread]).view(np.int64)),
                pa.array(np.concatenate([doc[t], doc[g]])),
                pa.array(np.concatenate([tag[t], tag[g]])),
                pa.array(np.concatenate([place(win[at] - w.first[t], size, MEET), p[gone]])),
                pa.array([*names, *[None] * int(gone.sum())], pa.binary())], names=_RUNS.names)


def meet_second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by gram and document: the windows of grams that several
    documents hold go on to the full length, a row per window."""
    known = None                                  # a gram already seen in two documents
    held: pa.Table | None = None                  # rows of the last gram, all of one document

    def windows(t: pa.Table) -> pa.RecordBatch | None:
        through = t.filter(pa.compute.is_null(t["names"]))
        t = t.filter(pa.compute.is_valid(t["names"]))
        h, doc, tag, p = (t[c].to_numpy() for c in ("h", "doc", "tag", "place"))
        start, n, _ = unplace(p)
        name = np.frombuffer(b"".join(t["names"].to_pylist()), U)
        own = np.repeat(np.arange(len(n)), n)
        start = start[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        h, doc, tag = h[own], doc[own], tag[own]
        by = np.lexsort((doc, h, name))
        name, h, doc, tag, start = (x[by] for x in (name, h, doc, tag, start))
        at = np.flatnonzero(groups(name, h))
        smaller = doc > doc[at][np.cumsum(groups(name, h)) - 1] if len(at) else np.zeros(0, bool)
        kind = np.where(smaller, GONE, MEET)
        pd, pt, pp = (through[c].to_numpy() for c in ("doc", "tag", "place"))
        return batch_of(_ROWS, np.concatenate([name.view(np.int64), (pp * 31 + pd) ^ pt]), np.concatenate([h, pd]),
                        np.concatenate([doc, pd]), np.concatenate([tag, pt]), np.concatenate([place(start, 1, kind), pp]))

    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t]).combine_chunks()
        h, doc, p = (t["h"].to_numpy(), t["doc"].to_numpy(), t["place"].to_numpy())
        if not len(h):
            continue
        new = groups(h)
        at = np.flatnonzero(new)
        meets = (p & 3) == MEET
        # passing rows may stand between the runs of a gram; they do not count as documents
        lo = np.minimum.reduceat(np.where(meets, doc, np.iinfo(np.int64).max), at)
        hi = np.maximum.reduceat(np.where(meets, doc, np.iinfo(np.int64).min), at)
        several = (lo < hi) | (np.array([known is not None]) & (h[at] == (known or 0)))
        several_row = several[np.cumsum(new) - 1]
        last = int(at[-1])
        open_end = not several[-1]
        keep = several_row | ~meets
        if open_end:
            keep[last:] = ~meets[last:]
            held = t.slice(last).filter(pa.array(meets[last:]))
            known = None
        else:
            held, known = None, int(h[-1])
        yield windows(t.filter(pa.array(keep)))


def meet_full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows sorted by name, gram and document: those of a larger document than the first are removed."""
    state = (0, 0, 0, False)
    for b in batches:
        name, h, doc, tag, p = (b.column(c).to_numpy() for c in _ROWS.names)
        meets = (p & 3) == MEET
        through = [x[~meets] for x in (doc, tag, p)]
        name, h, doc, tag, p = (x[meets] for x in (name, h, doc, tag, p))
        gone = np.zeros(len(name), bool)
        if len(name):
            new = groups(name, h)
            least = doc[np.flatnonzero(new)]
            if state[3] and (name[0], h[0]) == state[:2]:
                least[0] = state[2]
            least_row = least[np.cumsum(new) - 1]
            gone = doc > least_row
            state = (name[-1], h[-1], least_row[-1], True)
        yield batch_of(_PLACES, *(np.concatenate(x) for x in zip(through, (doc[gone], tag[gone], p[gone] & ~3 | GONE))))


def gathered(places: DataFrame) -> DataFrame:
    return places.groupBy("doc", "tag").agg(F.collect_set("place").alias("places"))


_SPAN_LIST = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_SPANS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("spans", _SPAN_LIST)])
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def spans_of(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Maximal runs of words that a document's windows cover."""
    for b in batches:
        out = []
        for places in b.column("places").to_pylist():
            start, n, _ = unplace(np.array(places, np.int64))
            by = np.argsort(start)
            a, z = start[by], np.maximum.accumulate((start + n - 1 + length)[by])
            new = np.flatnonzero(np.append(True, a[1:] > z[:-1]))
            out.append([{"start": x, "end": y} for x, y in zip(a[new].tolist(), z[np.append(new[1:], len(z)) - 1].tolist())])
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("tag"), pa.array(out, _SPAN_ARROW)], names=_SPANS.names)


KEPT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                     T.StructField("spans", _SPAN_LIST), T.StructField("kept", T.StringType())])
_KEPT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", _SPAN_ARROW), ("kept", pa.string())])


def tagged(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, tag, text``: the id, the id without nulls, what tells its texts apart."""
    return common.tagged(docs).select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "tag", "text")


def repeated(d: DataFrame, length: int = 13) -> DataFrame:
    """``doc, tag, spans`` of ``tagged`` texts: maximal runs of words that windows of
    ``length`` words cover which also start in a document with a smaller id."""
    if not 2 * FIRST <= length <= MOST:
        raise ValueError(f"needs {2 * FIRST} <= length <= {MOST}")
    one = (d.select("doc", "tag", "text").mapInArrow(lambda x: first_level(x, length), _ROWS)
           .repartition("h").sortWithinPartitions("h", "c", "doc").mapInArrow(meet_first, _PLACES))
    two = (d.join(gathered(one), ["doc", "tag"]).select("doc", "tag", "text", "places")
           .mapInArrow(lambda x: second_level(x, length), _RUNS)
           .repartition("h").sortWithinPartitions("h", "doc").mapInArrow(meet_second, _ROWS))
    full = two.repartition("h").sortWithinPartitions("h", "c", "doc").mapInArrow(meet_full, _PLACES)
    return gathered(full).mapInArrow(lambda x: spans_of(x, length), _SPANS)


def dedup(docs: DataFrame, length: int = 13, max_broadcast: int = 200_000) -> DataFrame:
    """Remove every word that a window of ``length`` words covers whose words
    also start in a document with a smaller id.

    Words are runs of other characters than blank, tab and line or page ends,
    unchanged. Windows are judged on the input. Returns a row per row of
    ``docs``: ``doc_id``, ``n_words``, ``spans`` (maximal removed runs of words,
    start and end) and ``kept``, the words left over joined by one blank.
    Null and empty texts have no words; rows with equal ids, equal texts
    included, remove nothing from each other; a null id is smaller than every
    other; an empty table gives an empty result. The spans of at most
    ``max_broadcast`` documents are sent to where the texts are read; those of
    more are joined by a shuffle.
    """
    texts = tagged(docs)
    spans = materialise(repeated(texts, length), "word-spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b):
                out = []
                for r in s.to_pylist():
                    words, found = r["text"].encode().split(), r["spans"] or []
                    begin = [0, *(x["end"] for x in found)]
                    kept = [w for a, z in zip(begin, [*(x["start"] for x in found), len(words)]) for w in words[a:z]]
                    out.append({"doc_id": r["doc_id"], "n_words": len(words), "kept": b" ".join(kept).decode(), "spans": found})
                yield pa.RecordBatch.from_pylist(out, schema=_KEPT_ARROW)

    return (texts.join(small(spans, max_broadcast), ["doc", "tag"], "left")
            .select("doc_id", "text", "spans").mapInArrow(remove, KEPT))
