"""Personal data: base rules, and a linear-chain conditional random field.

The base rules are four patterns with checks. The field labels the words of a
text as outside or as begin or inside of a kind; its features are word shapes
(length, digits, separators, first and last character) of a word and its two
neighbours. It is trained on a small labelled table: a few fixed lines in
formats that the base rules leave out, and a bounded sample of documents
labelled by the base rules. Its spans are added where no base span lies.

Words are never looped over in Python: a batch of texts is one array of code
points, shapes are array expressions over it, and Viterbi decoding runs over
all texts of a batch side by side, one position a step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import keyed, whole_text

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]         # start, kind, end

# Labelled lines. [kind text] marks a span.
LINES = """
call [phone (042) 555-7845] today
my number is [phone 042-555-7845] or write
phone [phone 555-7845] after six
reach me at [phone +1 (042) 555-7845] please
tel [phone 1 (609) 555-7932] at home
ring [phone (888) 555-6841], ask for me
fax: [phone 042-555-0199].
mail [email ann.lee@mailhost] for it
write to [email bo_77@intranet] soon
contact [email ann.lee@mail.example.com] or [phone (042) 555-0100]
from [ip 10.0.0.7] to [ip 192.168.10.254] at noon
the card [card 4111 1111 1111 1111] was used
the price of 1200 was paid in 1999 and 2004
chapter 12, verse 7. page 1024
version 2.0 of the license, section 3.1.4
order 6791628068594162 of the list
token = "908038b7daaf91e730d2f64001c52934d43d9336" here
see 12-14 and (3) and 45% of 300
a + b = c and x @ y
the of and to in that it is was for on are as with
"""


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def passes(kind: int, found: str) -> bool:
    """The check that a span of the kind has to pass, whoever found it."""
    digits = sum("0" <= c <= "9" for c in found)
    if kind == 0:
        name, _, host = found.partition("@")
        return bool(name and host)
    if kind == 1:
        parts = found.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p) <= 255 for p in parts)
    if kind == 2:
        return 14 <= digits <= 19 and luhn("".join(c for c in found if "0" <= c <= "9"))
    return 7 <= digits <= 15


def words_with(text: str, char: str) -> Iterator[tuple[int, int]]:
    """White-space delimited words of the text that hold ``char``."""
    at = text.find(char)
    while at >= 0:
        a = at
        while a and not text[a - 1].isspace():
            a -= 1
        z = at
        while z < len(text) and not text[z].isspace():
            z += 1
        yield a, z
        at = text.find(char, z)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by start, then kind."""
    out: list[Span] = []
    for a, z in words_with(text, "@"):          # an address holds no white space
        out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text, a, z)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# --- word shapes -----------------------------------------------------------

#: Characters that may enclose a word without being part of it.
TRIM = "\"'.,;:!?()[]{}<>|*%$#&=/\\"
_CLASSES = 8            # letter, digit, @, dot, dash, plus, bracket, other
_BLANK = 8
_CLASS = np.full(256, 7, np.uint8)
_CLASS[[c for c in range(256) if c > 127 or chr(c).isalpha()]] = 0
_CLASS[[ord(c) for c in "0123456789"]] = 1
for _i, _chars in enumerate(("@", ".", "-_", "+", "()"), 2):
    _CLASS[[ord(c) for c in _chars]] = _i
_CLASS[[ord(c) for c in " \t\n\x0b\x0c\r\x85\xa0"]] = _BLANK
_SOFT = np.zeros(256, bool)
_SOFT[[ord(c) for c in TRIM]] = True
_LENGTHS = np.array([2, 3, 4, 5, 7, 9, 13, 14, 17, 20])
_DOTS, _DIGITS = 4, 5
#: Radix of each part of a shape: length, digits, dots, dashes, at signs, first and last class.
RADIX = (len(_LENGTHS) + 1, _DIGITS, _DOTS, 3, 2, _CLASSES, _CLASSES)
N_SHAPES = int(np.prod(RADIX))
TAGS = 1 + 2 * len(KINDS)


class Words:
    """Words of a batch of texts as arrays: their text, place and shape."""

    def __init__(self, texts: list[str]):
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = " ".join(texts) + " "
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        cp = np.minimum(cp, 255).astype(np.uint8)
        cls = _CLASS[cp]
        self.offset = np.concatenate([[0], np.cumsum(lens + 1)[:-1]]) if len(texts) else np.zeros(0, np.int64)
        edge = np.flatnonzero(np.diff(np.concatenate([[1], cls == _BLANK, [1]]).astype(np.int8)))
        self.start, self.end = edge[::2].copy(), edge[1::2].copy()
        self.text = np.searchsorted(self.offset, self.start, "right") - 1
        self._trim(cp, cls)
        self.shape = self._shapes(cls)

    def _trim(self, cp: np.ndarray, cls: np.ndarray) -> None:
        """Moves starts and ends over enclosing characters; a bracket that belongs to a number stays."""
        left = np.arange(len(self.start))
        for _ in range(4):
            a = self.start[left]
            left = left[(self.end[left] - a > 1) & _SOFT[cp[a]]]
            a = self.start[left]
            left = left[~((cp[a] == ord("(")) & (cls[a + 1] == 1))]
            self.start[left] += 1
        left = np.arange(len(self.start))
        for _ in range(4):
            z = self.end[left] - 1
            left = left[(z > self.start[left]) & _SOFT[cp[z]]]
            z, a = self.end[left] - 1, self.start[left]
            left = left[~((cp[z] == ord(")")) & (cls[z - 1] == 1) & (cp[a] == ord("(")))]
            self.end[left] -= 1

    def _shapes(self, cls: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.int32)
        # letters and blanks are nearly all characters: count the others only
        at = np.flatnonzero((cls != 0) & (cls != _BLANK))
        of = np.searchsorted(self.start, at, "right") - 1
        inside = (of >= 0) & (at < self.end[np.maximum(of, 0)])
        of, kind = of[inside], cls[at[inside]]

        def count(k: int) -> np.ndarray:
            return np.bincount(of[kind == k], minlength=len(self.start))

        n = self.end - self.start
        digits, dots = count(1), np.minimum(count(3), _DOTS - 1)
        share = np.where(digits == 0, 0, np.where(digits == n, 4, 1 + np.minimum(digits * 3 // n, 2)))
        parts = (np.searchsorted(_LENGTHS, n, "right"), share, dots, np.minimum(count(4), 2),
                 np.minimum(count(2), 1), cls[self.start], cls[self.end - 1])
        out = np.zeros(len(n), np.int64)
        for p, r in zip(parts, RADIX):
            out = out * r + p
        return out.astype(np.int32)

    def spans_of(self, tags: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, kind, start and end of the runs that the tags mark."""
        kind = (tags - 1) // 2                       # -1 outside
        goes_on = np.zeros(len(tags), bool)
        if len(tags) > 1:
            goes_on[1:] = ((tags[1:] > 0) & (tags[1:] % 2 == 0) & (kind[1:] == kind[:-1])
                           & (self.text[1:] == self.text[:-1]))
        first = np.flatnonzero((tags > 0) & ~goes_on)
        if not len(first):
            return (np.zeros(0, np.int64),) * 4
        run = np.cumsum((tags > 0) & ~goes_on) - 1
        last = np.zeros(len(first), np.int64)
        on = np.flatnonzero(tags > 0)
        np.maximum.at(last, run[on], on)
        t = self.text[first]
        return t, kind[first], self.start[first] - self.offset[t], self.end[last] - self.offset[t]


# --- the field -------------------------------------------------------------

def factors(shape: np.ndarray) -> np.ndarray:
    """Indices of the parts of each shape and of the whole, in one weight table."""
    rest, parts, base = shape.astype(np.int64), [], 0
    for r in reversed(RADIX):
        parts.append(rest % r)
        rest //= r
    cols = []
    for p, r in zip(parts, reversed(RADIX)):
        cols.append(base + p)
        base += r
    cols.append(base + shape)
    return np.stack(cols, 1)


N_FACTORS = sum(RADIX) + N_SHAPES
#: A neighbour that is not there.
NONE = N_SHAPES


class Field:
    """Weights of the field as tables by shape, for a word and its neighbours."""

    def __init__(self, own: np.ndarray, prev: np.ndarray, nxt: np.ndarray, step: np.ndarray):
        self.own, self.prev, self.nxt, self.step = own, prev, nxt, step

    def decode(self, shape: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Best tags of every text (Viterbi), all texts side by side.

        A word whose emissions leave every other tag further behind outside than
        the transitions on both its sides could make up is outside on the best
        path. Chains are cut there: the result is the same and most steps are
        saved.
        """
        n = len(shape)
        tags = np.zeros(n, np.int8)
        if not n:
            return tags
        before, after = neighbours(shape, text)
        gain = (self.step - self.step[:, :1]).max(0) + (self.step - self.step[:1]).max(1)   # of a tag, at most
        behind = lambda table, by=0.0: (table[:, :1] - table[:, 1:] - by).min(1)              # noqa: E731
        plain = (behind(self.own, gain[1:])[shape] + behind(self.prev)[before] + behind(self.nxt)[after]) > 1e-3
        idx = np.flatnonzero(~plain)
        if not len(idx):
            return tags
        new = np.ones(len(idx), bool)
        new[1:] = (np.diff(idx) != 1) | (text[idx[1:]] != text[idx[:-1]])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(idx)))
        e = self.own[shape[idx]] + self.prev[before[idx]] + self.nxt[after[idx]]
        # a cut neighbour is outside: its transitions still count
        cut_before = new & (idx > 0) & (text[np.maximum(idx - 1, 0)] == text[idx])
        e[cut_before] += self.step[0]
        last = np.append(head[1:], len(idx)) - 1
        nxt_at = np.minimum(idx[last] + 1, n - 1)
        cut_after = (idx[last] + 1 < n) & (text[nxt_at] == text[idx[last]])
        e[last[cut_after]] += self.step[:, 0]
        order = np.argsort(-size, kind="stable")
        head, size = head[order], size[order]
        back = np.zeros((len(idx), TAGS), np.int8)
        best = e[head]
        final = np.zeros((len(head), TAGS), np.float32)
        steps = int(size[0])
        live = np.searchsorted(-size, -np.arange(1, steps + 1), "right")      # chains longer than t
        for t in range(1, steps):
            k = live[t]
            if k < len(best):
                final[k:len(best)] = best[k:]
                best = best[:k]
            through = best[:, :, None] + self.step[None]
            back[head[:k] + t] = through.argmax(1)
            best = through.max(1) + e[head[:k] + t]
        final[:len(best)] = best
        now = final.argmax(1).astype(np.int8)
        out = np.zeros(len(idx), np.int8)
        for t in range(steps - 1, -1, -1):
            k = live[t]
            at = head[:k] + t
            out[at] = now[:k]
            now[:k] = back[at, now[:k]]
        tags[idx] = out
        return tags


def neighbours(shape: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before, after = np.full(len(shape), NONE, np.int32), np.full(len(shape), NONE, np.int32)
    same = text[1:] == text[:-1]
    before[1:][same] = shape[:-1][same]
    after[:-1][same] = shape[1:][same]
    return before, after


def tags_of(words: Words, spans: list[list[Span]]) -> np.ndarray:
    """Begin and inside tags of the words that the spans cover."""
    tags = np.zeros(len(words.start), np.int8)
    first = np.searchsorted(words.text, np.arange(len(spans) + 1))
    for t, found in enumerate(spans):
        a, z = first[t], first[t + 1]
        start, end = words.start[a:z] - words.offset[t], words.end[a:z] - words.offset[t]
        for s, kind, e in found:
            inside = np.flatnonzero((start < e) & (end > s))
            tags[a + inside] = 2 + 2 * kind
            if len(inside):
                tags[a + inside[0]] = 1 + 2 * kind
    return tags


def train(texts: list[str], spans: list[list[Span]], rounds: int = 60, rate: float = 0.4,
          ridge: float = 2e-3) -> Field:
    """Maximum likelihood by forward-backward and Adagrad over all texts at once."""
    w = Words(texts)
    gold = tags_of(w, spans).astype(np.int64)
    own = factors(w.shape)
    before, after = neighbours(w.shape, w.text)
    pad = factors(np.arange(N_SHAPES))
    pad = np.vstack([pad, np.full(pad.shape[1], N_FACTORS)])                  # NONE has a weight of its own
    cols = [own, pad[before] + (N_FACTORS + 1), pad[after] + 2 * (N_FACTORS + 1)]
    feats = np.concatenate(cols, 1)
    theta = np.zeros((3 * (N_FACTORS + 1), TAGS))
    step = np.zeros((TAGS, TAGS))
    g2, s2 = np.full_like(theta, 1e-6), np.full_like(step, 1e-6)
    head = np.flatnonzero(np.append(True, w.text[1:] != w.text[:-1]))
    size = np.diff(np.append(head, len(gold)))
    order = np.argsort(-size, kind="stable")
    head, size = head[order], size[order]
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
    n, rows = len(gold), feats.ravel()
    pair = np.flatnonzero(w.text[1:] == w.text[:-1])
    seen_step = np.zeros_like(step)
    np.add.at(seen_step, (gold[pair], gold[pair + 1]), 1)
    onehot = np.eye(TAGS)[gold]
    for _ in range(rounds):
        e = theta[feats].sum(1)
        fwd, bwd = np.zeros((n, TAGS)), np.zeros((n, TAGS))
        fwd[head] = e[head]
        for t in range(1, len(live)):
            at = head[:live[t]] + t
            x = fwd[at - 1][:, :, None] + step
            m = x.max(1)
            fwd[at] = m + np.log(np.exp(x - m[:, None]).sum(1)) + e[at]
        for t in range(len(live) - 1, 0, -1):
            at = head[:live[t]] + t
            x = step + (e[at] + bwd[at])[:, None, :]
            m = x.max(2)
            bwd[at - 1] = m + np.log(np.exp(x - m[:, :, None]).sum(2))
        p = fwd + bwd
        top = p.max(1, keepdims=True)
        z = top + np.log(np.exp(p - top).sum(1, keepdims=True))
        p = np.exp(p - z)
        both = np.exp(fwd[pair][:, :, None] + step + (e[pair + 1] + bwd[pair + 1])[:, None, :] - z[pair][:, :, None])
        diff = np.repeat(onehot - p, feats.shape[1], 0)
        g = np.stack([np.bincount(rows, diff[:, k], len(theta)) for k in range(TAGS)], 1) - ridge * n * 1e-2 * theta
        gs = seen_step - both.sum(0) - ridge * n * 1e-2 * step
        g2 += g * g
        s2 += gs * gs
        theta += rate * g / np.sqrt(g2)
        step += rate * gs / np.sqrt(s2)
    table = [np.vstack([theta[pad[:-1] + k * (N_FACTORS + 1)].sum(1), theta[k * (N_FACTORS + 1) + N_FACTORS] * pad.shape[1]])
             .astype(np.float32) for k in range(3)]
    return Field(*table, step.astype(np.float32))


def fixed_lines() -> tuple[list[str], list[list[Span]]]:
    """The labelled lines without their marks, and their spans."""
    texts, spans = [], []
    for line in LINES.strip().split("\n"):
        out, found, at = "", [], 0
        for m in re.finditer(r"\[(\w+) ([^]]*)\]", line):
            out += line[at:m.start()]
            found.append((len(out), KINDS.index(m[1]), len(out) + len(m[2])))
            out += m[2]
            at = m.end()
        texts.append(out + line[at:])
        spans.append(found)
    return texts, spans


def fit(docs: DataFrame, max_rows: int = 300, max_chars: int = 50_000, window: int = 60, repeat: int = 6) -> Field:
    """Train on the fixed lines (each ``repeat`` times) and at most ``max_rows``
    documents with digits or at signs, chosen by a hash of the text among those of at most
    ``max_chars`` characters and labelled by the base rules; of a document, all its
    words within ``window`` characters of digits and at signs are used."""
    held = (docs.select(whole_text().alias("text")).filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= max_chars))
            .withColumn("h", F.xxhash64("text")))
    # the texts themselves are looked up by the largest hash chosen, so no task sends more than hashes
    last = held.select("h").distinct().orderBy("h").limit(max_rows).agg(F.max("h")).first()[0]
    rows = held.filter(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").collect() if last is not None else []
    texts, spans = [], []
    for r in rows:
        found = base_spans(r["text"])
        for a, z in cuts(r["text"], window):
            texts.append(r["text"][a:z])
            spans.append([(s - a, k, e - a) for s, k, e in found if a <= s and e <= z])
    lines, marks = fixed_lines()
    return train(texts + lines * repeat, spans + marks * repeat)


def cuts(text: str, window: int) -> list[tuple[int, int]]:
    """All pieces of a text around its digits and at signs."""
    out: list[tuple[int, int]] = []
    for m in re.finditer(r"\S*[0-9@]\S*", text):
        a, z = max(0, m.start() - window), min(len(text), m.end() + window)
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("th", T.LongType()),
    *(T.StructField(c, T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType())]))) for c in ("base", "added")),
])
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def added_spans(field: Field, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """What the field finds beside the base spans."""
    w = Words(texts)
    out: list[list[Span]] = [[] for _ in texts]
    for t, kind, s, e in zip(*(x.tolist() for x in w.spans_of(field.decode(w.shape, w.text)))):
        if passes(kind, texts[t][s:e]) and all(e <= bs or s >= be for bs, _, be in base[t]):
            out[t].append((s, kind, e))
    return out


def find(docs: DataFrame, field: Field, batch_chars: int = 4 << 20) -> DataFrame:
    """``doc_id, th, base, added`` of every row: arrays of kind, start and end
    (code points, end exclusive), by start and then kind.

    Null and empty texts have no spans; repeated rows each get a row; a null id
    stays null; an empty table gives an empty result. A span the field adds
    never overlaps a base span of any kind and passes the check of its own.
    """
    from kinship.llm.token_counts import balanced

    def rows(spans: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in spans], pa.list_(_SPAN))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, added = [], []
            for group in balanced(b.column("text").to_pylist(), batch_chars):
                found = [base_spans(t) for t in group]
                base += found
                added += added_spans(field, group, found)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), rows(base), rows(added)],
                                             names=FOUND.names)

    return keyed(docs).mapInArrow(run, FOUND)
