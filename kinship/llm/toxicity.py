"""Toxicity by a weighted finite-state pattern grammar.

A text is read clause by clause. Every word belongs to one class of the
grammar: insult, threat, target, negation, reported speech, or none. Insults
are a weighted lexicon of words and word beginnings learned from labelled
rows; the other classes are short fixed lists. Small transducers rewrite the
class string of a clause one after the other (negation, then reported speech,
then target) and are composed into a single machine; what it emits are matched
clauses such as "insult", "insult at a target", "negated threat". A document's
matches of each kind, with their weights, give its score through a logistic
model that is fitted on the same labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import keyed, lean, materialise

# The closed classes of the grammar, in English, German, French and Spanish.
TARGETS = "you your yours yourself u they them he she him her du dich dir ihr euch sie tu toi vous te ti usted ustedes".split()
NEGATIONS = "not never no neither nor nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco".split()
REPORTS = "said says told wrote claimed called quoted quote sagte schrieb nannte disait écrit dijo escribió llamó".split()
THREATS = "kill hurt destroy beat burn shoot stab töten schlagen tuer frapper matar golpear".split()

INSULT, THREAT, TARGET, NEGATION, REPORT = "ITYNR"
WORD = re.compile(r"[^\W\d_]+|[.!?;:\n]")
PREFIXES = range(3, 9)
#: A word beginning that clean texts also hold by chance may still mark a text that repeats it so often.
REPEATED = 3
#: What the machine emits for a match: i/t insult or threat, then how it is meant.
KINDS = ("i", "t", "i-neg", "t-neg", "i-rep", "t-rep", "i-at", "t-at")

Machine = dict[tuple[int, str], tuple[int, str]]


def scope(opener: str, mark: str, passes: str) -> Machine:
    """After ``opener``, insults and threats of the clause carry ``mark``."""
    m: Machine = {}
    for q, s in product((0, 1), passes):
        m[q, s] = (q, s)
    for q in (0, 1):
        m[q, opener] = (1, "")
        for base in (INSULT, THREAT):
            m[q, base] = (q, mark + base if q else base)
    return m


def targeting() -> Machine:
    """A target before or after a plain match of the clause makes it a match at a target."""
    m: Machine = {}
    for q in (0, 1, 2, 3):      # bit 1: target seen; bit 2: a plain match stands before
        m[q, TARGET] = (q | 1, "@" if q & 2 else "")
        for base in (INSULT, THREAT):
            m[q, base] = (q | 2, "@" + base if q & 1 else base)
            for mark in "nr":
                m[q, mark + base] = (q, mark + base)
    return m


def compose(a: Machine, b: Machine) -> dict[tuple[tuple[int, int], str], tuple[tuple[int, int], str]]:
    """The machine that reads what ``a`` reads and emits what ``b`` makes of a's output."""
    inner = {q for q, _ in b}
    out = {}
    for ((qa, s), (ra, mid)), qb in product(a.items(), inner):
        if not mid:
            out[(qa, qb), s] = ((ra, qb), "")
        elif (qb, mid) in b:
            rb, emitted = b[qb, mid]
            out[(qa, qb), s] = ((ra, rb), emitted)
    return out


def flat(m) -> Machine:
    """The states of a composed machine as integers, its start as 0."""
    ids = {q: i for i, q in enumerate(sorted({q for q, _ in m}))}
    return {(ids[q], s): (ids[r], o) for (q, s), (r, o) in m.items()}


@lru_cache(maxsize=1)
def grammar() -> Machine:
    rep = scope(REPORT, "r", TARGET)
    for q, base in product((0, 1), (INSULT, THREAT)):
        rep[q, "n" + base] = (q, "n" + base)        # what is negated stays so inside speech
    return flat(compose(flat(compose(scope(NEGATION, "n", TARGET + REPORT), rep)), targeting()))


KIND_OF = {INSULT: "i", THREAT: "t", "n" + INSULT: "i-neg", "n" + THREAT: "t-neg",
           "r" + INSULT: "i-rep", "r" + THREAT: "t-rep", "@" + INSULT: "i-at", "@" + THREAT: "t-at", "@": "i-at"}


def read_clause(symbols: str, weights: list[float]) -> dict[str, float]:
    """Weight of each kind of match in a clause of class symbols."""
    m, q, out, w = grammar(), 0, {}, iter(weights)
    last = 0.0
    for s in symbols:
        q, emitted = m[q, s]
        if s in (INSULT, THREAT):
            last = next(w)
        if emitted:
            k = KIND_OF[emitted]
            out[k] = out.get(k, 0.0) + last
    return out


class Model(NamedTuple):
    """Lexicon of insults (``^`` marks a word beginning) and the logistic weights."""

    lexicon: dict[str, float]
    bias: float
    weights: tuple[float, ...]


class Reader:
    """Splits texts into clauses and reads their matches; caches the class of words."""

    def __init__(self, lexicon: dict[str, float], keep: int = 200_000):
        self.lexicon, self.keep = lexicon, keep
        self.fixed = {w: c for ws, c in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT),
                                         (THREATS, THREAT)) for w in ws}
        self.known: dict[str, tuple[str, float]] = {}

    def word(self, w: str) -> tuple[str, float]:
        if w in ".!?;:\n":
            return ".", 0.0
        weight = max([self.lexicon.get(w, 0.0), *(self.lexicon.get("^" + w[:k], 0.0)
                                                  for k in PREFIXES if len(w) > k)])
        if weight > 0:
            return INSULT, weight
        c = self.fixed.get(w, "")
        return c, 1.0

    def features(self, text: str) -> list[float]:
        """``log(1 + weight)`` of every kind of match over the whole text."""
        known = self.known
        if len(known) > self.keep:
            known.clear()
        symbols, weights, total = [], [], dict.fromkeys(KINDS, 0.0)

        def close():
            if weights:
                for k, v in read_clause("".join(symbols), weights).items():
                    total[k] += v
            symbols.clear()
            weights.clear()

        for w in WORD.findall(text.lower()):
            got = known.get(w)
            if got is None:
                got = known[w] = self.word(w)
            c = got[0]
            if not c:
                continue
            if c == ".":
                if symbols:
                    close()
                continue
            symbols.append(c)
            if c == INSULT or c == THREAT:
                weights.append(got[1])
        close()
        return [math.log1p(total[k]) for k in KINDS]


def held_out_expr() -> F.Column:
    """True for rows whose crc32(doc_id as text) mod 4 is 2; a null id is not held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``text, toxic`` of at most ``max_rows`` labelled ids outside the held-out
    part, chosen by a hash of the id; an id labelled both ways counts as toxic."""
    chosen = (labels.filter(~held_out_expr() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # at most max_rows pairs of numbers: small enough to broadcast whatever the tables hold
    return keyed(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic").distinct()


COUNTS = T.StructType([T.StructField("feature", T.StringType()), T.StructField("toxic", T.IntegerType()),
                       T.StructField("n", T.LongType())])
HITS = T.StructType([T.StructField("features", T.ArrayType(T.StringType())), T.StructField("toxic", T.IntegerType())])
POINTS = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("toxic", T.IntegerType())])


def word_features(text: str) -> set[str]:
    """Words, word beginnings (``^``) and what is repeated of both (``+``)."""
    n: Counter = Counter()
    for w, k in Counter(WORD.findall(text.lower())).items():
        if len(w) > 1:
            n[w] += k
            for j in PREFIXES:
                if len(w) > j:
                    n["^" + w[:j]] += k
    return {*n, *("+" + f for f, k in n.items() if k >= REPEATED)}


def learn_lexicon(rows: DataFrame, max_candidates: int, min_docs: int, min_gain: float) -> dict[str, float]:
    """Words and word beginnings that mark toxic rows, strongest first, each
    kept only if it explains rows that the stronger ones do not.

    ``rows`` is the bounded sample; the candidates are the ``max_candidates``
    with the best log odds (less two standard errors) that ``min_docs`` toxic
    rows hold.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):            # few rows at once: features are many
                part = b.slice(at, 200)
                seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
                for t, y in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    seen[1 if y else 0].update(word_features(t))
                for y, n in seen.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(n), pa.string()), pa.array([y] * len(n), pa.int32()),
                         pa.array(list(n.values()), pa.int64())], names=COUNTS.names)

    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return {}
    k, b = F.col("k") + 0.5, F.col("b") + 0.5
    best = (rows.mapInArrow(lean(count), COUNTS).groupBy("feature")
            .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("k"),
                 F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
            .filter(F.col("k") >= min_docs)
            .withColumn("gain", F.log(k / (n1 + 1)) - F.log(b / (n0 + 1)) - 2 * F.sqrt(1 / k + 1 / b))
            .filter(F.col("gain") > min_gain)
            .orderBy(F.desc("gain"), F.length("feature"), "feature").limit(max_candidates)
            .collect())
    gain = {r["feature"]: r["gain"] for r in best}
    clear = {r["feature"] for r in best if r["b"] * 50 <= r["k"] and r["gain"] > 0.6 * best[0]["gain"]}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bt in batches:
            hits = [[f for f in word_features(t) if f in gain] for t in bt.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hits, pa.list_(pa.string())), bt.column("toxic").cast(pa.int32())], names=HITS.names)

    marked = [(set(r["features"]), r["toxic"]) for r in
              rows.mapInArrow(lean(mark), HITS).filter(F.size("features") > 0).collect()]
    holders: dict[str, set[int]] = {}
    for i, (fs, _) in enumerate(marked):
        for f in fs:
            holders.setdefault(f, set()).add(i)
    toxic = {i for i, (_, y) in enumerate(marked) if y}
    lexicon, left = {}, set(range(len(marked)))
    for f in gain:
        # what the entry explains of the rows that no stronger one has explained
        rest = holders.get(f, set()) & left
        hit = len(rest & toxic)
        enough = hit >= max(2, min_docs // 4) and hit >= 4 * (len(rest) - hit)
        if enough:
            left -= rest
        if enough or f in clear:          # clear: nearly as strong as the best, though found beside them
            weight = gain[f] / REPEATED if f[0] == "+" else gain[f]
            entry = f.removeprefix("+")
            lexicon[entry] = max(weight, lexicon.get(entry, 0.0))
    return lexicon


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> tuple[float, tuple[float, ...]]:
    """Ridge logistic regression by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), tuple(map(float, w[1:]))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, max_candidates: int = 4_000,
        min_docs: int = 8, min_gain: float = 1.0) -> Model:
    """Learn the lexicon and the weights of matched clauses from a bounded sample.

    Needs ``doc_id, text`` and ``doc_id, toxic``; rows without label and held-out
    rows take no part. Without labels of both values nothing is an insult and
    every score is one half, or the only label's share.
    """
    rows = materialise(training_rows(docs, labels, max_rows), "labelled")
    lexicon = learn_lexicon(rows, max_candidates, min_docs, min_gain)

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for b in batches:
            x = [reader.features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), b.column("toxic").cast(pa.int32())], names=POINTS.names)

    got = rows.mapInArrow(lean(points), POINTS).collect()
    if not got:
        return Model(lexicon, 0.0, (0.0,) * len(KINDS))
    x, y = np.array([r["x"] for r in got]), np.array([r["toxic"] for r in got], float)
    return Model(lexicon, *fit_logistic(x, y))


SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("th", T.LongType()),
                       T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id, th, held_out, score, predicted`` of every row.

    The score depends on the text alone. Null and empty texts hold no match
    and get the score of a text without matches; repeated rows each get a row;
    a null id counts as not held out; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, w = Reader(model.lexicon), np.array(model.weights)
        for b in batches:
            x = np.array([reader.features(t) for t in b.column("text").to_pylist()]).reshape(-1, len(KINDS))
            s = 1 / (1 + np.exp(-np.clip(x @ w + model.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(s, pa.float64())],
                                             names=SCORES.names)

    return (keyed(docs).mapInArrow(lean(run), SCORES)
            .select("doc_id", "th", held_out_expr().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def with_score(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """All columns of ``docs`` and the score of its ``text`` as ``column``; nothing is shuffled."""
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, w = Reader(model.lexicon), np.array(model.weights)
        for b in batches:
            x = np.array([reader.features(t or "") for t in b.column(at).to_pylist()]).reshape(-1, len(KINDS))
            s = 1 / (1 + np.exp(-np.clip(x @ w + model.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=schema.names)

    return docs.mapInArrow(lean(run), schema)
