"""N-gram Jaccard self-join by parity sketches.

A document is the set of its word shingles. The shingles are hashed to bits,
and each bit of the sketch is the parity of what falls on it, so the sketches
of two sets differ in at most as many bits as the sets in elements. Sets as
similar as asked for differ in at most ``d`` elements, ``d`` growing with
their sizes. Within a band of sizes sketches are cut into ``d + 1`` pieces:
one piece at least is the same in both. A piece that no shingle falls on is
the same in many sets for no reason, so there are some pieces to spare: a set
with at most so many empty pieces has another one in common with every set
like it, and does without its empty ones. Pieces are joined as keys; sets that
share one are compared by short sketches of all their shingles, and only those
that these do not rule out stay together. What is connected so is a candidate
cluster. Clusters are dealt in blocks to tasks that compare whole sketches and
verify what is left on the sets, element by element.

Equal sets are one class from the start, so copies cost one row; no pair of
documents is ever a row before it is verified, and a task reports no more
links than it needs to connect its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import keyed, lean, lower_ascii, materialise, small
from kinship.llm.graph import components
from kinship.llm.substring_dedup import Words, groups, slices
from kinship.llm.suffix_dedup import U, mix

_LONGEST = 1 << 40


class Bands:
    """Size bands: sets as similar as ``percent`` are in one band or in neighbouring ones."""

    def __init__(self, percent: int):
        self.percent = percent
        low = [1]
        while low[-1] < _LONGEST:
            low.append(max(low[-1] + 1, (low[-1] - 1) * 100 // percent + 1))
        self.low = np.array(low, np.int64)

    def differ(self, total):
        """Most elements in which sets of ``total`` elements together differ if they are similar."""
        return total * (100 - self.percent) // (100 + self.percent)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, "right") - 1

    def spare(self, band: np.ndarray) -> np.ndarray:
        """How many pieces more than needed the sketches of a band have: about
        twice as many as stay empty by chance."""
        need = self.differ(2 * (self.low[band + 1] - 1)) + 1
        return np.where(need > 1, np.ceil(2 * need * np.exp(-self.low[band] / need)).astype(np.int64) + 1, 0)

    def pieces(self, band: np.ndarray) -> np.ndarray:
        return self.differ(2 * (self.low[band + 1] - 1)) + 1 + self.spare(band)


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Elements of all sets, by text and value, and the text of each.

    A text with fewer than ``k`` words is one element, all of its words.
    """
    start, text = w.of_windows(k)
    h = w.hash
    g = h
    for j in range(1, k):
        g = mix(g[:-1], h[j:]) if len(g) > 1 else g[:0]
    value = g[start]
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        one = []
        for t in short.tolist():
            x = U(n[t])
            for v in h[w.first[t]:w.first[t + 1]]:
                x = mix(np.array([x]), np.array([v]))[0]
            one.append(x)
        value, text = np.concatenate([value, np.array(one, U)]), np.concatenate([text, short])
    by = np.lexsort((value, text))
    value, text = value[by], text[by]
    keep = groups(text, value)
    return value[keep], text[keep]


def sketch(value: np.ndarray, owner: np.ndarray, pieces: np.ndarray, wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Parity words of the sets one after the other, and where each set's begin.

    A word is one piece: the parities of 64 bits, or, if ``wide``, a name of
    the parities of as many bits as there are hashes: the XOR of the bits'
    numbers, the same in two sets if all parities are.
    """
    first = np.concatenate([[0], np.cumsum(pieces)])
    words = np.zeros(int(first[-1]), U)
    v = mix(value, value >> U(17))
    piece = ((v >> U(32)) * pieces[owner].astype(U) >> U(32)).astype(np.int64)
    np.bitwise_xor.at(words, first[owner] + piece, mix(v, value) if wide else U(1) << (v & U(63)))
    return words, first


_SETS = T.StructType([*(T.StructField(c, T.LongType()) for c in ("doc_id", "th", "n", "s1", "s2")),
                      T.StructField("bits", T.BinaryType())])
_SHARED = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "first", "s1")])
#: Words of the short sketch of a set of at most ``SHORT_OF`` elements; twice as many for twice as large sets.
SHORT, SHORT_OF = 8, 900
#: Sets of a key from which on it is dealt in blocks, and the most sets of a block.
GROUP, KEY_BLOCK = 512, 4096
#: About the bytes of elements that a task gives at once.
MEMBER_BYTES = 8 << 20
_KEYS = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "s1")])
_EDGES = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b")])
_MEMBERS = T.StructType([*(T.StructField(c, T.LongType()) for c in ("root", "i", "j", "block", "cid")),
                         T.StructField("items", T.BinaryType())])


def identity(value: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, ...]:
    """Sizes and two independent 64-bit sums of every set."""
    n = np.bincount(text, minlength=n_texts)
    out = [n]
    for salt in (U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)):
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(value ^ salt, value * salt))])
        end = np.cumsum(n)
        out.append((total[end] - total[end - n]).view(np.int64))
    return tuple(out)


def short_sketches(value: np.ndarray, text: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A sketch of each set, of a number of words (a power of two) that follows its size."""
    size = SHORT << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / SHORT_OF))).astype(np.int64)
    words, first = sketch(value, text, size)
    raw = words.tobytes()
    return [raw[8 * a:8 * z] for a, z in zip(first[:-1].tolist(), first[1:].tolist())]


class Sketches:
    """Short sketches of several sets, comparable over neighbouring sizes: the
    words of a larger one are folded in pairs to half their number."""

    def __init__(self, bits: list[bytes]):
        self.size = np.fromiter((len(b) // 8 for b in bits), np.int64, len(bits))
        self.rows, self.place = {}, {}
        for w in np.unique(self.size).tolist():
            own, twice = np.flatnonzero(self.size == w), np.flatnonzero(self.size == 2 * w)
            a = np.frombuffer(b"".join([bits[i] for i in own.tolist()]), U).reshape(-1, w)
            b = np.frombuffer(b"".join([bits[i] for i in twice.tolist()]), U).reshape(-1, w, 2)
            self.rows[w] = np.concatenate([a, b[:, :, 0] ^ b[:, :, 1]])
            place = np.full(len(bits), -1)
            place[np.concatenate([own, twice])] = np.arange(len(own) + len(twice))
            self.place[w] = place

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bits in which the sketches of pairs of sets differ (none counted for sizes too different to compare)."""
        least = np.minimum(self.size[x], self.size[y])
        fits = np.maximum(self.size[x], self.size[y]) <= 2 * least
        out = np.zeros(len(x), np.int64)
        for w in np.unique(least[fits]).tolist():
            i = np.flatnonzero(fits & (least == w))
            rows, place = self.rows[w], self.place[w]
            out[i] = np.bitwise_count(rows[place[x[i]]] ^ rows[place[y[i]]]).sum(1, dtype=np.int64)
        return out


def set_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in slices(b):
            value, text = shingle_sets(Words(s.column("text").to_pylist()), k)
            n, s1, s2 = identity(value, text, s.num_rows)
            bits = short_sketches(value, text, n)
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), s.column("th"), *(pa.array(x, pa.int64()) for x in (n, s1, s2)), pa.array(bits, pa.binary())],
                names=_SETS.names)


def key_rows(batches: Iterator[pa.RecordBatch], k: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    """Pieces of the sketches for a set's own band and, as the smaller of a pair, for the next.

    Where sets of a band may not differ at all there is nothing to join: equal
    sets are one class already. Of equal sets of a batch the first is taken.
    """
    for b in batches:
        seen: set[int] = set()
        for s in slices(b):
            value, text = shingle_sets(Words(s.column("text").to_pylist()), k)
            n, s1, _ = identity(value, text, s.num_rows)
            fresh = np.zeros(len(n), bool)
            for i in np.flatnonzero(n > 0).tolist():
                if (x := int(s1[i])) not in seen:
                    seen.add(x)
                    fresh[i] = True
            band = bands.of(np.maximum(n, 1))
            keys, owners = [], []
            for up in (0, 1):
                pieces = np.where(fresh, bands.pieces(band + up), 0)
                pieces[pieces == 1] = 0
                use = pieces[text] > 0
                words, first = sketch(value[use], text[use], pieces, wide=True)
                owner = np.repeat(np.arange(len(n)), pieces)
                empty = np.bincount(owner[words == 0], minlength=len(n)) if len(words) else np.zeros(len(n), np.int64)
                say = (words != 0) | (empty > bands.spare(band + up))[owner]
                nth = np.arange(len(words)) - first[owner]
                where = ((band[owner] + up) << 40 | nth).astype(U)
                keys.append(mix(words, mix(where, where))[say].view(np.int64))
                owners.append(s1[owner][say])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (keys, owners)],
                                             names=_KEYS.names)


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and set: what several sets share.

    Of a key of at most ``GROUP`` sets all rows go on, to be compared. A key of
    more gives each other set with its first one, as a stream (``key_blocks``).
    """
    none = np.zeros(0, np.int64)
    held = (none, none)
    big: tuple[int, int, int] | None = None          # key, first and last set of a large key

    def rows(key, first, s1) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), first, pa.array(s1)], names=_SHARED.names)

    def close(k: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(groups(k))
        n = np.diff(np.append(at, len(k)))
        of = np.repeat(n, n)
        few, many = (of > 1) & (of <= GROUP), of > GROUP
        yield rows(k[few], pa.nulls(int(few.sum()), pa.int64()), s[few])
        first = np.repeat(s[at], n)
        edge = many & (s != first)
        yield rows(k[edge], pa.array(first[edge]), s[edge])

    for b in batches:
        k, s = (np.concatenate([h, b.column(c).to_numpy()]) for h, c in zip(held, _KEYS.names))
        if not len(k):
            continue
        keep = groups(k, s)
        k, s = k[keep], s[keep]
        if big and k[0] == big[0]:
            of = int(np.searchsorted(k, k[0], "right"))
            new = s[:of][s[:of] > big[2]]
            yield rows(np.full(len(new), big[0]), pa.array(np.full(len(new), big[1])), new)
            big = (big[0], big[1], int(s[of - 1]))
            k, s = k[of:], s[of:]
            held = (none, none)
            if not len(k):
                continue
        big = None
        last = int(np.searchsorted(k, k[-1], "left"))
        yield from close(k[:last], s[:last])
        k, s = k[last:], s[last:]
        held = (k, s)
        if len(k) > GROUP:
            yield from close(k, s)
            big, held = (int(k[0]), int(s[0]), int(s[-1])), (none, none)
    yield from close(*held)


def key_blocks(shared: DataFrame) -> DataFrame:
    """``key, s1`` of what is compared: the keys of ``meet``, a large one as a key for each two of its blocks.

    A set that many share a key with by chance (a common line alone in a piece)
    has few that are similar. Were all of them connected unseen, these keys would
    make one cluster of a share of all sets that grows with their number.
    """
    large = shared.filter("first is not null")
    large = large.select("key", "s1").unionByName(large.select("key", F.col("first").alias("s1")).distinct())
    blocks = large.groupBy("key").agg(F.expr(f"(count(*) + {KEY_BLOCK - 1}) div {KEY_BLOCK}").alias("n_blocks"))
    dealt = (large.join(blocks, "key").withColumn("i", F.pmod(F.xxhash64("s1"), F.col("n_blocks")))
             .withColumn("j", F.explode(F.expr("sequence(0L, n_blocks - 1)"))).filter("i <> j or n_blocks = 1")
             .select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "s1"))
    return shared.filter("first is null").select("key", "s1").unionByName(dealt)


def compare(batches: Iterator[pa.RecordBatch], bands: Bands) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, of which a task holds one at a time: edges that connect the
    sets of a key whose short sketches do not rule out that they are similar."""
    held: list[pa.Table] = []

    def edges(t: pa.Table) -> pa.RecordBatch:
        key, s1, n = (t[c].to_numpy() for c in ("key", "s1", "n"))
        bits = Sketches(t["bits"].to_pylist())

        def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            yes = 100 * np.minimum(n[x], n[y]) >= bands.percent * np.maximum(n[x], n[y])
            x, y = x[yes], y[yes]
            yes[yes] = bits.apart(x, y) <= bands.differ(n[x] + n[y])
            return yes

        at = np.flatnonzero(groups(key))
        size = np.diff(np.append(at, len(key)))
        out_a, out_b = [], []
        two = at[size == 2]
        two = two[near(two, two + 1)] if len(two) else two
        out_a.append(s1[two])
        out_b.append(s1[two + 1])
        for first, g in zip(at[size > 2].tolist(), size[size > 2].tolist()):
            left = np.arange(first, first + g)
            while len(left) > 1:
                # all that the first one reaches, over others too, then the rest
                reached, front = np.zeros(len(left), bool), [0]
                reached[0] = True
                while front:
                    x = front.pop()
                    new = np.flatnonzero(~reached)
                    if not len(new):
                        break
                    new = new[near(np.full(len(new), left[x]), left[new])]
                    reached[new] = True
                    front += new.tolist()
                    out_a.append(np.full(len(new), s1[left[x]]))
                    out_b.append(s1[left[new]])
                left = left[~reached]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (out_a, out_b)], names=_EDGES.names)

    for b in batches:
        key = b.column("key").to_numpy()
        if not len(key):
            continue
        t, last = pa.Table.from_batches([b]), int(np.searchsorted(key, key[-1], "left"))
        if held and (last or held[0]["key"][0].as_py() != key[-1]):
            yield edges(pa.concat_tables([*held, t.slice(0, last)]).combine_chunks())
            held, t = [], t.slice(last)
        elif last:
            yield edges(t.slice(0, last))
            t = t.slice(last)
        held.append(t)
    if held:
        yield edges(pa.concat_tables(held).combine_chunks())


def pack(value: np.ndarray) -> bytes:
    """The elements as 64-bit numbers."""
    return value.astype("<u8").tobytes()


def unpack(items: bytes) -> np.ndarray:
    """The packed elements, sorted."""
    return np.sort(np.frombuffer(items, "<u8").astype(U))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``percent``."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def links(cid: list[int], block: list[int], items: list[np.ndarray], i: int, j: int, bands: Bands,
          chunk: int = 256) -> list[tuple[int, int]]:
    """Verified links of the documents of blocks i and j, as many as connect
    what links between them connect.

    Pairs of one block are compared only where i = j.
    """
    n = np.array([len(x) for x in items], np.int64)
    band = bands.of(n)
    value = np.concatenate(items)
    owner = np.repeat(np.arange(len(items)), n)
    sketches = []
    for up in (0, 1):
        pieces = bands.pieces(band + up)
        words, first = sketch(value, owner, pieces)
        sketches.append([words[first[t]:first[t + 1]] for t in range(len(items))])
    top = list(range(len(items)))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    side = np.array(block)
    members = {int(k): np.flatnonzero(band == k) for k in np.unique(band)}
    for k, own in members.items():
        for other_band, up in ((k, 0), (k - 1, 1)):
            other = members.get(other_band)
            if other is None:
                continue
            big = np.stack([sketches[0][t] for t in own])
            small = np.stack([sketches[up][t] for t in other])
            for a in range(0, len(own), chunk):
                for c in range(0, len(other), chunk):
                    x, y = own[a:a + chunk], other[c:c + chunk]
                    apart = np.zeros((len(x), len(y)), np.int64)
                    for w in range(big.shape[1]):
                        apart += np.bitwise_count(big[a:a + chunk, w][:, None] ^ small[c:c + chunk, w][None])
                    near = apart <= bands.differ(n[x][:, None] + n[y][None])
                    if not up:
                        near &= x[:, None] < y[None]
                    if i != j:
                        near &= side[x][:, None] != side[y][None]
                    for p, q in zip(*np.nonzero(near)):
                        s, t = int(x[p]), int(y[q])
                        if root(s) != root(t) and similar(items[s], items[t], bands.percent):
                            top[root(s)] = root(t)
                            out.append((cid[s], cid[t]))
    return out


def verify(batches: Iterator[pa.RecordBatch], bands: Bands) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cluster and block pair; the rows of one pair are bounded by the block size."""
    task, rows = None, {}

    def done() -> pa.RecordBatch:
        cid = list(rows)
        found = links(cid, [rows[c][0] for c in cid], [rows[c][1] for c in cid], task[1], task[2], bands)
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=_EDGES.names)

    for b in batches:
        for root, i, j, block, cid, items in zip(*(c.to_pylist() for c in b.columns)):
            if task != (root, i, j):
                if len(rows) > 1:
                    yield done()
                task, rows = (root, i, j), {}
            rows[cid] = (block, unpack(items))
    if len(rows) > 1:
        yield done()


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, block_items: int = 1_000_000,
                       block_docs: int = 512, max_broadcast: int = 200_000) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, is_first`` of every row.

    Texts are lower-cased (A-Z only) and split at blanks, tabs and line or page
    ends; a document's set holds its distinct ``words``-word shingles, the
    whole sequence as one if it has fewer words. Documents are linked whose
    Jaccard similarity is ``percent`` or more; ``component_id`` is the smallest
    id that links lead to, ``is_first`` marks the row that stands for all (rows
    that repeat it too, and every row without shingles). Null and empty texts have no shingles and no links;
    repeated rows each get a row; a null id is larger than all others; an empty
    table gives an empty result. ``block_items`` and ``block_docs`` bound what a task
    compares: a larger cluster is dealt to blocks, a task for each two of them. At
    most ``max_broadcast`` clustered sets are named where the texts are read;
    more are joined to them by a shuffle.
    """
    bands = Bands(percent)
    d = keyed(docs).withColumn("text", lower_ascii(F.col("text")))
    sets = materialise(d.mapInArrow(lean(lambda x: set_rows(x, words)), _SETS), "sets")
    same = ["n", "s1", "s2"]
    classes = materialise(
        sets.filter("n > 0").groupBy(*same)
        .agg(F.min("doc_id").alias("first_id"), F.first("bits").alias("bits"),
             F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "th")).alias("rep"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    shared = materialise(
        d.select("text").mapInArrow(lean(lambda x: key_rows(x, words, bands)), _KEYS)
        .repartition("key").sortWithinPartitions("key", "s1").mapInArrow(lean(meet), _SHARED), "shared")
    compared = (key_blocks(shared)
                .join(small(classes.select("s1", "n", "bits"), max_broadcast), "s1")
                .select("key", "s1", "n", "bits").repartition("key").sortWithinPartitions("key")
                .mapInArrow(lean(lambda x: compare(x, bands)), _EDGES))
    clusters = components(compared)

    member = classes.join(clusters.withColumnRenamed("node", "s1"), "s1")
    member = materialise(member.select("root", "cid", "n", "rep.doc_id", "rep.th"), "members")
    blocks = member.groupBy("root").agg(F.sum("n").alias("size"), F.count("*").alias("docs")).withColumn(
        "n_blocks", F.expr(f"greatest((size + {block_items - 1}) div {block_items}, (docs + {block_docs - 1}) div {block_docs})"))
    dealt = materialise(member.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("n_blocks")))
                        .drop("size", "docs", "n"), "dealt")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("root", "i", "j", "block", "cid")] + [("items", pa.binary())])

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

        for b in batches:
            for s in slices(b):
                value, text = shingle_sets(Words(s.column("text").to_pylist()), words)
                end = np.cumsum(np.bincount(text, minlength=s.num_rows))
                out, held = [[] for _ in range(6)], 0
                for t, (root, cid, block, n) in enumerate(zip(*(s.column(c).to_pylist() for c in ("root", "cid", "block", "n_blocks")))):
                    items = pack(value[end[t - 1] if t else 0:end[t]])
                    for other in range(n):
                        for c, v in zip(out, (root, min(block, other), max(block, other), block, cid, items)):
                            c.append(v)
                        # a set goes to as many tasks as its cluster has blocks: not all at once
                        held += len(items)
                        if held >= MEMBER_BYTES:
                            yield rows()
                            out, held = [[] for _ in range(6)], 0
                yield rows()

    found = (d.alias("d").join(small(dealt, max_broadcast).alias("m"), F.expr("d.doc_id <=> m.doc_id and d.th = m.th"))
             .select("root", "cid", "block", "n_blocks", "d.text").mapInArrow(lean(deal), _MEMBERS)
             .repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
             .mapInArrow(lean(lambda x: verify(x, bands)), _EDGES))
    linked = components(found)
    labelled = (classes.join(linked.withColumnRenamed("node", "cid"), "cid", "left")
                .select(*same, "first_id", "rep", F.coalesce("root", "cid").alias("label")))
    least = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"), F.min("rep").alias("first"))
    named = materialise(labelled.join(least, "label").select(*same, "component_id", "first"), "named")
    return (sets.drop("bits").join(named, same, "left")
            .select("doc_id", "th", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.expr("n = 0 or (doc_id <=> first.doc_id and th = first.th)").alias("is_first")))
