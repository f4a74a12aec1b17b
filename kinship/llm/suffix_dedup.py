"""Suffix-array deduplication of long byte strings.

Any two places that hold the same string of ``length`` bytes also share the
smallest hash of a gram in it. Texts are therefore split into regions, runs of
windows with one smallest hash (the anchor), and only regions whose anchor
occurs again are looked at. Of the regions with equal contents two go to the
shards, of every other content one; what the suffix array finds of the two holds
for their copies. Regions are dealt to shards: by the smallest document that has the anchor, so
that neighbouring regions of a document mostly travel as one string, or by the
anchor itself where that document has too many. A shard sorts all suffixes of
its strings (Larsson-Sadakane refinement in numpy) and takes the common
prefixes of neighbours (Kasai) to find the windows that occur twice. An anchor
with too many contents for one shard is spread over several; their sorted
window names are cut into ranges and merged by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import materialise, small, tagged

U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A
    x ^= (b + _C) * _B
    x ^= x >> U(29)
    x *= _C
    x ^= x >> U(32)
    return x


def gram_hashes(data: bytes, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """64-bit hashes of all grams of the given sizes (each at least 8), by doubling."""
    n = len(data)
    k = 8
    h = np.ndarray((max(0, n - 7),), "<u8", data, 0, (1,)).astype(U)
    out = {}
    for size in sorted(sizes):
        while 2 * k <= size:
            h = mix(h[:-k], h[k:]) if len(h) > k else h[:0]
            k *= 2
        d = size - k
        out[size] = (mix(h[:-d], h[d:]) if len(h) > d else h[:0]) if d else h
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    m, k = x, 1
    while 2 * k <= w:
        m, k = np.minimum(m[:-k], m[k:]), 2 * k
    return np.minimum(m[:len(m) - (w - k)], m[w - k:]) if k < w else m


#: Starts of windows that are looked at in one piece of a long text.
PIECE = 1 << 19
_LOW = U((1 << 20) - 1)
#: Most starts of one region; its first and last window then cover all of it.
MOST = 256


def regions_of(data: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchor, content hash, first start and number of starts of every region,
    and whether the anchor's gram occurs in it more than once.

    Windows that are equal have the same anchor, and if both are in one region,
    its gram occurs twice there: they hold it at the same distance from their
    starts. Long texts are cut into pieces and long runs into regions of at
    most ``MOST`` starts; what a cut divides becomes two regions with the same
    anchor, which changes no result.
    """
    half = length - 256
    for a in range(0, len(data) - length + 1, PIECE):
        part = data[a:a + PIECE + length - 1]
        h = gram_hashes(part, (gram, 256))
        g = h[gram]
        m = sliding_min((g & ~_LOW) | np.arange(len(g), dtype=U), length - gram + 1)
        at = (m & _LOW).astype(np.int64)
        n = len(at)
        moved = np.flatnonzero(np.append(True, at[1:] != at[:-1]))      # the place of the smallest gram
        value = g[at[moved]]
        new = np.append(True, value[1:] != value[:-1])                  # its hash
        group = np.cumsum(new) - 1
        first, places = moved[new], np.bincount(group)
        last = np.append(first[1:], n)
        cuts = -(-(last - first) // MOST)
        owner = np.repeat(np.arange(len(first)), cuts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        s0 = first[owner] + nth * MOST
        s1 = np.minimum(s0 + MOST, last[owner]) - 1
        w = h[256]
        content = mix(mix(w[s0], w[s0 + half]), mix(w[s1], w[s1 + half]) ^ (s1 - s0).astype(U))
        yield g[at[s0]].view(np.int64), content.view(np.int64), s0 + a, s1 - s0 + 1, places[owner] > 1


# --- suffix arrays ----------------------------------------------------------

class SuffixArray:
    """Suffixes of several strings, each followed by a separator of its own.

    Separators are smaller than all bytes and ordered by their strings, so
    suffixes of different strings never compare beyond their strings' ends.
    """

    STRIDE = 64
    SYMBOLS = 7          # of 9 bits in one key: byte + 1, separators and what follows 0

    def __init__(self, strings: list[bytes]):
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(strings) else np.zeros(0, np.int64)
        self.sizes = sizes
        raw = np.frombuffer(b"\0".join(strings) + b"\0" * 8, np.uint8)
        n = int((sizes + 1).sum())
        self.rest = np.repeat(self.first + sizes, sizes + 1) - np.arange(n)       # symbols before the separator
        sym = raw[:n].astype(U) + U(1)
        sym[self.first + sizes] = 0
        sym = np.append(sym, np.zeros(8, U))
        key = np.zeros(n, U)
        for j in range(self.SYMBOLS):
            key <<= U(9)
            key |= np.where(self.rest > j, sym[j:n + j], U(0))
        self.key, self.n = key, n
        # names of 64 bytes at a time, for long common prefixes
        self.stride = gram_hashes(raw.tobytes() + b"\0" * self.STRIDE, (self.STRIDE,))[self.STRIDE]
        self.order = self._refine()

    def _refine(self) -> np.ndarray:
        """Sort by the first symbols, then refine the groups that are still
        unsorted by the ranks ``h`` and ``2 h`` symbols further on, tripling
        ``h``. A group of two, the usual case, is only compared."""
        n, h = self.n, self.SYMBOLS
        order = np.argsort(self.key)
        k = self.key[order]
        # of keys with a separator in sight equal ones are ordered by their strings
        at = np.flatnonzero(self.rest[order] < h)
        order[at] = order[at][np.lexsort((order[at], k[at]))]
        begins = np.ones(n, bool)
        begins[1:] = (k[1:] != k[:-1]) | (self.rest[order[1:]] < h)       # a separator in sight: no equal
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
        bits = max(1, int(n).bit_length())
        while True:
            first = np.flatnonzero(begins)
            size = np.diff(np.append(first, n))
            if (size == 1).all():
                return order

            def further(idx: np.ndarray) -> np.ndarray:
                """The ranks further on as one number; past a separator the first decides."""
                if 2 * bits > 62:
                    return rank[idx + h]
                on = np.minimum(idx + 2 * h, n - 1)
                return rank[idx + h] << bits | np.where(self.rest[idx] >= 2 * h, rank[on], 0)

            two = first[size == 2]
            x, y = order[two], order[two + 1]
            fx, fy = further(x), further(y)
            swap, apart = fx > fy, fx != fy
            many = np.repeat(size > 2, size)
            at = np.flatnonzero(many)
            idx = order[at]
            ahead = further(idx)
            order[two], order[two + 1] = np.where(swap, y, x), np.where(swap, x, y)
            begins[two + 1] = apart
            rank[order[two + 1]] += apart
            if len(at):
                own = rank[idx]
                if 3 * bits <= 63:
                    by = np.argsort(own << 2 * bits | ahead)
                else:
                    by = np.lexsort((ahead, own))
                idx, own, ahead = idx[by], own[by], ahead[by]
                order[at] = idx
                new = np.ones(len(at), bool)
                new[1:] = (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])
                begins[at] = new
                rank[idx] = np.maximum.accumulate(np.where(new, at, 0))
            h *= 2 if 2 * bits > 62 else 3

    def common_prefixes(self, starts: np.ndarray) -> np.ndarray:
        """Kasai: common prefix of every suffix with its predecessor in sorted
        order, for the first ``starts[k]`` suffixes of string k, else 0.

        All strings are gone through side by side; from one start to the next
        the common prefix shrinks by at most one symbol.
        """
        out = np.zeros(self.n, np.int64)
        phi = np.full(self.n, -1, np.int64)
        phi[self.order[1:]] = self.order[:-1]
        lanes = np.flatnonzero(starts > 0)
        lanes = lanes[np.argsort(-starts[lanes], kind="stable")]
        have = np.zeros(len(lanes), np.int64)
        live = np.searchsorted(-starts[lanes], -np.arange(1, (starts.max() if len(starts) else 0) + 1), "right")
        for t, k in enumerate(live):
            i = self.first[lanes[:k]] + t
            j = phi[i]
            lcp = np.where(j < 0, 0, np.maximum(have[:k] - 1, 0))
            go = np.flatnonzero(j >= 0)
            far = go if t == 0 else go[have[:k][go] < 2]         # only where a match begins it is long
            while len(far):
                a, b = i[far] + lcp[far], j[far] + lcp[far]
                far = far[(self.rest[a] >= self.STRIDE) & (self.rest[b] >= self.STRIDE)
                          & (self.stride[np.minimum(a, len(self.stride) - 1)] == self.stride[np.minimum(b, len(self.stride) - 1)])]
                lcp[far] += self.STRIDE
            while len(go):
                a, b = i[go] + lcp[go], j[go] + lcp[go]
                x = self.key[a] ^ self.key[b]
                same = np.zeros(len(go), np.int64)
                for s in range(self.SYMBOLS):
                    same += x < U(1) << U(9 * s)
                np.minimum(same, np.minimum(self.rest[a], self.rest[b]), out=same)
                lcp[go] += same
                go = go[same == self.SYMBOLS]
            out[i] = have[:k] = lcp
        return out


def repeated_starts(strings: list[bytes], starts: np.ndarray, length: int) -> tuple[np.ndarray, SuffixArray]:
    """Which suffixes share ``length`` bytes with another one (of any string)."""
    sa = SuffixArray(strings)
    lcp = sa.common_prefixes(starts)[sa.order]
    near = np.maximum(lcp, np.append(lcp[1:], 0)) >= length
    out = np.zeros(sa.n, bool)
    out[sa.order] = near
    return out, sa


def may_repeat(strings: list[bytes], starts: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """String, first start and number of starts of what can be repeated at all.

    Windows that are equal have the same smallest gram of 256 bytes, by any
    hash. A window whose gram stands in no other place of a window that is
    still in question is left out; what is left is looked at by another hash.
    """
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    first = np.cumsum(sizes) - sizes
    data = b"".join(strings)
    h = gram_hashes(data, (256,))[256]
    total = len(h) - (length - 256)
    if total <= 0:
        return []
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, first[starts > 0], 1)
    np.add.at(edge, np.minimum((first + starts)[starts > 0], total), -1)
    keep = np.cumsum(edge[:-1]) > 0
    for salt in (3, 5, 7):
        m = np.concatenate([sliding_min((g & ~_LOW) | np.arange(len(g), dtype=U), length - 255)
                            for a in range(0, total, PIECE)
                            for g in [mix(h[a:a + PIECE + length - 256], h[a:a + PIECE + length - 256] ^ U(salt))]])
        at = np.flatnonzero(keep)
        if not len(at):
            break
        # one row for each place of a gram that windows in question choose; grams by their hashes' upper bits
        place = (m[at] & _LOW).astype(np.int64) + at // PIECE * PIECE
        new = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        _, back, count = np.unique(h[place[new]], return_inverse=True, return_counts=True)
        keep[at] = np.repeat(count[back] > 1, np.diff(np.append(new, len(at))))
    out = []
    begin, end = runs(keep)
    which = np.searchsorted(first, begin, "right") - 1
    for i, x, z in zip(which.tolist(), begin.tolist(), end.tolist()):
        while x < z:                                  # a run may go on into the next string
            stop = min(z, int(first[i] + starts[i]))
            if stop > x:
                out.append((i, x - int(first[i]), stop - x))
            i += 1
            x = max(x, stop, int(first[i]) if i < len(first) else z)
    return out


def window_names(data: bytes, length: int) -> np.ndarray:
    """128-bit names of all windows of a string, as 16 bytes each."""
    h = gram_hashes(data, (256,))[256]
    half = length - 256
    return np.ascontiguousarray(np.stack([h[:len(h) - half], h[half:]], 1)).view("S16").ravel()


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last index of every run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


# --- Spark -----------------------------------------------------------------

REGIONS = T.StructType([*(T.StructField(c, T.LongType()) for c in ("doc_id", "tag", "anchor", "c", "place")),
                        T.StructField("own", T.BooleanType())])
COVERED = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "tag", "a", "z")])
SLICES = T.StructType([*(T.StructField(c, T.LongType()) for c in ("part", "sub", "n_subs", "doc_id", "tag", "s0", "n")),
                       T.StructField("raw", T.BinaryType())])
#: Covered bytes (a, z), or of a spread anchor the sorted names of one range and their places.
FOUND = T.StructType([*COVERED.fields, T.StructField("part", T.LongType()), T.StructField("range", T.LongType()),
                      *(T.StructField(c, T.BinaryType()) for c in ("names", "docs", "tags", "at"))])


def find_regions(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, tag, anchor, c, place, own`` of every region of ``tagged`` texts; a
    place packs the first start and the number of starts (9 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list[np.ndarray]] = [[] for _ in range(5)]
            owner, size = [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                data = text.encode()
                if len(data) >= length:
                    for found in regions_of(data, length, gram):
                        for c, v in zip(cols, found):
                            c.append(v)
                        owner.append(i)
                        size.append(len(found[0]))
            if owner:
                take = np.repeat(owner, size)
                anchor, content, s0, n, own = (np.concatenate(c) for c in cols)
                take = pa.array(take)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("tag").take(take),
                                                  *map(pa.array, (anchor, content, s0 << 9 | n, own))],
                                                 names=REGIONS.names)

    return texts.mapInArrow(run, REGIONS)


_START, _N = "shiftright(place, 9)", "(place & 511)"


#: Starts of one string in a suffix array; longer ones are cut, so that Kasai's
#: lanes are many and short. A piece's last bytes are shorter than a window and match none.
LANE = 2048


def sort_shard(shard: pa.Table, length: int) -> pa.Table:
    """Suffix array of one shard: what of its strings is repeated, and, for an
    anchor spread over several shards, its window names by range."""
    # a row that is in the table twice sends its strings twice: they are one string each
    rows = list({(r["doc_id"], r["tag"], r["s0"]): r for r in shard.to_pylist()}.values())
    strings, n = [r["raw"] for r in rows], np.array([r["n"] for r in rows], np.int64)
    left = [(i, a + o, min(LANE, k - o)) for i, a, k in may_repeat(strings, n, length) for o in range(0, k, LANE)]
    again, sa = repeated_starts([strings[i][a:a + k - 1 + length] for i, a, k in left],
                                np.array([k for _, _, k in left], np.int64), length)
    out = []
    for (i, begin, k), at in zip(left, sa.first):
        r = rows[i]
        for a, z in zip(*(x.tolist() for x in runs(again[at:at + k]))):
            out.append((r["doc_id"], r["tag"], r["s0"] + begin + a, r["s0"] + begin + z - 1 + length) + (None,) * 6)
    m = rows[0]["n_subs"]
    if m > 1:
        names = np.concatenate([window_names(s, length) for s in strings])
        place = np.concatenate([r["s0"] + np.arange(r["n"]) for r in rows])
        owner = np.repeat(np.arange(len(rows)), n)
        by = np.argsort(names, kind="stable")
        names, place, owner = names[by], place[by], owner[by]
        # a shard's sorted names are cut where a range of all names ends
        cut = np.searchsorted(names, np.array([(i << 32) // m for i in range(1, m)], ">u4").view("S4"))
        doc = np.array([r["doc_id"] if r["doc_id"] is not None else 0 for r in rows], np.int64)
        tags = np.array([r["tag"] for r in rows], np.int64)
        null = np.array([r["doc_id"] is None for r in rows])
        for k, (a, z) in enumerate(zip([0, *cut], [*cut, len(names)])):
            for is_null in (False, True):
                pick = np.flatnonzero(null[owner[a:z]] == is_null) + a
                if len(pick):
                    out.append((None if is_null else 0, None, None, None, rows[0]["part"], k, names[pick].tobytes(),
                                doc[owner[pick]].tobytes(), tags[owner[pick]].tobytes(), place[pick].tobytes()))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 10, _FOUND_ARROW.types)], schema=_FOUND_ARROW)


_FOUND_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "tag", "a", "z", "part", "range")]
                         + [(c, pa.binary()) for c in ("names", "docs", "tags", "at")])
_COVERED_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "tag", "a", "z")])


def merge_range(lists: pa.Table, length: int) -> pa.Table:
    """Windows of one range of names that several lists, or one list twice, hold."""
    rows = lists.to_pylist()
    known, many = np.zeros(0, "S16"), np.zeros(0, bool)
    sorted_names = [np.frombuffer(r["names"], "S16") for r in rows]
    for x in sorted_names:
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        twice = np.diff(np.append(first, len(x))) > 1
        x = x[first]
        at = np.searchsorted(known, x)
        hit = (at < len(known))
        hit[hit] = known[at[hit]] == x[hit]
        many[at[hit]] = True
        known, many = np.insert(known, at[~hit], x[~hit]), np.insert(many, at[~hit], twice[~hit])
        many[np.searchsorted(known, x[twice])] = True
    out = []
    for r, x in zip(rows, sorted_names):
        doc, tag, place = (np.frombuffer(r[c], np.int64) for c in ("docs", "tags", "at"))
        yes = np.flatnonzero(many[np.searchsorted(known, x)])
        out += [(None if r["doc_id"] is None else int(doc[i]), int(tag[i]), int(place[i]), int(place[i]) + length) for i in yes]
    return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], schema=_COVERED_ARROW)


def covered(texts: DataFrame, length: int = 400, gram: int = 192, shard_bytes: int = 1 << 20) -> DataFrame:
    """``doc_id, tag, a, z``: byte ranges of ``tagged`` texts whose windows of
    ``length`` bytes also start elsewhere. Ranges may overlap and repeat.

    ``gram`` is the size of the minimizers (at least 8; of 256 bytes at most),
    ``shard_bytes`` about what one suffix array sorts.
    """
    if not (8 <= gram <= 256 <= length <= 512):
        raise ValueError("needs 8 <= gram <= 256 <= length <= 512")
    spark = texts.sparkSession
    found = materialise(find_regions(texts, length, gram), "regions")
    anchors = materialise(
        found.groupBy("anchor").agg(F.count("*").alias("k"), F.min("c").alias("lo"), F.max("c").alias("hi"),
                                    F.max("own").alias("own"), F.min("doc_id").alias("least"))
        .filter("k > 1 or own").select("anchor", F.expr("lo <> hi or own").alias("several"), "least"), "anchors")
    cand = materialise(found.drop("own").join(anchors, "anchor"), "candidates")
    at = F.struct("doc_id", "tag", "place")
    contents = materialise(
        cand.groupBy("anchor", "c").agg(F.count("*").alias("k"), F.max("several").alias("several"), F.first("least").alias("least"),
                                        F.min(at).alias("lo"), F.max(at).alias("hi")), "contents")

    # one or two regions of each content go to a shard that the anchor determines
    reps = (contents.filter("several or lo <> hi")
            .select("anchor", "c", "least", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("at"))
            .select("anchor", "c", "least", "at.doc_id", "at.tag", "at.place").withColumn("n", F.expr(_N)))
    per_anchor = materialise(reps.groupBy("anchor").agg(F.sum(F.col("n") + length).alias("size"), F.first("least").alias("least")),
                             "anchor-sizes")
    per_doc = per_anchor.groupBy(F.coalesce("least", F.lit(-1)).alias("least")).agg(F.sum("size").alias("of_doc"))
    total = per_anchor.select(F.sum("size")).first()[0] or 0
    n_shards = max(1, -(-total // shard_bytes))
    # regions that follow each other are one string: about a quarter of what their sizes add up to
    dealt = materialise(
        per_anchor.withColumn("least", F.coalesce("least", F.lit(-1))).join(per_doc, "least")
        .withColumn("n_subs", F.expr(f"if(of_doc > {4 * shard_bytes}, (size + {shard_bytes - 1}) div {shard_bytes}, 1)"))
        .select("anchor", "n_subs", F.expr(f"""case when n_subs > 1 then anchor
            when of_doc > {4 * shard_bytes} then pmod(xxhash64(anchor), {n_shards})
            else pmod(xxhash64(least), {n_shards}) end""").alias("part")), "shards")
    wanted = (reps.select("anchor", "c", "doc_id", "tag", "place").join(dealt, "anchor")
              .groupBy("doc_id", "tag")
              .agg(F.collect_list(F.struct("part", F.expr("if(n_subs > 1, 1 + pmod(c, n_subs), 0)").alias("sub"), "n_subs",
                                           F.expr(_START).alias("s0"), F.expr(_N).alias("n"))).alias("cuts")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                out = []
                for r in b.slice(at, 200).to_pylist():
                    data, joined = r["text"].encode(), []
                    for c in sorted(r["cuts"], key=lambda c: (c["part"], c["sub"], c["s0"])):
                        last = joined[-1] if joined else None
                        if last and (last["part"], last["sub"], last["s0"] + last["n"]) == (c["part"], c["sub"], c["s0"]):
                            last["n"] += c["n"]
                        else:
                            joined.append(c)
                    out += [dict(c, doc_id=r["doc_id"], tag=r["tag"], raw=data[c["s0"]:c["s0"] + c["n"] - 1 + length]) for c in joined]
                yield pa.RecordBatch.from_pylist(out, schema=_SLICES_ARROW)

    d, w = texts.alias("d"), wanted.alias("w")
    slices = (d.join(w, F.expr("d.doc_id <=> w.doc_id and d.tag = w.tag"))
              .select("d.doc_id", "d.tag", "d.text", "w.cuts").mapInArrow(cut, SLICES))
    # so many tasks for so many shards: a number of its own is not merged by AQE
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_shards // 16)
    parts = materialise(slices.repartition(tasks, "part", "sub").groupBy("part", "sub")
                        .applyInArrow(lambda t: sort_shard(t, length), FOUND), "sorted")
    alone = parts.filter("range is null").select("doc_id", "tag", "a", "z")
    merged = parts.filter("range is not null").groupBy("part", "range").applyInArrow(
        lambda t: merge_range(t, length), COVERED)
    sorted_out = materialise(alone.unionByName(merged), "sorted-out")

    # copies of a region are covered where the shards found it covered; a row that is stored twice repeats itself
    span = [F.expr(_START).alias("a"), F.expr(f"{_START} + {_N} - 1 + {length}").alias("z")]
    copied = contents.filter("k > 2 and lo <> hi").select("anchor", "c", "lo.doc_id", "lo.tag", "lo.place")
    m, u = copied.alias("m"), union_of(sorted_out).alias("u")
    proven = (m.join(u, F.expr("m.doc_id <=> u.doc_id and m.tag = u.tag")).select("anchor", "c", "place", "spans")
              .select("anchor", "c", *span, "spans").filter("exists(spans, s -> s.start <= a and s.end >= z)").select("anchor", "c"))
    twice = contents.filter("k > 1 and lo = hi").select("anchor", "c")
    copies = (cand.select("anchor", "c", "doc_id", "tag", "place")
              .join(materialise(proven.unionByName(twice), "proven"), ["anchor", "c"]).select("doc_id", "tag", *span))
    return sorted_out.unionByName(copies)


_SLICES_ARROW = pa.schema([(c, pa.int64()) for c in SLICES.names[:-1]] + [("raw", pa.binary())])
_SPAN_LIST = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
KEPT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                     T.StructField("spans", _SPAN_LIST), T.StructField("kept", T.BinaryType())])
_SPANS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("spans", _SPAN_LIST)])


def union_of(ranges: DataFrame) -> DataFrame:
    """``doc_id, tag, spans``: the maximal runs that a document's ranges cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for pairs in b.column("ranges").to_pylist():
                spans: list[list[int]] = []
                for a, z in sorted((x["a"], x["z"]) for x in pairs):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(z, spans[-1][1])
                    else:
                        spans.append([a, z])
                out.append([{"start": a, "end": z} for a, z in spans])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tag"), pa.array(out, _KEPT_ARROW.field("spans").type)],
                                             names=_SPANS.names)

    return (ranges.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("a", "z")).alias("ranges"))
            .mapInArrow(run, _SPANS))


def dedup(docs: DataFrame, length: int = 400, max_broadcast: int = 200_000, **how) -> DataFrame:
    """Remove every byte that a string of ``length`` bytes covers which also
    starts anywhere else, in the same document or another.

    Texts are UTF-8 bytes, judged as they come in. Returns a row per row of
    ``docs``: ``doc_id, n_bytes``, ``spans`` (maximal removed runs, start and
    end) and ``kept``, the bytes left over. The spans of at most
    ``max_broadcast`` documents are sent to where the texts are read; those of
    more are joined by a shuffle. Null and empty texts have no
    bytes; texts shorter than ``length`` stay whole; rows that repeat a text
    lose all of it, whatever their ids; a null id is an id of its own. An empty
    table gives an empty result.
    """
    texts = tagged(docs)
    spans = materialise(union_of(covered(texts, length, **how)), "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                out = []
                for r in b.slice(at, 500).to_pylist():
                    data, found = r["text"].encode(), r["spans"] or []
                    begin = [0, *(x["end"] for x in found)]
                    kept = b"".join(data[a:z] for a, z in zip(begin, [*(x["start"] for x in found), len(data)]))
                    out.append({"doc_id": r["doc_id"], "n_bytes": len(data), "kept": kept, "spans": found})
                yield pa.RecordBatch.from_pylist(out, schema=_KEPT_ARROW)

    d, p = texts.alias("d"), small(spans, max_broadcast).alias("p")
    return (d.join(p, F.expr("d.doc_id <=> p.doc_id and d.tag = p.tag"), "left")
            .select("d.doc_id", "d.text", "p.spans").mapInArrow(remove, KEPT))


_KEPT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                         ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         ("kept", pa.binary())])
