"""The trie of conversations that share their first turns.

A turn is its role and text; a node is a distinct sequence of first turns. The
identity of a sequence is the sum, modulo 2^128 in two halves, of a mixed hash
of every turn's SHA-256 and its place; so prefixes are running sums, and a
running sum can be taken over range-sorted partitions and carried over their
borders: no conversation has to fit into a task.

Distinct prefix digests are grouped into nodes. Subtrees of at most ``limit``
turns are dealt whole to shards. A shard enumerates its digests in a minimal
perfect hash (levels of bit arrays; the digest stored in a slot decides whether
a looked-up key is there), scatters the nodes' counts into flat numpy arrays
and adds them to their parents' slots, deepest first. What a shard's topmost
nodes come to is summed per parent; nodes above the limit are handled the same
way, with the limit's square, cube and so on, until the root is done.

Nulls and ties: a null role or text is empty, a null turn comes first; turns
with one number come in the order of their digests. Rows without a ``conv_id``
belong to no conversation and are left out. Repeated rows are turns of their own. An
empty table has no nodes. Other columns are ignored. ``conv_id`` modulo
``family`` is taken as not negative.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import materialise, small, whole_text

U = np.uint64
_P, _Q, _R = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53), U(0x9E3779B97F4A7C15)


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * _P
    x = (x ^ (x >> U(33))) * _Q
    return x ^ (x >> U(33))


def pairs(column) -> np.ndarray:
    """An Arrow column of 16-byte values, none of them null, as rows of two numbers."""
    fixed = column.cast(pa.binary(16))
    if isinstance(fixed, pa.ChunkedArray):
        fixed = fixed.combine_chunks()
    raw = fixed.buffers()[1] if len(fixed) else b""
    return np.frombuffer(raw, "<u8", 2 * len(fixed), 16 * fixed.offset).reshape(-1, 2).astype(U) if len(fixed) else np.zeros((0, 2), U)


def as_bytes(x: np.ndarray) -> pa.Array:
    raw = pa.py_buffer(np.ascontiguousarray(x.astype("<u8")).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(x), [None, raw]).cast(pa.binary())


# --- running sums over conversations ----------------------------------------

def running_sums(df: DataFrame, order: list[str], what: str) -> DataFrame:
    """``df`` with ``s``, the running sums of the two numbers in column ``v``
    (16 bytes, each half modulo 2^64) within a ``conv_id`` by ``order``.

    Rows are sorted by ranges. A partition sums what it has and leaves, as a row
    of its own, what its last conversation came to; only these rows, one for each partition,
    come to the driver, and say what the partitions after it begin with.
    """
    spark = df.sparkSession
    fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in ("conv_id", "v")]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), *fields, T.StructField("s", T.BinaryType()),
                           T.StructField("pid", T.IntegerType()), T.StructField("last", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        conv, total = None, np.zeros(2, U)
        for b in batches:
            if not b.num_rows:
                continue
            c = b.column("conv_id").to_numpy()
            sums = np.cumsum(pairs(b.column("v")), axis=0, dtype=U)
            first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            before = np.where((first > 0)[:, None], sums[first - 1], U(0))
            if c[0] == conv:
                before[0] -= total
            sums -= np.repeat(before, np.diff(np.append(first, len(c))), axis=0)
            conv, total = c[-1], sums[-1].copy()
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), *(b.column(f.name) for f in fields), as_bytes(sums),
                 pa.array(np.full(len(c), pid, np.int32)), pa.array(np.zeros(len(c), bool))], names=schema.names)
        if conv is not None:
            arrow = {b_.name: b_.type for b_ in b.schema}
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(conv)], pa.int64()), *(pa.array([None], arrow[f.name]) for f in fields), as_bytes(total[None]),
                 pa.array([pid], pa.int32()), pa.array([True])], names=schema.names)

    rows = materialise(df.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order).mapInArrow(run, schema), what)
    carry: dict[tuple[int, int], np.ndarray] = {}
    before: tuple[int, np.ndarray] | None = None
    for r in sorted(rows.filter("last").select("pid", "conv_id", "s").collect(), key=lambda r: r["pid"]):
        total = np.frombuffer(r["s"], "<u8").astype(U)
        if before:
            carry[r["pid"], before[0]] = before[1]
            if before[0] == r["conv_id"]:
                total = total + before[1]
        before = r["conv_id"], total
    rows = rows.filter("not last").drop("last")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = sent.value
        for b in batches:
            c, pid, s = b.column("conv_id").to_numpy(), b.column("pid").to_numpy(), pairs(b.column("s"))
            first = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (pid[1:] != pid[:-1]))) if len(c) else []
            more = [(i, j, v) for i, j in zip(first, [*first[1:], len(c)]) if (v := at.get((int(pid[i]), int(c[i])))) is not None]
            for i, j, v in more:
                s[i:j] += v
            yield pa.RecordBatch.from_arrays([as_bytes(s) if n == "s" else b.column(n) for n in b.schema.names if n != "pid"],
                                             names=[n for n in b.schema.names if n != "pid"])

    sent = spark.sparkContext.broadcast(carry)          # one entry for each partition at most
    return rows.mapInArrow(add, rows.drop("pid").schema)


# --- conversations ----------------------------------------------------------

def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, td, words``: of a turn only its digest and word count go on."""
    role, text = whole_text("role"), whole_text()
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                digest.alias("td"), words.alias("words")).filter("conv_id is not null")


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``pos``, their number in their conversation, from 1."""
    one = F.unhex(F.lit("01" + "00" * 15))
    rows = running_sums(turns.withColumn("v", one), ["turn", "td"], "trie-turns")
    low = F.concat(*(F.substring("s", k, 1) for k in range(8, 0, -1)))          # little-endian
    return rows.select("conv_id", "td", "words", F.conv(F.hex(low), 16, 10).cast("long").alias("pos"))


def rebuilt(turns: DataFrame, family: int, heads: int) -> DataFrame:
    """``conv_id, d, n, td, words``: the turns of every rebuilt conversation, d from 1
    to n, and a row with d = 0 for the empty beginning, with a null ``td``.

    The first h turns of conversation c - c % ``family`` stand for the first h of c,
    h being crc32 of the decimal c modulo ``heads``.
    """
    pos = materialise(numbered(turns), "trie-numbered")
    size = pos.groupBy("conv_id").agg(F.max("pos").alias("own"))
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(family))
    size = materialise(size.withColumn("base", base).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads), "trie-sizes")
    of_base = size.filter("conv_id = base").select("base", F.col("own").alias("there"))
    convs = size.join(of_base, "base", "left").withColumn("k", F.least("h", F.coalesce("there", F.lit(0))))
    convs = materialise(convs.select("conv_id", "base", "h", "k", (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")),
                        "trie-conversations")
    own = (pos.join(convs.select("conv_id", "h", "k", "n"), "conv_id").filter("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("d"), "n", "td", "words"))
    head = pos.filter((F.col("conv_id") == base) & (F.col("pos") < heads)).select(F.col("conv_id").alias("base"), F.col("pos").alias("d"), "td", "words")
    given = convs.filter("k > 0").join(head, "base").filter("d <= k").select("conv_id", "d", "n", "td", "words")
    empty = convs.select("conv_id", F.lit(0).cast("long").alias("d"), "n", F.lit(None).cast("binary").alias("td"), F.lit(0).cast("long").alias("words"))
    return own.unionByName(given).unionByName(empty)


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, d, n, words, g, pg``: the digest of the first d turns and of the first d - 1."""
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "td"), T.StructField("v", T.BinaryType())])
    out = T.StructType([*(f for f in schema.fields if f.name != "v"), T.StructField("g", T.BinaryType()), T.StructField("pg", T.BinaryType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every turn's own number, from its digest and its place; 0 for the empty beginning."""
        for b in batches:
            d = b.column("d").to_numpy().astype(U)
            x = pairs(b.column("td").fill_null(bytes(16)))
            a = scramble(x[:, 0] + scramble(d * _R + _P))
            v = np.stack([scramble(a ^ x[:, 1]), scramble(scramble(x[:, 1] + d * _Q) ^ (x[:, 0] * _R))], 1)
            v[d == 0] = 0
            yield pa.RecordBatch.from_arrays([as_bytes(v) if n == "v" else b.column(n) for n in schema.names], names=schema.names)

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, own = pairs(b.column("s")), pairs(b.column("own"))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in out.names[:-2]), as_bytes(s), as_bytes(s - own)], names=out.names)

    own = rows.mapInArrow(hashed, schema).withColumn("own", F.col("v"))
    return materialise(running_sums(own, ["d"], "trie-sums").mapInArrow(parted, out), "trie-prefixes")


# --- the node table of a shard ----------------------------------------------

class SlotTable:
    """Minimal perfect hash of distinct 128-bit keys: n keys have slots 0 to n - 1.

    A level hashes the keys that are left into cells; those alone in their cell
    stay, the others go on to the next level. A key's slot is the rank of its cell among all
    taken ones. Keys outside the table are told by the key that the slot stores.
    """

    ROOM = 1.5

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.keys = np.zeros_like(keys)
        left, taken = np.arange(len(keys)), 0
        while len(left):
            cell = self._cells(keys[left], len(self.levels), m := int(len(left) * self.ROOM) + 1)
            alone = np.bincount(cell, minlength=m) == 1
            rank = taken + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            stay = alone[cell]
            self.keys[rank[cell[stay]]] = keys[left[stay]]
            taken += int(stay.sum())
            left = left[~stay]

    @staticmethod
    def _cells(keys: np.ndarray, level: int, cells: int) -> np.ndarray:
        return (scramble(keys[:, 0] ^ scramble(keys[:, 1] + U((level + 1) * int(_R) % (1 << 64)))) % U(cells)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 for those that are not in the table."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            cell = self._cells(keys[left], level, len(alone))
            here = alone[cell]
            slot = rank[cell[here]]
            same = (self.keys[slot] == keys[left[here]]).all(1)
            out[left[here][same]] = slot[same]
            left = left[~here]
        return out


def accumulate(table: pa.Table) -> pa.Table:
    """Counts of the nodes of one shard, whose subtrees are whole but for what
    ``kids``, ``below`` and ``worth`` say of nodes that were done before."""
    digests = pairs(table.column("g"))
    number = {c: table.column(c).to_numpy().astype(np.int64) for c in ("d", "conv_id", "n_convs", "words", "kids", "below", "worth")}
    nodes = SlotTable(digests)
    slot = nodes.slots(digests)

    def scattered(x: np.ndarray) -> np.ndarray:
        out = np.empty_like(x)
        out[slot] = x
        return out

    depth, conv = scattered(number["d"]), scattered(number["conv_id"])
    parent = scattered(nodes.slots(pairs(table.column("pg"))))
    parent[depth == 0] = -1                     # the root's parent digest is its own
    children = scattered(number["kids"]) + np.bincount(parent[parent >= 0], minlength=len(depth))
    leaves = scattered(number["below"]) + (children == 0)
    saved = scattered(number["worth"]) + (scattered(number["n_convs"]) - 1) * scattered(number["words"])
    deepest = np.argsort(-depth, kind="stable")
    begin = np.flatnonzero(np.append(True, np.diff(depth[deepest]) != 0))
    for i, j in zip(begin, [*begin[1:], len(deepest)]):
        at = deepest[i:j]
        at = at[parent[at] >= 0]
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    up = np.where(parent >= 0, conv[parent], 0)[slot]
    return pa.table([table.column("g"), table.column("pg"), table.column("conv_id"), table.column("d"),
                     pa.array(up, mask=(parent < 0)[slot]), table.column("n_convs"),
                     *(pa.array(x[slot]) for x in (children, leaves, saved))], names=COUNTED.names)


COUNTED = T.StructType([T.StructField("g", T.BinaryType()), T.StructField("pg", T.BinaryType()),
                        *(T.StructField(c, T.LongType()) for c in (
                            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"))])


def counted(paths: DataFrame, limit: int) -> DataFrame:
    """``COUNTED`` rows of all nodes of ``prefixes`` rows; shards hold at most about 2 ``limit`` nodes."""
    nodes = materialise(paths.groupBy("g", "d").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.max("pg").alias("pg"),
        F.sum(F.col("n") - F.col("d") + 1).alias("turns")), "trie-nodes")
    most = nodes.agg(F.max("turns")).first()[0]
    if most is None:
        return nodes.sparkSession.createDataFrame([], COUNTED)
    bounds = [limit]
    while bounds[-1] < most:
        bounds.append(bounds[-1] * limit)
    # where a conversation's path first comes to a subtree within a bound
    heavy = nodes.filter(F.col("turns") > limit)
    on_path = paths.select("conv_id", "d", "g").join(small(heavy.select("g", "d", "turns"), 100_000), ["g", "d"], "left")
    top = materialise(on_path.groupBy("conv_id").agg(*(
        F.min(F.when(F.coalesce("turns", F.lit(0)) <= bound, F.struct("d", "g")))["g"].alias(f"top{k}")
        for k, bound in enumerate(bounds))), "trie-tops")
    level = F.lit(len(bounds) - 1)
    for k in reversed(range(len(bounds) - 1)):
        level = F.when(F.col("turns") <= bounds[k], k).otherwise(level)
    nodes = materialise(nodes.join(top, "conv_id").withColumn("level", level)
                        .withColumn("top", F.element_at(F.array(*(f"top{k}" for k in range(len(bounds)))), F.col("level") + 1))
                        .drop(*(f"top{k}" for k in range(len(bounds)))), "trie-dealt")
    each = {r["level"]: r["count"] for r in nodes.groupBy("level").count().collect()}        # a row for each bound
    done: list[DataFrame] = []
    for k in sorted(each):
        own = nodes.filter(F.col("level") == k)
        zero = [F.lit(0).cast("long").alias(c) for c in ("kids", "below", "worth")]
        if done:
            sums = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("kids", "below", "worth"))
            told = [x.filter("parent_conv_id is null and depth > 0") for x in done]
            below = told[0]
            for x in told[1:]:
                below = below.unionByName(x)
            below = materialise(below.groupBy(F.col("pg").alias("g"), (F.col("depth") - 1).alias("d")).agg(
                F.count("*").alias("kids"), F.sum("n_leaves").alias("below"), F.sum("saved_tokens").alias("worth")), "trie-below")
            own = own.join(below, ["g", "d"], "left").select(*own.columns, *sums)
        else:
            own = own.select("*", *zero)
        shards = -(-each[k] // limit)
        dealt = own.withColumn("shard", F.pmod(F.xxhash64("top"), F.lit(shards)))
        done.append(materialise(dealt.groupBy("shard").applyInArrow(lambda key, t: accumulate(t), COUNTED), "trie-counted"))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    above = small(heavy.select(F.col("g").alias("pg"), (F.col("d") + 1).alias("depth"), F.col("conv_id").alias("above")), 100_000)
    return (out.filter("depth > 0 and parent_conv_id is null").join(above, ["pg", "depth"], "left")
            .withColumn("parent_conv_id", F.col("above")).select(*COUNTED.names)
            .unionByName(out.filter("depth = 0 or parent_conv_id is not null")))


# --- who ends where ----------------------------------------------------------

_IDS = 4096
_PIECES = T.StructType([T.StructField("g", T.BinaryType()), T.StructField("sha", T.StringType()), T.StructField("pid", T.IntegerType()),
                        T.StructField("seq", T.IntegerType()), T.StructField("ids", T.StringType())])
_ENDS = T.StructType([T.StructField("g", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])


def ends(paths: DataFrame) -> DataFrame:
    """``g, ends_sha256`` of the nodes at which conversations end.

    Ids are sorted by ranges, so that a group of copies is sorted by many tasks.
    A group within a partition is hashed there; of the first and the last group of a
    partition, which may go on in others, pieces of the joined ids are hashed one after
    the other, as SHA-256 has to be: what such a group sends to one task is its ids' text, as a stream.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        g, ids, seq, first = None, [], 0, True

        def piece(over: bool, last: bool) -> Iterator[tuple]:
            nonlocal ids, seq, first
            text = ",".join(map(str, ids))
            if over and not seq and not first and not last:
                yield g, hashlib.sha256(text.encode()).hexdigest(), None, None, None
            else:
                yield g, None, pid, seq, text
            ids, seq, first = [], 0 if over else seq + 1, first and not over

        for b in batches:
            out = []
            for x, c in zip(b.column("g").to_pylist(), b.column("conv_id").to_pylist()):
                if x != g and g is not None:
                    out += piece(True, False)
                elif len(ids) == _IDS:
                    out += piece(False, False)
                g = x
                ids.append(c)
            yield pa.RecordBatch.from_pylist([dict(zip(_PIECES.names, r)) for r in out], schema=_PIECES_ARROW)
        if ids:
            yield pa.RecordBatch.from_pylist([dict(zip(_PIECES.names, r)) for r in piece(True, True)], schema=_PIECES_ARROW)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, sha = None, None
        for b in batches:
            out = []
            for x, text in zip(b.column("g").to_pylist(), b.column("ids").to_pylist()):
                if x != g:
                    if g is not None:
                        out.append((g, sha.hexdigest()))
                    g, sha = x, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(_ENDS.names, r)) for r in out], schema=_ENDS_ARROW)
        if g is not None:
            yield pa.RecordBatch.from_pylist([{"g": g, "ends_sha256": sha.hexdigest()}], schema=_ENDS_ARROW)

    at = paths.filter("d = n").select("g", "conv_id")
    pieces = materialise(at.repartitionByRange("g", "conv_id").sortWithinPartitions("g", "conv_id").mapInArrow(join, _PIECES), "trie-ends")
    over = pieces.filter("sha is null").select("g", "pid", "seq", "ids").repartition("g").sortWithinPartitions("g", "pid", "seq")
    return pieces.filter("sha is not null").select("g", F.col("sha").alias("ends_sha256")).unionByName(over.mapInArrow(whole, _ENDS))


_PIECES_ARROW = pa.schema([("g", pa.binary()), ("sha", pa.string()), ("pid", pa.int32()), ("seq", pa.int32()), ("ids", pa.string())])
_ENDS_ARROW = pa.schema([("g", pa.binary()), ("ends_sha256", pa.string())])


def trie(conversations: DataFrame, family: int = 20, heads: int = 4, limit: int = 1 << 12) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` of every node of the rebuilt conversations' trie."""
    paths = prefixes(rebuilt(turns_of(conversations), family, heads))
    nodes = materialise(counted(paths, limit), "trie-table")
    at = materialise(ends(paths), "trie-hashes")
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(at, "g", "left").select(*(c for c in COUNTED.names if c not in ("g", "pg")),
                                              F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
