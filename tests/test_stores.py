"""Stores: the posting index probed by batches, upserts, shuffle-free probes, line numbers."""

import os
import random

import pytest

from kinship.operators import link
from kinship.operators.posting_store import PostingStore, build_store
from kinship.operators.simjoin import common_needed, largest_partner, prefix_length, shared_needed, similarity_join
from kinship.sources.line_numbers import numbered_lines
from kinship.sources.sinks import save_store
from kinship.sources.upsert_store import UpsertStore


def brute(left, right, t):
    out = set()
    for i, a in left:
        for j, b in right:
            both = len(set(a) & set(b))
            if both and both / (len(a) + len(b) - both) >= t:
                out.add((i, j, both))
    return out


def sets(rng, n, start, words):
    base = rng.sample(words, 40)
    out = []
    for i in range(n):
        own = set(rng.sample(words, rng.randint(1, 60)))
        if i % 3 == 0:          # a third are near copies of one set
            own = set(base) - set(rng.sample(base, rng.randint(0, 6))) | set(rng.sample(words, rng.randint(0, 6)))
        out.append((start + i, sorted(own | ({"everywhere"} if i % 5 else set()))))
    return out + [(start + n, [])]


@pytest.mark.parametrize("t", [0.2, 0.3, 0.5, 0.9, 1.0])
def test_similarity_join_loses_nothing(spark, t):
    rng = random.Random(int(t * 10))
    words = [f"w{i}" for i in range(200)]
    left, right = sets(rng, 90, 0, words), sets(rng, 80, 1000, words)
    got = similarity_join(spark.createDataFrame(left, "lid long, kw array<string>"),
                          spark.createDataFrame(right, "rid long, kw array<string>"), t)
    assert {(r.lid, r.rid, r.n_common) for r in got.collect()} == brute(left, right, t)


def test_places_count_exactly_where_they_can(spark):
    """``largest_partner`` against its definition."""
    t = 0.3
    df = spark.range(1, 90).selectExpr("cast(id as int) as sz").crossJoin(spark.range(1, 90).selectExpr("cast(id as int) as pos")).where("pos <= sz")
    from pyspark.sql import functions as F

    df = df.select("sz", "pos", largest_partner(F.col("sz"), F.col("pos"), t).alias("hi"), prefix_length(F.col("sz"), t).alias("p"),
                   F.sequence(F.ceil(F.col("sz") * t - 1e-9).cast("int"), F.floor(F.col("sz") / t + 1e-9).cast("int")).alias("ms"))
    need = common_needed(F.col("sz"), F.col("m"), t)
    rows = df.withColumn("m", F.explode("ms")).where(F.col("pos") <= F.col("sz") - need + shared_needed(need))
    best = {(r.sz, r.pos): r.m for r in rows.groupBy("sz", "pos").agg(F.max("m").alias("m")).collect()}
    for r in df.collect():
        if (r.sz, r.pos) in best:
            assert r.hi == best[r.sz, r.pos] and r.pos <= r.p
        else:
            assert r.hi < r.ms[0]


def test_posting_store(spark, tmpdir_run):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(150)]
    right = sets(rng, 700, 1000, words)         # more postings of one word than a block holds
    path = os.path.join(tmpdir_run, "store")
    build_store(spark.createDataFrame(right, "rid long, kw array<string>"), path, 0.3, folders=3)
    store = PostingStore(spark, path)
    for seed, t in ((1, None), (2, 0.3), (3, 0.6)):
        left = sets(random.Random(seed), 40, 0, [*words, *(f"new{i}" for i in range(40))])
        got = store.probe(spark.createDataFrame(left, "lid long, kw array<string>"), t)
        assert {(r.lid, r.rid, r.n_common) for r in got.collect()} == brute(left, right, t or 0.3)
    with pytest.raises(ValueError):
        store.probe(spark.createDataFrame([(1, ["a"])], "lid long, kw array<string>"), 0.2)


def test_upserts(spark, tmpdir_run):
    schema = spark.createDataFrame([], "key string, ord long, url string").schema
    store = UpsertStore(spark, os.path.join(tmpdir_run, "s"), schema, buckets=8)
    assert store.read().count() == 0
    first = [(f"k{i}", i, f"a{i}") for i in range(50)] + [("k1", 60, "later"), ("k2", -1, "earlier"), (None, 1, "null"), (None, 2, "null 2")]
    assert store.upsert(spark.createDataFrame(first, schema), "one") == 1
    before = {r["bucket"]: r["path"] for r in store.manifest()}
    second = [("k3", -5, "new 3"), ("new", 1, "n")]
    assert store.upsert(spark.createDataFrame(second, schema), "two") == 2
    got = {r["key"]: (r["ord"], r["url"]) for r in store.read().collect()}
    want = {k: (o, u) for k, o, u in first if k not in (None, "k1", "k2")} | {
        "k1": (60, "later"), "k2": (2, "a2"), None: (2, "null 2"), "k3": (-5, "new 3"), "new": (1, "n")}
    assert got == want
    after = {r["bucket"]: r["path"] for r in store.manifest()}
    touched = {b for b in after if before.get(b) != after[b]}
    assert 1 <= len(touched) <= 2 and len(after) == len(set(after))
    # a retry changes nothing, an older version can still be read
    assert store.upsert(spark.createDataFrame(second, schema), "two") == 2
    assert {r["bucket"]: r["path"] for r in store.manifest()} == after
    assert {r["key"] for r in store.read(1).collect()} == {k for k, _, _ in first}
    assert store.upsert(spark.createDataFrame([], schema), "nothing") == 3 and store.read().count() == len(want)
    # two writers of one version: the second fails and the store stays
    with pytest.raises(Exception, match="EXISTS|exists"):
        other = UpsertStore(spark, store.root, schema)
        other.manifest = lambda version=None: store.__class__.manifest(other, 2)
        other.upsert(spark.createDataFrame([("z", 1, "z")], schema), "late")
    assert store.read().count() == len(want)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_store_is_not_shuffled(spark, tmpdir_run):
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        cs = spark.createDataFrame([(i, f"Key {i} ", f"u{i}") for i in range(300)], "ord long, question_text string, document_url string")
        idx = link.corpus_index(link.prepare_corpus(cs), "ord", ["document_url"])
        save_store(idx, "kinship_test_store", "key", os.path.join(tmpdir_run, "t"))
        qs = link.prepare_questions(spark.createDataFrame([(i, f"key {i % 400}") for i in range(900)] + [(900, None)], "q_id int, question string"))
        out = link.probe_store(qs, "kinship_test_store")
        got = {r.q_id: r.document_url for r in out.collect()}
        assert got == {i: f"u{i % 400}" if i % 400 < 300 else None for i in range(900)} | {900: None}
        plan = plan_of(out)
        join = plan[plan.index("SortMergeJoin"):]
        store_side = join[join.index("kinship_test_store") - 600:]
        assert plan.count("Exchange") == 1 and "Bucketed: true" in store_side
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
        spark.sql("drop table if exists kinship_test_store")


def test_keys_travel_as_digests(spark):
    """No text of a key is shuffled for a report; the payload join comes after."""
    from kinship.operators.report import match_report

    cs = link.prepare_corpus(spark.createDataFrame([(i, f"question number {i}") for i in range(50)], "ord long, question_text string"))
    qs = link.prepare_questions(spark.createDataFrame([("d", f"Question number {i}") for i in range(80)], "dataset string, question string"))
    rep = match_report(qs, link.key_index(cs, "ord"))
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    sides = [line for line in plan[join:].splitlines() if "Aggregate" in line or "Project" in line]
    assert rep.collect()[0][:3] == ("d", 80, 50)
    assert sides and not any("key#" in line.split("Project [")[1] for line in sides[:1] if "Project [" in line)


def test_line_numbers_do_not_depend_on_splits(spark, tmpdir_run):
    lines = [f"{i} " + "x" * (i % 97) for i in range(4000)]
    for name, part in (("b", lines[2500:]), ("a", lines[:2500]), ("c", [])):
        with open(os.path.join(tmpdir_run, f"{name}.txt"), "w") as f:
            f.write("".join(x + "\n" for x in part))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4k", "30k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r.ord: r.value for r in numbered_lines(spark, tmpdir_run).collect()}
            assert got == dict(enumerate(lines))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    empty = os.path.join(tmpdir_run, "c.txt")
    assert numbered_lines(spark, empty).collect() == []
