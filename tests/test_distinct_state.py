"""Distinct counts from merged states equal a recount; numbers are dense and stay."""

from pyspark.sql import functions as F

from kinship.operators.distinct_state import distinct_by_digest, group_keys, merged_counts, number_keys, states
from kinship.operators.strategy import written


def rows(spark, lo, hi, run):
    # every third row holds one hot key, some keys are null, files share keys
    k = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40000))
    return spark.range(lo, hi).select(F.concat(F.lit("f"), F.col("id") % 7).alias("file"), F.lit(run).alias("run"), k.alias("key"))


def test_states_merge_to_a_recount(spark):
    by = ["file", "run"]
    one, two = rows(spark, 0, 60000, "a"), rows(spark, 30000, 120000, "b")
    k1 = group_keys(one, "key", by)
    n1 = written(number_keys(k1, by), "t")
    s1 = states(k1, n1, by)
    k2 = group_keys(two, "key", by)
    n2 = written(number_keys(k2, by, n1), "t")
    numbers = n1.unionByName(n2)
    every = one.unionByName(two)
    total = every.select(F.count_distinct("key")).first()[0]
    # dense, and given once
    assert numbers.agg(F.count("_n"), F.count_distinct("_n"), F.min("_n"), F.max("_n")).first() == (total, total, 0, total - 1)
    state = s1.unionByName(states(k2, numbers, by))
    got = {(r.file, r.run): r.n_distinct for r in merged_counts(state, by, total=True).collect()}
    want = {(r.file, r.run): r.n for r in every.rollup(*by).agg(F.count_distinct("key").alias("n")).collect()}
    assert got == want and len(got) == 14 + 7 + 1
    # a file's state that is made anew replaces its own only
    again = state.where("not (file = 'f1' and run = 'a')").unionByName(states(k1.where("file = 'f1'"), numbers, by))
    assert {(r.file, r.run): r.n_distinct for r in merged_counts(again, by, total=True).collect()} == want


def test_numbers_follow_the_first_group(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "z"), (None, "w"), ("c", None)], "file string, key string")
    k = group_keys(df, "key", ["file"])
    n = k.join(number_keys(k, ["file"]), "_kd")
    at = {(r.file, r._n) for r in n.collect()}
    assert {x for f, x in at if f is None} == {0} and {x for f, x in at if f == "a"} == {1, 2}
    assert 3 in {x for f, x in at if f == "b"}
    assert merged_counts(states(k, number_keys(k, ["file"]), ["file"]), ["file"]).where("file = 'b'").first().n_distinct == 2


def test_empty(spark):
    df = spark.createDataFrame([], "file string, key string")
    k = group_keys(df, "key", ["file"])
    assert merged_counts(states(k, number_keys(k, ["file"]), ["file"]), ["file"], total=True).collect() == []


def test_distinct_by_digest_equals_count_distinct(spark):
    df = spark.createDataFrame([("d", "a", True), ("d", "a", False), ("d", "b", None), ("d", None, True), ("e", None, True),
                                (None, "", False), (None, "", False)], "dataset string, q string, hit boolean")
    got = distinct_by_digest(df, "q", ["dataset"], {"w": F.col("hit"), "wo": ~F.col("hit")})
    want = df.groupBy("dataset").agg(F.count_distinct(F.when(F.col("hit"), F.col("q"))).alias("w"),
                                     F.count_distinct(F.when(~F.col("hit"), F.col("q"))).alias("wo"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
