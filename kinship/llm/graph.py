"""Connected components by repeated contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b``); nodes have one root
    exactly if edges connect them.

    A round gives every node its smallest neighbour or itself, follows these
    pointers twice and joins the edges between what is left; the number of
    nodes at least halves each time. Aggregates are partial, tables are written
    between the rounds, nothing is collected.
    """
    e = materialise(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = materialise(both.groupBy("a").agg(F.min("b").alias("m"))
                            .select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "pointers")
        for _ in range(2):
            up = point.select(F.col("node").alias("root"), F.col("root").alias("top"))
            point = materialise(point.join(up, "root").select("node", F.col("top").alias("root")), "pointers")
        rounds.append(point)
        a, b = (point.select(F.col("node").alias(c), F.col("root").alias("r" + c)) for c in "ab")
        e = materialise(e.join(a, "a").join(b, "b").filter("ra <> rb")
                        .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if not rounds:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[0]
    for later in rounds[1:]:
        top = later.select(F.col("node").alias("root"), F.col("root").alias("top"))
        out = out.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return materialise(out, "components")
