"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import dropped, written


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (id, component_id): the smallest id reachable, for each id that has an edge (columns a, b).

    Large and small stars (Kiveris et al., 2014): in each round a node's neighbours are linked to the smallest of
    them, which needs O(log^2 n) rounds for any shape. Edges never grow in number, each round is a table in the
    shared folder, and the driver sees one number per round.
    """
    edges = written(spark, edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        # large star: each larger neighbour of a node is linked to the node's smallest neighbour
        both = edges.unionAll(edges.selectExpr("b AS a", "a AS b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").selectExpr("b AS a", "m AS b").distinct()
        # small star: a node and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.selectExpr("b AS a", "m AS b").unionAll(low.selectExpr("a", "m AS b")).filter("a <> b").distinct()
        before, edges = edges, written(spark, small, "stars")
        dropped(before)
        n, total, hashed = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if (n, total, hashed) == state:
            break
        state = (n, total, hashed)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.selectExpr("a AS id", "b AS component_id").unionAll(edges.selectExpr("b AS id", "b AS component_id").distinct())
