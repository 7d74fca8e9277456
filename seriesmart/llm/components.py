"""Connected components of an undirected graph, by alternating stars over the cluster."""

from pyspark.sql import DataFrame, functions as F

from seriesmart.sources.scratch import Scratch


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _to_least(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` with each ``a`` beside the least of its neighbours and itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return edges.join(least.withColumn("least", F.least("a", "least")), "a")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, component`` (its least node) for every node with an edge to another one.

    ``edges`` has columns a and b. Each round points every node's larger neighbours to the
    least one (large star), then its smaller ones (small star); a component of any shape
    becomes a star after a number of rounds that grows as the logarithm of its size. The
    minima are combined before the shuffle, so a hot node is no burden. Edges of a round are
    a written table.
    """
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, turn = scratch.stage(both, f"{name}-0"), 0
    state = _state(now)
    while state[0]:
        ways = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(ways).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.filter("a <> b").distinct()
        near = _to_least(large)
        small = near.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            near.select("a", F.col("least").alias("b"))
        )
        turn += 1
        fresh = scratch.stage(small.filter("a <> b").distinct(), f"{name}-{turn}")
        scratch.remove(f"{name}-{turn - 1}")
        now, before, state = fresh, state, _state(fresh)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
