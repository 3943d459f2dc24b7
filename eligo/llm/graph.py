"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eligo.llm.common import written

#: Parts into which the larger neighbours of a node are dealt.
PARTS = 16


def _round(edges: DataFrame) -> DataFrame:
    """One large and one small star of distinct edges (smaller a, larger b).

    Large: a node's larger neighbours point to its least neighbour. Of a centre with many neighbours these are dealt
    to :data:`PARTS` tasks, to each of which its least neighbour goes. Small: a node and its smaller neighbours point to
    the least of them; a node has few different smaller neighbours, since each of these has been replaced by its least."""
    least = edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
    dealt = least.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    large = edges.select(F.col("a").alias("u"), "b", F.pmod(F.xxhash64("b"), F.lit(PARTS)).cast("int").alias("part")).join(dealt.hint("merge"), ["u", "part"], "left")
    small = large.select(F.coalesce("m", "u").alias("a"), "b").withColumn("m", F.min("a").over(Window.partitionBy("b")))
    return small.select(F.explode(F.array(F.struct("m", F.col("b").alias("v")), F.struct("m", F.col("a").alias("v")))).alias("e")).select(F.col("e.m").alias("a"), F.col("e.v").alias("b")).filter("a <> b").distinct()


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): b's component has the least node a, for every node but the least ones. ``edges``: distinct (a, b), a < b,
    a table that may be read again.

    The stars keep the connectivity and need a number of rounds that grows with the logarithm of the longest path.
    Each round is a written table, so neither a lost executor nor the plan's length matters."""
    state = _state(edges)
    while state[0]:
        edges = written(_round(edges), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges


def _state(edges: DataFrame) -> tuple:
    """How many edges there are, and a sum of their hashes: equal if a round has changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (columns a, b); the component is its least node."""
    found = stars(written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges"))
    return found.select(F.col("b").alias("id"), F.col("a").alias("component")).unionAll(found.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
