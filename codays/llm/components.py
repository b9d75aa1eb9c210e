"""Connected components by alternating large and small stars.

Each round hangs the neighbours of every node on the smallest of them; the
edges of a component become one star around its smallest node after a number of
rounds that grows with the logarithm of its size. The smallest neighbour is an
aggregate that is combined before the shuffle, and edges meet it in a join that
adaptive execution may split, so a node with very many edges is no obstacle.
Every round is a written table, read by the next one.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codays.session import staged


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum, equal when nothing has changed."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    above = both.where(F.col("b") > F.col("a"))
    return above.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").where(F.col("b") != F.col("m"))
    return least.select("a", F.col("m").alias("b")).union(hung.select(F.col("b").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node with an edge.

    ``edges`` has two columns of nodes of one orderable type, in any order and
    repeated at will; rows with a null and loops are left out.
    """
    one, two = edges.columns
    ordered = edges.where(F.col(one) != F.col(two)).select(
        F.greatest(one, two).alias("a"), F.least(one, two).alias("b")
    )
    stars = staged(ordered.distinct(), "stars")
    state = _state(stars)
    while state[0]:
        stars = staged(_small_star(_large_star(stars).distinct()).distinct(), "stars")
        now = _state(stars)
        if now == state:
            break
        state = now
    centres = stars.select(F.col("b").alias("node")).distinct()
    return stars.toDF("node", "component").union(centres.select("node", F.col("node").alias("component")))


def smallest_linked(one: np.ndarray, two: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the smallest place it hangs together with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[one], label[two])
        now = label.copy()
        np.minimum.at(now, one, low)
        np.minimum.at(now, two, low)
        now = now[now]
        if (now == label).all():
            return label
        label = now
