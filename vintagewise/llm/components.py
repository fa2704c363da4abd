"""Connected components of a graph given as rows, by alternating stars.

Both steps keep the components: the first hangs a node's larger neighbours on its smallest one, the second a node and
its smaller neighbours. Paths shorten geometrically, and the graph ends as one star per component around its smallest
node. A step groups and joins on a node; the smallest neighbour is combined before the shuffle.
"""

from pyspark.sql import DataFrame, functions as F

from ..session import stored


def _hang(edges: DataFrame) -> DataFrame:
    """Rows (u, v), with the smallest of v's and u itself as m."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least.select("u", F.least("u", "m").alias("m")), "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.col("v") % 1000003)).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node on an edge; component is the smallest node it reaches."""
    larger, smaller = F.greatest(a, b), F.least(a, b)
    links = stored(edges.where(F.col(a) != F.col(b)).select(larger.alias("u"), smaller.alias("v")).distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _hang(large)
        rows = small.select("u", F.col("m").alias("v")).union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        links = stored(rows.distinct(), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    # every edge now leads to its component's smallest node
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
