"""Groups of interchangeable features and the one to keep of each."""

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .history import group_figures


def connected_groups(nodes: DataFrame, links: DataFrame, name: str = "feature") -> DataFrame:
    """Smallest name reachable over the links (left, right), as `cluster`.

    Each round takes the smallest label among a node, its neighbours and its own label's label, so the number
    of rounds grows with the logarithm of the longest chain. One row per node; both tables are column lists.
    """
    both = links.select("left", "right").union(links.select(F.col("right"), F.col("left")))
    both = cut_lineage(both.distinct())
    labels = cut_lineage(nodes.select(name, F.col(name).alias("cluster")))
    while True:
        near = both.join(labels, both["right"] == labels[name]).groupBy("left").agg(F.min("cluster").alias("_near"))
        own = labels.select(F.col(name).alias("_of"), F.col("cluster").alias("_next"))
        step = (labels.join(near, labels[name] == near["left"], "left")
                .join(own, labels["cluster"] == own["_of"], "left"))
        moved = cut_lineage(step.select(
            name, F.col("cluster").alias("_old"), F.least("cluster", "_near", "_next").alias("cluster")))
        labels = moved.drop("_old")
        if moved.where(F.col("cluster") != F.col("_old")).isEmpty():
            return labels


def prune_features(correlations: DataFrame, signal: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Per feature: its group of features correlated at |rho| >= threshold, and whether it is the strongest.

    `signal` holds one row per feature with `gini`.
    """
    links = correlations.where(F.abs("rho") >= threshold)
    groups = connected_groups(signal.select("feature"), links)
    return group_figures(signal.join(groups, "feature"), "cluster", "gini")
