"""Connected components by contraction: nodes take their least neighbour, pointers are doubled to the roots of the
trees this makes, and only edges between different roots go on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import settle


def _narrow(df: DataFrame, name: str) -> DataFrame:
    """Settled in a part of the tasks: rows are a pair of numbers, and every task writes a file that the next ones open."""
    return settle(df.coalesce(max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)), name)


def components(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(_node, _root) for every node of edges(_a, _b), roots being the least node of each component.

    A round joins every tree of pointers into one node, however deep it is: a chain of n ascending ids is one tree
    and takes log2(n) doublings. A root that took over nothing has a neighbour with a smaller root, so it goes in
    the next round: two rounds at least halve the nodes of every component. Each step's tables are written to the
    shared folder, and only numbers of rows come to the driver; ``rounds`` gets the number of doublings of each
    round. Nulls link nothing.
    """
    edges = _narrow(edges.filter("_a != _b"), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.select("_a", "_b").unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        taken = both.groupBy("_a").agg(F.least("_a", F.min("_b")).alias("_to")).select(F.col("_a").alias("_from"), "_to")
        taken, doublings = _doubled(_narrow(taken, "taken"))
        if rounds is not None:
            rounds.append(doublings)
        if labels is None:
            labels = taken.select(F.col("_from").alias("_node"), F.col("_to").alias("_root"))
        else:
            labels = labels.join(taken, F.col("_root") == F.col("_from"), "left").select("_node", F.coalesce("_to", "_root").alias("_root"))
        labels = _narrow(labels, "labels")
        one = edges.join(taken, F.col("_a") == F.col("_from")).select(F.col("_to").alias("_a"), "_b")
        two = one.join(taken, F.col("_b") == F.col("_from")).select("_a", F.col("_to").alias("_b"))
        edges = _narrow(two.filter("_a != _b").distinct(), "edges")
    return labels


def _doubled(taken: DataFrame) -> tuple[DataFrame, int]:
    """Pointers (_from, _to) led to the roots, and how many joins that took.

    Most trees are one step high; a pointer to a root is its own next, so one join finds that nothing moves.
    """
    joins = 0
    while True:
        joins += 1
        onward = taken.filter("_from != _to").select(F.col("_from").alias("_at"), F.col("_to").alias("_on"))
        taken = _narrow(
            taken.join(onward, F.col("_to") == F.col("_at"), "left")
            .select("_from", F.coalesce("_on", "_to").alias("_to"), F.col("_on").isNotNull().alias("_moved")), "taken",
        )
        if taken.filter("_moved").isEmpty():
            return taken.select("_from", "_to"), joins
