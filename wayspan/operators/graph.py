"""Connected components of links that may be many, by alternating stars.

Each round hangs every node's larger neighbours on its least one, then every node
and its smaller neighbours on the least of those.  Links between components never
arise, least nodes stay, and the number of rounds grows with the logarithm of the
longest path (Kiveris et al., "Connected Components in MapReduce and Beyond").
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import settled

log = logging.getLogger(__name__)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of the component of every node in the links (a, b).

    Any type with an order will do.  Least neighbours are settled before they go back
    to the links, so adaptive execution can split the join of a node with many links.
    No links: an empty table.
    """
    e = settled(links.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    rounds = 0
    while True:
        # large star: a node's larger neighbours move to the least of the node and all its neighbours
        below = settled(e.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"), F.count("*").alias("n")))
        moved = settled(e.join(below.select("u", "m"), F.col("lo") == F.col("u"), "left").select("hi", F.coalesce("m", "lo").alias("lo"), F.col("m").isNotNull().alias("moved")))
        if moved.where("moved").isEmpty() and below.where("n > 1").isEmpty():
            break  # every node hangs on one other at most, and that one on none
        rounds += 1
        # small star: a node and its smaller neighbours move to the least of these
        e = moved.drop("moved")
        root = settled(e.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("r")))
        other = e.join(root, F.col("hi") == F.col("u")).where("lo != r").select(F.col("lo").alias("hi"), F.col("r").alias("lo"))
        e = settled(other.unionByName(root.select(F.col("u").alias("hi"), F.col("r").alias("lo"))).distinct())
        log.info("components: round %d", rounds)
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct())
