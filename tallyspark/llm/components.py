"""Connected components of a link table, by contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """node, component_id (the smallest node reachable) for every node of links (columns a, b).

    Each round maps a node to the first of itself and its neighbours and replaces the links' ends by
    that; links within one node go. The first round goes by the nodes' own order, which folds stars at
    once; later rounds go by a fresh hash order, which shortens chains by a constant factor each. The
    aggregates combine on the map side, so a node with very many links is no hot task.
    """
    links = common.stored(links.where("a != b").select("a", "b").distinct(), "links")
    kept, mapping, turn, empty = [links], None, 0, False
    while True:
        order = F.lit(0).cast("bigint") if turn == 0 else F.xxhash64(F.lit(turn), F.col("y"))
        both = links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select(F.col("b"), F.col("a")))
        both = both.select("x", F.struct(order.alias("o"), "y").alias("c"))
        own = F.struct((F.lit(0).cast("bigint") if turn == 0 else F.xxhash64(F.lit(turn), F.col("x"))).alias("o"), F.col("x").alias("y"))
        parents = both.groupBy("x").agg(F.min("c").alias("c")).select("x", F.least("c", own)["y"].alias("p"))
        parents = common.stored(parents, "parents")
        if mapping is None:
            mapping = parents.select(F.col("x").alias("node"), "p")
        else:
            mapping = mapping.join(parents.withColumnRenamed("p", "q"), mapping["p"] == F.col("x"), "left").select("node", F.coalesce("q", "p").alias("p"))
        kept.append(parents)
        nxt = links.join(parents.withColumnsRenamed({"x": "a", "p": "pa"}), "a").join(parents.withColumnsRenamed({"x": "b", "p": "pb"}), "b")
        nxt = nxt.where("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        links = common.stored(nxt, "links")
        kept.append(links)
        turn += 1
        if links.isEmpty():
            break
    # both are stored, so that the join stands alone and Spark can split a large component
    mapping = common.stored(mapping, "mapping")
    smallest = common.stored(mapping.groupBy("p").agg(F.min("node").alias("component_id")), "smallest")
    out = common.stored(mapping.join(smallest, "p").select("node", "component_id"), "components")
    common.release(*kept, mapping, smallest)
    return out
