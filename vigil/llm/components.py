"""Connected components of a link table, as DataFrame joins (alternating stars).

Each round takes every node's smallest neighbour ``m``; the large-star step
links the node's larger neighbours to ``m``, the small-star step links its
smaller neighbours and itself to ``m``.  The links become stars around each
component's smallest node in a number of rounds that grows with the logarithm of
the nodes.  A hub's many links are aggregated before the shuffle and joined
back by an ordinary join, which adaptive execution splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.spark import frozen

_MAX_ROUNDS = 64


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("src", "dst").unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("_m")).select("src", F.least("src", "_m").alias("_m"))
    return (
        both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("_m").alias("dst")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("src").agg(F.min("dst").alias("_m"))
    moved = links.join(least, "src").where("dst <> _m").select(F.col("dst").alias("src"), F.col("_m").alias("dst"))
    return moved.unionByName(least.select("src", F.col("_m").alias("dst"))).distinct()


def component_ids(links: DataFrame) -> DataFrame:
    """``id, component`` for every node of ``links`` (``src`` > ``dst``) but the
    components' smallest nodes, which have themselves as component and no row."""
    links = frozen(links.select("src", "dst").distinct())

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first())

    before = state(links)
    for _ in range(_MAX_ROUNDS):
        if before[0] == 0:
            break
        links = frozen(_small_star(_large_star(links)))
        now = state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {_MAX_ROUNDS} rounds")
    return links.select(F.col("src").alias("id"), F.col("dst").alias("component"))
