"""Connected components of a graph given by links, in Spark joins.

Alternates two steps until the links no longer change: every node's larger neighbours are linked to
the smallest node around it, then its smaller neighbours are. Links end as stars around the
smallest node of each component. A node's neighbours are never gathered: the steps are a minimum
per node (partial sums in each task) and a join back, which adaptive execution splits where hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import staged


def _towards_least(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("_m"))
    return links.join(least.withColumn("_m", F.least("a", "_m")), "a")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _towards_least(both).where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = _towards_least(down)
    own = joined.select("a", F.col("_m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(own).where("a <> b")


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node) for every node but the smallest ones.

    ``links`` has ``a`` and ``b`` in any order; loops and repeated links do no harm.
    """
    current = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    state = _state(current)
    while state[0]:
        current = staged(_small_star(_large_star(current)).distinct(), "links")
        before, state = state, _state(current)
        if tuple(before) == tuple(state):
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
