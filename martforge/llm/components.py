"""Connected components of a link table, by alternating large and small stars.

Every step is a minimum per node (summed up on the map side) and an equi-join on the node, which
adaptive execution splits where a node has very many links. Links are written to the shared folder
after each round; nothing is collected but two numbers that tell whether a round changed them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Component of every node that has a link to another one: id, component_id (its smallest node).

    Nulls and links of a node to itself are left out; repeated links do no harm; without links the
    result is empty.
    """
    e = (links.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = stored(e, "links")
    before = _state(e)
    while before[0]:
        # Large star: every larger neighbour of a node goes to the node's smallest neighbour.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        # Small star: every smaller neighbour of a node, and the node, go to its smallest neighbour.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
        e = stored(small.select("x.u", "x.v").where("u != v").distinct(), "links")
        now = _state(e)
        if now == before:
            break
        before = now
    # A star: every node but the centre has one link, to the centre.
    centre = e.select(F.col("v").alias("id"), F.col("v").alias("component_id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(centre).distinct()
