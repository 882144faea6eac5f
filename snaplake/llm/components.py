"""Connected components over an edge table, as joins and aggregates only.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014): every step replaces edges by
edges to the smallest known neighbour, and the table ends as one star per
component.  No neighbour list is ever collected; a node's minimum is a partial
aggregate, and the join that hands it to the node's edges is salted, so one
node may hold a third of all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.session import ensure_checkpoint_dir

#: How many ways a node's edges are dealt out in a step.
SALTS = 8


def _to_minimum(edges: DataFrame, mins: DataFrame) -> DataFrame:
    """Per edge (u, v): (v, minimum of u), joined on (u, salt)."""
    salted = mins.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of a link; component is the smallest node of its component.

    Links are undirected; NULL ends, self-links and repeats are ignored.  Any
    orderable type will do.  An empty table gives an empty result.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    a, b = F.col(src), F.col(dst)
    stars = (edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint())
    before, now = None, _signature(stars)
    while now != before and now[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = _to_minimum(both.filter(F.col("v") > F.col("u")), mins).distinct()
        mins = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _to_minimum(large, mins).filter(F.col("u") != F.col("v"))
        stars = small.unionByName(mins.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        before, now = now, _signature(stars)
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
