"""Connected components of a link table, as DataFrame joins.

No link, node or component reaches the driver: only row counts do. Every round is
checkpointed into the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import cut

SALTS = 16


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: long); component is
    the smallest node reachable. Self links, repeated and reversed links are allowed.
    Nulls are dropped; an empty table gives an empty table.

    Round 1..n, for every node with several smaller neighbours: it keeps the smallest,
    and the others are linked to that one instead. This keeps connectivity, lowers the
    links and ends when each node has at most one smaller neighbour, i.e. a forest whose
    parents are smaller than their children. Pointer jumping then halves the depth per
    round. A hub is reached as the *smaller* end of its links, which is never the
    grouping key; the pointer join salts it over ``SALTS`` partitions.
    """
    edges = cut(links.where("a <> b")
                .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct())
    while True:
        low = cut(edges.groupBy("v").agg(F.min("m").alias("p"), F.count(F.lit(1)).alias("n")))
        if low.where("n > 1").isEmpty():
            break
        moved = (edges.join(low.where("n > 1").select("v", "p"), "v").where("m <> p")
                 .select(F.col("m").alias("v"), F.col("p").alias("m")))
        edges = cut(low.select("v", F.col("p").alias("m")).unionByName(moved).distinct())
    tree = low.select(F.col("v").alias("node"), F.col("p").alias("parent"))
    while True:
        salted = tree.select(F.col("node").alias("up"), F.col("parent").alias("top"),
                             F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        stepped = cut(tree.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
                      .join(salted.withColumnRenamed("salt", "s2"),
                            (F.col("parent") == F.col("up")) & (F.col("salt") == F.col("s2")), "left")
                      .select("node", F.coalesce("top", "parent").alias("parent"),
                              F.col("top").isNotNull().alias("moved")))
        tree = stepped.select("node", "parent")
        if stepped.where("moved").isEmpty():
            break
    roots = tree.select(F.col("parent").alias("node")).distinct()
    return (tree.select("node", F.col("parent").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
