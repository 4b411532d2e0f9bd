"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """Label the nodes of ``links`` (a long, b long): returns node, root, one root for each component.

    In each round a node takes the neighbour (or itself) of least hash as its
    parent and the links move up to the parents; what joins a node to itself
    goes. Hashes put chains in random order, so that the number of nodes
    falls by a constant factor a round, however the ids are sorted. A hub's
    minimum is summed up on the map side, its link rows are an ordinary join
    whose large partitions Spark may split. Each round's tables are written to
    the shared folder; nothing but "are there links left" reaches the driver.

    Links to oneself, repeated links and either direction are fine; links with
    a null end are ignored. No links, no rows.
    """
    edges = cut(
        links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min(ranked("b")).alias("best"))
        parents = cut(
            parents.select("node", F.least("best", ranked("node"))["v"].alias("parent")), "parents"
        )
        steps.append(parents)
        up = edges.join(parents.toDF("a", "pa"), "a").join(parents.toDF("b", "pb"), "b").filter("pa <> pb")
        edges = cut(up.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = None
    for parents in reversed(steps):
        if roots is None:
            roots = parents.select("node", F.col("parent").alias("root"))
        else:
            above = roots.toDF("parent", "above")
            roots = cut(
                parents.join(above, "parent", "left").select("node", F.coalesce("above", "parent").alias("root")), "roots"
            )
    return roots
