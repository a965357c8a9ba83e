"""Connected components of a graph given by its edges, without gathering a component anywhere."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.workspace import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b`` of one orderable type); ``root`` is the
    smallest node of the component.

    Alternates two steps until nothing changes. The large step hangs the larger neighbours of a node below its
    smallest neighbour, the small step the smaller ones and the node itself. Minima are combined before the shuffle,
    the joins are plain ones that adaptive execution can split at a hub, and a written table ends each round.
    Loops and repeated edges do no harm, edges with a NULL end are none.
    """
    pairs = materialize(_ordered(edges.select("a", "b")), "edges")
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        hung = both.join(low, "a").where(F.col("b") > F.col("a"))
        pairs = _ordered(hung.select(F.col("b").alias("a"), F.least("a", "low").alias("b")))
        low = pairs.groupBy("a").agg(F.min("b").alias("low"))
        hung = pairs.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        pairs = _ordered(hung.unionByName(low.select("a", F.col("low").alias("b"))))
        pairs = materialize(pairs, "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.col("a").eqNullSafe(F.col("b")).alias("loop"))
    return ends.where(~F.col("loop") & F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b").distinct()
