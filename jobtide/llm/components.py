"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.plans.store import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of *links* (two columns ``a`` and ``b`` of a type that has an order).

    Each round maps every node to its least neighbour if that is smaller, follows the map twice more, and replaces the
    links by those between the images. Least means the smallest value in even rounds, which settles stars around a small
    node at once, and the smallest hash of round and value in odd rounds, which shortens paths of any order by a share.
    Rounds read and write tables in the shared folder; nothing is collected, and a node with very many links is only
    aggregated and joined. The root is some node of the component, the same for all its nodes.
    """
    spark = links.sparkSession
    edges = stored(links.where("a <> b").select("a", "b").distinct(), "cc-links")
    roots = None
    for turn in range(200):
        if edges.isEmpty():
            break
        rank = (lambda c: F.struct(c)) if turn % 2 == 0 else (lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), c), c))
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("best"))
        to = F.when(F.col("best") < rank(F.col("a")), F.col("best")[least.schema["best"].dataType.names[-1]]).otherwise(F.col("a"))
        step = least.select("a", to.alias("to"))
        for _ in range(2):
            onward = step.select(F.col("a").alias("to"), F.col("to").alias("next"))
            step = step.join(onward, "to").select("a", F.col("next").alias("to"))
        step = stored(step, "cc-step")
        if roots is None:
            roots = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            moved = step.select(F.col("a").alias("root"), "to")
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        roots = stored(roots, "cc-roots")
        left, right = step.select("a", F.col("to").alias("x")), step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = stored(edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-links")
    else:
        raise RuntimeError("no end after 200 rounds")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    return roots
