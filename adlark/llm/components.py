"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import drop, stored


def _order(node: str, turn: int) -> Column:
    """What a node's neighbours are compared by: ids at first, then another random order each time."""
    return F.struct((F.col(node) if turn == 0 else F.xxhash64(F.lit(turn), F.col(node))).alias("key"), F.col(node).alias("node"))


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """Columns node and comp (the smallest node reachable) for every node of `links` (a, b) with another end, and the table's path.

    Each round contracts the links: a node goes over to the least of itself and its neighbours, both ends of each link are
    renamed, and loops and repeated links are dropped, so a link inside a group is looked at only until its ends have met.
    The first round goes by ids, in which groups around their least member meet at once; later ones go by a random order,
    which leaves at most three quarters of the nodes on average, whatever the shape. Self-links and repeated links do no
    harm; no links give no rows. Each round is a stored table; the driver gets one number from it.
    """
    spark = links.sparkSession
    rest, rest_path = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    labels, labels_path, turn = None, None, 0
    while labels is None or rest.limit(1).count():
        ends = rest.select(F.col("a").alias("node"), F.col("b").alias("other")).union(rest.select("b", "a"))
        least = ends.groupBy("node").agg(F.min(_order("other", turn)).alias("m")).select("node", F.least(_order("node", turn), F.struct(F.col("m.key").alias("key"), F.col("m.node").alias("node")))["node"].alias("up"))
        up, up_path = stored(least, "up")
        renamed = rest.join(up.select(F.col("node").alias("a"), F.col("up").alias("x")), "a").join(up.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        new, new_path = stored(renamed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a < b").distinct(), "links")
        if labels is None:
            labels, labels_path = up.select("node", F.col("up").alias("comp")), up_path
        else:
            step = labels.join(up.select(F.col("node").alias("comp"), "up"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
            labels, path = stored(step, "labels")
            drop(spark, labels_path, up_path)
            labels_path = path
        drop(spark, rest_path)
        rest, rest_path, turn = new, new_path, turn + 1
    drop(spark, rest_path)
    if turn > 1:  # names of groups came from random orders
        low, low_path = stored(labels.groupBy("comp").agg(F.min("node").alias("low")), "low")
        out, path = stored(labels.join(low, "comp").select("node", F.col("low").alias("comp")), "labels")
        drop(spark, labels_path, low_path)
        labels, labels_path = out, path
    return labels, labels_path
