"""Connected components by repeated contraction, each round a pair of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def components(links: DataFrame, folder: str) -> DataFrame:
    """``links(a, b)`` to ``(node, root)``: nodes share a root just when links connect them.

    In each round every node takes the name of the neighbour (or itself) that a hash of that round
    ranks first, and links are renamed, so the number of names falls by a factor and the rounds
    grow with the logarithm of the nodes, for long chains too. A hub's links are renamed by joins
    of two freshly read tables, which Spark can split. Links of a node with itself and null ends
    are left out; a node without links doesn't appear. Nothing is gathered on the driver.
    """
    links = written(
        links.select("a", "b").filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{folder}/links-0",
    )
    names, turn = None, 0
    while True:
        def rank(c, turn=turn):
            return F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))

        ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        taken = written(
            ends.groupBy("a").agg(F.min(rank("b")).alias("best"))
            .select(F.col("a").alias("old"), F.least("best", rank("a"))["v"].alias("new")),
            f"{folder}/names-{turn}",
        )
        if names is None:
            names = taken.select(F.col("old").alias("node"), F.col("new").alias("root"))
        else:
            names = names.join(taken, names["root"] == taken["old"], "left").select(
                "node", F.coalesce("new", "root").alias("root"))
        names = written(names, f"{folder}/roots-{turn}")
        ones = taken.select(F.col("old").alias("a"), F.col("new").alias("x"))
        others = taken.select(F.col("old").alias("b"), F.col("new").alias("y"))
        links = written(
            links.join(ones, "a").join(others, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            f"{folder}/links-{turn + 1}",
        )
        turn += 1
        if links.isEmpty():
            return names
