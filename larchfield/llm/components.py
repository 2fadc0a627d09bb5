"""Connected components of a graph of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larchfield.llm.common import materialise

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """The least node of each node's component: rows (node, root) of ``links`` (a, b).

    Alternates large-star and small-star steps, which hang nodes below smaller
    ones until every component is a star. Each step is a grouped minimum joined
    back, so that a node with very many links is never gathered. Rounds are
    written down; their number grows with the logarithm of a component's size.
    """
    links = materialise(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
        "links",
    )
    print_before = None
    for _ in range(MAX_ROUNDS):
        large = star(links, large=True)
        links = materialise(star(large, large=False), "links")
        print_now = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if print_now == print_before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select("b", "b").distinct()
            )
        print_before = print_now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def star(links: DataFrame, large: bool) -> DataFrame:
    """One star step on links with a > b."""
    down = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    around = down.union(links.select("b", "a")) if large else down
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if large:
        made = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return made.where("a <> b").distinct()
