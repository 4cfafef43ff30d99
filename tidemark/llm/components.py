"""Connected components of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import kept


ROWS_A_TASK = 500_000


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many tasks as its rows ask for: a late round has few."""
    return df.coalesce(max(1, -(-rows // ROWS_A_TASK)))


def _star(links: DataFrame, both: bool, rows: int) -> DataFrame:
    """Point each node's neighbours at the least node among it and them.

    Large stars look at all neighbours and move the larger ones; small stars look at the smaller
    ones. The minima combine before their shuffle and are stored, so the join that hands them out
    runs between plain exchanges and a node with very many links is split.
    """
    down = links.where("a > b")
    if both:
        ways = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = ways.join(kept(_packed(least, rows), "least"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = kept(_packed(down.groupBy("a").agg(F.min("b").alias("m")), rows), "least")
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    moved = moved.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return kept(_packed(moved.distinct(), rows), "links")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label): each node of the links (a, b) with the least node it can reach.

    The number of rounds grows with the logarithm of the longest chain. Each round's links are
    stored; only their count and checksum reach the driver.
    """
    links = kept(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while (now := _state(links)) != before:
        before = now
        links = _star(_star(links, True, now[0]), False, now[0])
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
