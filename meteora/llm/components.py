"""Distributed union-find: connected components of a table of links.

Alternating large-star and small-star steps on DataFrames (Kiveris et al.,
"Connected Components in MapReduce and Beyond", 2014).  Each step is a
grouped minimum, combined before its shuffle, joined back to the links, so a
hub with very many links is never gathered in one task: the sort-merge join
splits its rows.  Every round is written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import drop_stored, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link, from links (u, v).

    component is the smallest node reachable.  Links may repeat, go either
    way, or join a node to itself (ignored); null ends are ignored.
    """
    e = stored(edges.select("u", "v").where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .distinct(), "links")
    seen = _state(e)
    while seen[0]:
        nxt = stored(_small_star(_large_star(e)), "links")
        now = _state(nxt)
        drop_stored(e)
        e = nxt
        if now == seen:
            break
        seen = now
    # stable: every node points at the smallest of its component
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
