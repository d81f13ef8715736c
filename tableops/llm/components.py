"""Connected components of a link table, by alternating large and small stars until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableops.scratch import Tables


def connected_components(links: DataFrame, tables: Tables) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest id that can be reached.

    A star takes only the smallest neighbour of each id, so no neighbourhood is gathered, and a joined hot id is split by
    adaptive execution. Each round is written to the shared folder, and rounds grow with the logarithm of the longest
    chain. Repeated links, self links and an empty table are fine; null ends are dropped.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL")
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = tables.put(edges, "edges")
    state, old = _state(edges), None
    while state != old:
        ends = edges.union(edges.select(F.col("v"), F.col("u")))
        least = ends.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = ends.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = tables.put(small.union(least).distinct(), "edges")
        state, old = _state(edges), state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1_000_003)).first())
