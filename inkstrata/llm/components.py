"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.llm.common import hot_above, join_totals
from inkstrata.session import materialize


def _shape(links: DataFrame) -> tuple[int, bool, int]:
    """How many links there are, whether they are more than stars, and the most that one node has."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.sum("above").alias("above"))
    between = (F.col("below") > 1) | (F.col("below") > 0) & (F.col("above") > 0)
    found = nodes.agg(F.sum("below").alias("rows"), F.count_if(between).alias("open"), F.max(F.col("below") + F.col("above")).alias("most")).first()
    return found["rows"] or 0, bool(found["open"]), found["most"] or 0


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``edges`` (``a, b``: long); the least node names it.

    Each round points the larger neighbours of a node, then the smaller ones, at the
    least of them, until only stars are left; a round is written to the shared
    folder. The centre of a large star is no hot key; where there is none, a round has
    no broadcast, as what is broadcast stays in the driver's memory for some time. Self links and repeated links are allowed; no links give no rows.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = materialize(links, "links")
    while True:
        rows, open_, most = _shape(links)
        if not open_:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        larger = both.where("v > u")
        met = join_totals(larger, least, "u", "n", 2 * rows) if most > hot_above(links.sparkSession, 2 * rows) else larger.join(least.hint("merge"), "u")
        large = met.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least.hint("merge"), "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        links = materialize(small.distinct(), "links")
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
