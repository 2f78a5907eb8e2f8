"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in (a, b) edges: component is the least id that is reachable.

    Each round is two shuffles with a minimum per id combined before them; the edge table is written after
    each, and only its row count and a checksum come to the driver. The number of rounds grows with the
    logarithm of the largest component.
    """
    a, b = F.col("a"), F.col("b")
    now = keep(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _fingerprint(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        now = keep(small, rows=2 * seen[0])  # a round makes two edges of one at most
        new = _fingerprint(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
