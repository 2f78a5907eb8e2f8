"""Rows of one key in blocks of bounded size, and the pairs of blocks that must meet, dealt out one by one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep


def in_blocks(rows: DataFrame, keys: list[str], size: int, order: str, *columns: str, weight: Column | None = None, most: int = 4 << 20) -> DataFrame:
    """(keys, block, rows): arrays of about `size` rows of one key, or `most` of their weight if that comes first.

    Rows are dealt by a hash of `order`, so the rows of one key spread over as many blocks as they need. The
    blocks of each key are counted in a table of their own, which leaves a hot key's rows to Spark to split.
    """
    wanted = F.ceil(F.count("*") / size)
    if weight is not None:
        wanted = F.greatest(wanted, F.ceil(F.sum(weight) / most))
    counts = keep(rows.groupBy(*keys).agg(wanted.alias("_blocks")))
    dealt = rows.join(counts, keys).withColumn("block", F.pmod(F.xxhash64(order, F.lit(7)), F.col("_blocks")))
    return dealt.groupBy(*keys, "block").agg(F.collect_list(F.struct(order, *columns)).alias("rows"))


def block_pairs(blocks: DataFrame, keys: list[str], *also: str, where: str = "true") -> DataFrame:
    """(also, rows, rows2): every block with itself, and every two blocks of a key once.

    Pairs of block numbers are made first, from a table without rows; each pair then fetches its two blocks, so
    the pairs of a hot key lie in as many tasks as it has blocks. `where` may compare block's columns with those
    of block2, which have a 2 behind their names.
    """
    numbers = blocks.drop("rows")
    second = numbers.select(*keys, *[F.col(c).alias(f"{c}2") for c in numbers.columns if c not in keys])
    pairs = numbers.join(second, keys).where("block < block2").where(where)
    # each block is the second of about half of its pairs
    swapped = (F.col("block") + F.col("block2")) % 2 == 1
    pairs = pairs.select(*keys, F.when(swapped, F.col("block2")).otherwise(F.col("block")).alias("block"), F.when(swapped, F.col("block")).otherwise(F.col("block2")).alias("block2"))
    apart = pairs.join(blocks.select(*keys, "block", *[c for c in also if c not in keys], "rows"), [*keys, "block"]).join(blocks.select(*keys, F.col("block").alias("block2"), F.col("rows").alias("rows2")), [*keys, "block2"])
    alone = blocks
    for c in numbers.columns:
        alone = alone.withColumn(f"{c}2", F.col(c)) if c not in keys else alone
    alone = alone.where(where)
    return alone.select(*also, "rows", F.col("rows").alias("rows2")).unionByName(apart.select(*also, "rows", "rows2"))


def meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(rows, rows2): every block of `left` with every block of `right` under one key, dealt like block_pairs()."""
    numbers = left.select(*keys, "block").join(right.select(*keys, F.col("block").alias("block2")), keys)
    first = numbers.join(left.select(*keys, "block", "rows"), [*keys, "block"])
    return first.join(right.select(*keys, F.col("block").alias("block2"), F.col("rows").alias("rows2")), [*keys, "block2"]).select("rows", "rows2")
