"""Mixing sources to target weights by capped water-filling.

A source's share of the total is its weight's; no source goes beyond `max_epochs` times its size, and what is
clipped goes to the others by weight, round by round, until none is above. A document is taken whole as many
times as its source's epochs have whole parts; the fractional part takes a seeded random subset of the
documents whose sizes come to that part.

Defined results: null and empty texts have size 0 and are taken for 0 words; very long texts count whole and are
taken whole; a null source is a source of its own, ordered last; repeated rows count as documents of their own;
documents of equal hash are taken in the order of doc_id, size and text; an empty table gives an empty result;
all columns pass through: where the input has one named as one of the mix's, the mix's has an underscore before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import global_rank, keep
from .shared import free_names

WORD = r"[^\x20\x09-\x0D]+"
DEFAULT_SEED = 20240611
BROADCAST_SOURCES = 50_000  # a plan row a source: some 5 MB at most


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(seed: int, key: Column) -> Column:
    """48 bits of an md5: the same number in every engine."""
    return F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), F.lit(12)), 16, 10).cast("long")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Adds `target` to (size, weight) rows; each round is one aggregate of a table with a row a source."""
    cap = F.col("size") * F.lit(float(max_epochs))
    clamped, level = -1, 0.0
    while True:
        above = F.col("weight") * F.lit(level) > cap if clamped >= 0 else F.lit(False)
        row = sources.agg(F.count_if(above).alias("n"), F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("clipped"), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("free")).first()
        if row.n == clamped or not row.free:
            level = level if row.free else float("inf")
            break
        clamped, level = row.n, (total - row.clipped) / row.free
    target = cap if level == float("inf") else F.least(cap, F.col("weight") * F.lit(level))
    return sources.withColumn("target", target.cast("double"))


def plan(docs: DataFrame, share: float, max_epochs: float, weights: tuple[float, ...]) -> DataFrame:
    """(source, source_size, source_rows, target): sources by code point, null last, weigh in turn by `weights`."""
    sizes = docs.select(F.col("source"), n_words(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("source_rows"))
    in_order = keep(global_rank(sizes, "_rank", F.col("source").isNull(), F.col("source")))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    in_order = in_order.withColumn("weight", weight)
    total = in_order.agg(F.sum("size")).first()[0] or 0
    filled = water_fill(in_order, share * total, max_epochs)
    return filled.select("source", F.col("size").alias("source_size"), "source_rows", "target")


ADDED = ("size", "source_size", "target", "times")


def mix(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0, weights: tuple[float, ...] = (3, 1, 2), seed: int = DEFAULT_SEED, stratum_rows: int = 256) -> DataFrame:
    """docs with size, source_size, target and times: how often the mix takes each document.

    The fractional part is settled within strata of about `stratum_rows` documents of one source, dealt by a
    seeded hash, so that a source with a third of all rows is spread over all tasks. In hash order a document
    is taken once more while at least half of it fits in its stratum's part: each stratum is off by half a
    document at most, and strata err to both sides. Rows without a doc_id, and those of an id that would fill a
    stratum by itself, are dealt by their texts too.
    """
    size, source_size, target, times = free_names(docs, *ADDED)
    own, rows, many, epochs, order, stratum = free_names(docs, "_source", "_rows", "_many", "_epochs", "_hash", "_stratum")
    sources = plan(docs, share, max_epochs, weights)
    few = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    sources = sources.select(F.col("source").alias(own), F.col("source_size").alias(source_size), F.col("target").alias(target), F.col("source_rows").alias(rows))
    joined = docs.withColumn(size, n_words(F.col("text"))).join(F.broadcast(sources) if few else sources, F.col("source").eqNullSafe(F.col(own))).drop(own)
    crowded = keep(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > stratum_rows) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(many)))
    joined = joined.join(crowded, F.col("doc_id") == F.col(many), "left")
    by_text = F.when(F.col("doc_id").isNull() | F.col(many).isNotNull(), F.pmod(F.xxhash64("text"), F.lit(1 << 40))).otherwise(F.lit(0))
    dealt = joined.withColumns({epochs: F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0)), order: seeded_hash(seed, F.col("doc_id"))})
    dealt = dealt.withColumn(stratum, F.pmod(seeded_hash(seed + 1, F.col("doc_id")) + by_text, F.ceil(F.col(rows) / stratum_rows)))
    together = Window.partitionBy("source", stratum)
    part = F.sum(size).over(together) * (F.col(epochs) - F.floor(epochs))
    running = F.sum(size).over(together.orderBy(order, "doc_id", size, F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = F.floor(epochs) + (running - F.col(size) / 2 <= part).cast("int") * (F.col(epochs) > F.floor(epochs)).cast("int")
    return dealt.withColumn(times, taken.cast("int")).drop(many, epochs, order, stratum, rows)


def repeated(mixed: DataFrame, columns: list[str], times: str = "times") -> DataFrame:
    """The mix itself: every document as often as it is taken."""
    (copy,) = free_names(mixed, "_copy")
    return mixed.where(F.col(times) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*columns)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs repeated or left out until its sources stand at their targets; its own columns only."""
    return repeated(mix(docs), docs.columns, free_names(docs, *ADDED)[-1])


def mixing(docs: DataFrame) -> DataFrame:
    """The contract's digest."""
    return mix(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times")
