"""Search of leads by an index of trigrams with their places.

The index has a row for each three characters in a row's lower-cased text, in the order of the trigrams, so that a filter on
a few of them reads a few ranges of its files. Postings say where a trigram stands: a text holds q where q's trigrams follow
each other, which the postings tell by themselves, and no text is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .crm import search_leads

GRAM = 3


def searched_text(columns: list[str]) -> Column:
    """What search_leads() looks into."""
    return F.lower(F.concat_ws("\x01", *[F.col(c).cast("string") for c in columns]))


def write_search_index(leads: DataFrame, path: str, columns: list[str], key: str = "org_nr") -> None:
    """(gram, key, place) of every trigram of every row; rows with fewer characters have none. Keys are unique."""
    text = leads.select(F.col(key).alias("key"), searched_text(columns).alias("text")).where(F.length("text") >= GRAM)
    each = text.select("key", "text", F.explode(F.sequence(F.lit(1), F.length("text") - GRAM + 1)).alias("place"))
    postings = each.select(F.substring(F.col("text"), F.col("place"), F.lit(GRAM)).alias("gram"), "key", "place")
    postings.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key").write.mode("overwrite").parquet(path)


def search_index(spark: SparkSession, path: str, q: str) -> DataFrame:
    """(key) of the rows that hold q, of three characters or more, in any case."""
    low = q.lower()
    if len(low) < GRAM:
        raise ValueError(f"the index answers for {GRAM} characters or more; shorter ones take search_leads()")
    offsets: dict[str, list[int]] = {}
    for at in range(len(low) - GRAM + 1):
        offsets.setdefault(low[at : at + GRAM], []).append(at)
    where_in_q = F.coalesce(*[F.when(F.col("gram") == gram, F.array(*map(F.lit, places))) for gram, places in offsets.items()])
    met = spark.read.parquet(path).where(F.col("gram").isin(list(offsets)))
    starts = met.select("key", "place", F.explode(where_in_q).alias("at")).groupBy("key", (F.col("place") - F.col("at")).alias("start")).agg(F.count("*").alias("n"))
    return starts.where(F.col("n") == len(low) - GRAM + 1).select("key").distinct()


def find_leads(leads: DataFrame, path: str, q: str, columns: list[str], key: str = "org_nr") -> DataFrame:
    """Rows of search_leads(): by the index at `path`, or by a scan where q is too short for it."""
    if len(q.lower()) < GRAM:
        return search_leads(leads, q, columns)
    return leads.join(search_index(leads.sparkSession, path, q).withColumnRenamed("key", key), key, "left_semi").select(*leads.columns)
