"""What the operators share: kept tables, label folds, bounded labelled samples and small Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.storage import keep

__all__ = ["among", "by_bytes", "fold_of", "free_names", "held_out", "keep", "labelled_sample"]

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def by_bytes(df: DataFrame, most: str = "2m") -> DataFrame:
    """df, in a session whose Arrow batches end at about `most` bytes, however many rows that is.

    Rows are whole texts or blocks here, so a bound on rows alone lets batches grow with the texts.
    """
    df.sparkSession.conf.set(_BATCH_BYTES, most)
    return df


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns: those wanted, with underscores before them where df has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


FEW_IDS = 1 << 21  # ids of 8 bytes that are broadcast at most


def among(rows: DataFrame, key: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """rows whose key is among the kept `ids` (not among them: how="left_anti").

    The ids are counted first: up to FEW_IDS are broadcast, so that wide rows stay where they are; of more, both sides are shuffled.
    """
    few = ids.count() <= FEW_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, how)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    """True for rows no label is learnt from; a null id is not held out (and has no label)."""
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, y) of at most `per_class` labelled training documents of each class.

    Rows of fold 0 and rows without the label are left out; a document with several labels has the
    largest. The bound makes the ids small enough to broadcast: 2 * per_class integers.
    """
    known = labels.where(F.col(label).isNotNull() & (fold_of(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    return by_bytes(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"))
