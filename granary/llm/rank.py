"""Lexical ranking of all documents for a set of items, by dense tiles.

A pass over the texts keeps of each document its length and the item terms that it holds, as short arrays; counts of the
collection (documents, terms, documents a term) are aggregates of that table. Items are taken in blocks with a small
vocabulary of their own: a block's weights are a matrix of items by terms, a batch of documents is one of documents by the
same terms with their impacts, and BLAS multiplies the two in float64. Weights and impacts are whole numbers, an impact is
under 10^6 and a weight under WEIGHT; a tile has at most COLUMNS terms, so that every partial sum stays below 2^53 and is
exact. Tiles of a wider block are added as 64-bit integers.

Of each tile the k best documents of every item are taken with all ties of the k-th score settled by doc_id, and merged
with those that the task has; a task gives k rows an item at most, and a window ranks those of all tasks.

The vocabulary in a task is bounded: items are taken in groups of about GROUP distinct terms (16 bytes of hash each), with
a pass over the documents for each group. Only an item that has more terms alone goes beyond that, by its own text's size.

Defined results: null and empty texts hold no terms and count nowhere; very long texts count whole; every row counts as a
document, repeated rows too, and those with a null doc_id, which come last among equal scores; repeated terms of an item
count once; items whose terms no document holds have no rows; items with the same id are one item with the terms of all of
them; a null item_id is an item like others; empty tables give an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import by_bytes, keep
from .words import find_terms, text_slices

GROUP = 1 << 20  # distinct terms of items that a pass over the documents looks for
ITEMS = 64  # items of a block
COLUMNS = 4096  # terms of a tile
DOCS = 512  # documents of a tile
WEIGHT = 1 << 16  # above 1000 * ln(2 * 2^63)
assert COLUMNS * WEIGHT * 10**6 < 2**53
_LAST = np.iinfo(np.int64).max


class Vocabulary(NamedTuple):
    """Terms by two hashes, in order of the first; a term's number is its place."""

    h: np.ndarray
    g: np.ndarray

    def numbers(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Each hashed term's number, -1 where it is not among them."""
        if not len(self.h):
            return np.full(len(h), -1, dtype=np.int64)
        out = np.full(len(h), -1, dtype=np.int64)
        at, todo = np.searchsorted(self.h, h), np.arange(len(h))
        while len(todo):  # more than once only where terms share a first hash
            todo = todo[at[todo] < len(self.h)]
            todo = todo[self.h[at[todo]] == h[todo]]
            same = self.g[at[todo]] == g[todo]
            out[todo[same]] = at[todo[same]]
            todo = todo[~same]
            at[todo] += 1
        return out


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, h, g): every distinct term of every item."""

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                words = find_terms(batch.column("text"))
                h, g = words.hashes(2)
                ids = batch.column("item_id").take(pa.array(np.repeat(np.arange(batch.num_rows), words.counts)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(h.view(np.int64)), pa.array(g.view(np.int64))], ["item_id", "h", "g"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return by_bytes(rows).mapInArrow(run, "item_id long, h long, g long").distinct()


def postings(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, tf) of every row with a term: how many it has, and numbers and occurrences of those in the vocabulary."""

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text", 1 << 20):
                words = find_terms(batch.column("text"))
                counts = words.counts
                known = vocabulary.numbers(*words.hashes(2))
                row = np.repeat(np.arange(batch.num_rows), counts)[known >= 0]
                pair, tf = np.unique(row * max(1, len(vocabulary.h)) + known[known >= 0], return_counts=True)
                row, term = pair // max(1, len(vocabulary.h)), pair % max(1, len(vocabulary.h))
                some = np.flatnonzero(counts > 0)
                offsets = pa.array(np.append(np.searchsorted(row, some), len(row)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(some)), pa.array(counts[some].astype(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64)))],
                    ["doc_id", "n", "terms", "tf"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return by_bytes(rows).mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) of each term, in doubles."""
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 90 + (90 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Block(NamedTuple):
    """Some items: their ids, the numbers of the terms they use in order, and places of ones in the matrix of items by these."""

    ids: list
    terms: np.ndarray
    row: np.ndarray
    column: np.ndarray


def blocks(ids: list, item: np.ndarray, term: np.ndarray) -> list[Block]:
    """item and term are pairs, by item; items of a block follow each other."""
    out = []
    for at in range(0, len(ids), ITEMS):
        own = slice(*np.searchsorted(item, [at, at + ITEMS]))
        terms, column = np.unique(term[own], return_inverse=True)
        out.append(Block(ids[at : at + ITEMS], terms, item[own] - at, column))
    return out


class Best:
    """The k best (score, doc_id) of each item of a block so far, best first; fewer where fewer are above 0."""

    def __init__(self, items: int, k: int):
        self.k, self.score, self.doc = k, np.zeros((items, 0), dtype=np.int64), np.zeros((items, 0), dtype=np.int64)

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """scores: items by documents, whole numbers; ties of the k-th score are settled by the documents' ids."""
        both = np.concatenate([self.score, scores], axis=1)
        ids = np.concatenate([self.doc, np.broadcast_to(docs, scores.shape)], axis=1)
        if both.shape[1] > self.k:
            # all that reach the k-th score, then the least ids of those that just reach it
            reach = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k]
            wide = int((both >= np.maximum(reach, 1)[:, None]).sum(axis=1).max(initial=0))
            if wide < both.shape[1]:
                first = np.argsort(both < np.maximum(reach, 1)[:, None], axis=1, kind="stable")[:, :wide]
                both, ids = np.take_along_axis(both, first, 1), np.take_along_axis(ids, first, 1)
        order = np.lexsort((ids, -both), axis=1)[:, : self.k]
        self.score, self.doc = np.take_along_axis(both, order, 1), np.take_along_axis(ids, order, 1)


def tile_scores(block: Block, weight: np.ndarray, row: np.ndarray, column: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
    """Items by documents, exact: one product a tile of COLUMNS terms. row, column and impact are the documents' postings in the block's terms."""
    total = np.zeros((len(block.ids), docs), dtype=np.int64)
    for at in range(0, len(block.terms), COLUMNS):
        width = min(COLUMNS, len(block.terms) - at)
        here, there = (column >= at) & (column < at + width), (block.column >= at) & (block.column < at + width)
        if not here.any():
            continue
        left = np.zeros((len(block.ids), width))
        left[block.row[there], block.column[there] - at] = weight[block.terms[block.column[there]]]
        right = np.zeros((docs, width))
        right[row[here], column[here] - at] = impact[here]
        total += (left @ right.T).astype(np.int64)
    return total


def best_of_tasks(kept: DataFrame, of: list[Block], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_id, doc_id, score): the k best documents of each item within each task."""
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        best = [Best(len(b.ids), k) for b in of]
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS):
                batch = whole.slice(at, DOCS)
                ids = pa.compute.fill_null(batch.column("doc_id"), _LAST).to_numpy()
                terms = batch.column("terms").flatten().to_numpy()
                counts = pa.compute.list_value_length(batch.column("terms")).to_numpy()
                row = np.repeat(np.arange(batch.num_rows), counts)
                impact = impacts(batch.column("tf").flatten().to_numpy(), batch.column("n").to_numpy()[row], n_docs, n_terms)
                for b, found in zip(of, best):
                    column = np.minimum(np.searchsorted(b.terms, terms), len(b.terms) - 1)
                    own = b.terms[column] == terms
                    some, dense = np.unique(row[own], return_inverse=True)
                    if len(some):
                        found.add(tile_scores(b, weight, dense, column[own], impact[own], len(some)), ids[some])
        out = [(i, d, s) for b, found in zip(of, best) for i, docs, scores in zip(b.ids, found.doc.tolist(), found.score.tolist()) for d, s in zip(docs, scores) if s > 0]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([None if r[1] == _LAST else r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64())], schema=schema)

    return kept.mapInArrow(run, "item_id long, doc_id long, score long")


def _group(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The k best documents of the items of (item_id, h, g) pairs; the pairs of a group are bounded and come to the driver."""
    table = pairs.toArrow()
    h, g = (table.column(c).to_numpy().view(np.uint64) for c in ("h", "g"))
    terms = np.unique(np.stack([h, g], axis=1), axis=0) if len(h) else np.zeros((0, 2), dtype=np.uint64)
    vocabulary = Vocabulary(np.ascontiguousarray(terms[:, 0]), np.ascontiguousarray(terms[:, 1]))
    ids = sorted(set(table.column("item_id").to_pylist()), key=lambda i: (i is None, i))
    place = {i: n for n, i in enumerate(ids)}
    item = np.array([place[i] for i in table.column("item_id").to_pylist()], dtype=np.int64)
    order = np.argsort(item, kind="stable")
    of = blocks(ids, item[order], vocabulary.numbers(h[order], g[order]))

    kept = keep(postings(docs, vocabulary))
    n_docs, n_terms = kept.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary.h), dtype=np.int64)
    counted = kept.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()  # a row a term of the group at most
    df[counted.column("term").to_numpy()] = counted.column("count").to_numpy()
    return best_of_tasks(kept.where(F.size("terms") > 0), of, weights(df, n_docs), n_docs, max(1, n_terms), k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, group: int = GROUP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of each item with the highest scores above 0."""
    pairs = keep(item_terms(items))
    sizes = pairs.groupBy("item_id").agg(F.count("*").alias("n"))
    groups = max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // group))
    dealt = pairs.withColumn("of", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    found = reduce(DataFrame.unionByName, [_group(docs, dealt.where(F.col("of") == n).drop("of"), k) for n in range(groups)])
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
