"""Removal of repeated passages: every word covered by a 20-word window that also starts earlier.

Texts are dealt into blocks by document. Each block makes a sketch of its windows: the cells that they hash to,
a row of cells a hash function, as sorted gaps. Sketches are merged by ranges of cells, and each block learns
which of its cells another block uses too. A count-min estimate over the rows of cells never undercounts, so
every repeated window passes; the few others that pass are harmless. A second pass over the blocks groups only
those windows exactly, by 96-bit hashes: the first of a group stays, words under the others go.

Within a block all occurrences but the first are settled on the spot, so a window that stands in a third of all
documents brings one row a block to the exact grouping, however often it stands there. Rows that share a doc_id
and hold more text than a block are dealt over several, by ranges of their texts' hashes.

Defined results: null and empty texts have no words; documents of fewer than 20 words keep all; a very long text
counts whole and is a block of its own; order is by doc_id, null first, then by a hash of the text among rows that
share a doc_id, then by start; repeated rows are passages of each other; an empty table gives an empty result;
other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import by_bytes, free_names, keep
from .words import find_words, mix, text_slices, windows

WINDOW = 20
DEPTH = 2
BLOCK_BYTES = 4 << 20  # of text a block
TASK_BYTES = 64 << 20  # of text a task
CELLS_A_WINDOW = 4  # cells of each row for each window
SHARD_WINDOWS = 1 << 21  # windows a merged range of cells stands for; 2 * CELLS_A_WINDOW bytes each at most


def _pack(cells: np.ndarray) -> bytes:
    """Sorted distinct cells as variable-length gaps, the low bytes apart from the rest."""
    gaps = np.diff(cells, prepend=np.uint64(0)).astype(np.uint64)
    low = (gaps & np.uint64(0xFF)).astype(np.uint8).tobytes()
    high = (gaps >> np.uint64(8)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return np.uint32(len(cells)).tobytes() + low + zstandard.ZstdCompressor(level=1).compress(high)


def _unpack(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw[:4], dtype=np.uint32)[0])
    if not n:
        return np.zeros(0, dtype=np.uint64)
    low = np.frombuffer(raw[4 : 4 + n], dtype=np.uint8).astype(np.uint64)
    high = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[4 + n :]), dtype=np.uint8).reshape(4, n).T.copy().view("<u4")[:, 0]
    return np.cumsum(low + (high.astype(np.uint64) << np.uint64(8)), dtype=np.uint64)


def block_windows(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(words' bounds of each text, first word of each window, its two hashes), a slice of texts at a time."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    ptr, firsts, h1, h2 = [np.zeros(1, dtype=np.int64)], [], [], []
    for part in text_slices(batch, "text"):
        words = find_words(part.column(0))
        f, a, b = windows(words.hashes(2), words.ptr, WINDOW)
        base = ptr[-1][-1]
        firsts.append(f + base)
        h1.append(a)
        h2.append(b)
        ptr.append(words.ptr[1:] + base)
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate(ptr), np.concatenate(firsts or [np.zeros(0, dtype=np.int64)]), np.concatenate(h1 or [none]), np.concatenate(h2 or [none])


def _cells(h1: np.ndarray, h2: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (h1 if row == 0 else mix(h2, row)) >> np.uint64(64 - bits)


def _covered(n_words: int, firsts: np.ndarray) -> np.ndarray:
    """Words under a window that begins at one of `firsts`."""
    change = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(change, firsts, 1)
    np.add.at(change, firsts + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


class _Names(NamedTuple):
    """Helper columns of a block: place in the order of documents, hash of the text, block and salt."""

    doc: str
    hash: str
    block: str
    salt: str

    def ordered(self, block: pa.Table) -> pa.Table:
        """A block's rows by document; the hash of the text parts rows that share a doc_id."""
        return block.sort_by([(self.doc, "ascending"), (self.hash, "ascending")])


def _settle(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """True for the first occurrence of each window in a block."""
    order = np.argsort(h1, kind="stable")
    a, b = h1[order], h2[order]
    same = a[1:] == a[:-1]
    if (same & (b[1:] != b[:-1])).any():  # two windows under one first hash
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    first = np.ones(len(h1), dtype=bool)
    first[order[1:][same]] = False
    return first


def later_windows(blocks: DataFrame, expected: int, names: _Names) -> DataFrame:
    """(doc, salt, place): windows, by their place in their block's order, that start earlier in another block."""
    bits = min(40, max(16, int(CELLS_A_WINDOW * expected - 1).bit_length()))
    shard_bits = max(0, int(expected // SHARD_WINDOWS).bit_length())
    inner_bits = bits - shard_bits

    def sketch(block):
        _, _, h1, h2 = block_windows(names.ordered(block).column("text").combine_chunks())
        shards, packed = [], []
        for row in range(DEPTH):
            cells = np.unique(_cells(h1, h2, row, bits))
            cuts = np.searchsorted(cells >> np.uint64(inner_bits), np.arange(1, 1 << shard_bits, dtype=np.uint64))
            for shard, part in enumerate(np.split(cells, cuts)):
                if len(part):
                    shards.append(row << shard_bits | shard)
                    packed.append(_pack(part - (np.uint64(shard) << np.uint64(inner_bits))))
        number = block.column(names.block)[0].as_py()
        return pa.table({"shard": pa.array(shards, pa.int32()), "_block": pa.array([number] * len(shards), pa.int64()), "cells": pa.array(packed, pa.binary())})

    def merge(parts):
        numbers, cells = parts.column("_block").to_pylist(), [_unpack(c) for c in parts.column("cells").to_pylist()]
        count = np.zeros(1 << inner_bits, dtype=np.uint8)  # counters of blocks that use a cell; two is all that is asked
        for c in cells:
            c = c.astype(np.int64)
            count[c] = np.minimum(count[c] + 1, 2)
        common = [c[count[c.astype(np.int64)] > 1] for c in cells]
        found = [(n, _pack(c)) for n, c in zip(numbers, common) if len(c)]
        shard = parts.column("shard")[0].as_py()
        return pa.table({"_block": pa.array([n for n, _ in found], pa.int64()), "shard": pa.array([shard] * len(found), pa.int32()), "cells": pa.array([c for _, c in found], pa.binary())})

    asked = pa.schema([("h1", pa.int64()), ("h2_place", pa.int64()), ("doc", pa.int64()), ("salt", pa.int32())])

    def suspects(block, shared):
        if not block.num_rows or not shared.num_rows:
            return asked.empty_table()
        block = names.ordered(block)
        ptr, firsts, h1, h2 = block_windows(block.column("text").combine_chunks())
        there: list[list[np.ndarray]] = [[] for _ in range(DEPTH)]
        for shard, raw in sorted(zip(shared.column("shard").to_pylist(), shared.column("cells").to_pylist())):
            there[shard >> shard_bits].append(_unpack(raw) + (np.uint64(shard & ((1 << shard_bits) - 1)) << np.uint64(inner_bits)))
        places = np.flatnonzero(_settle(h1, h2))
        for row in range(DEPTH):  # the least of the counts counts: every row must know the window elsewhere
            if not there[row]:
                return asked.empty_table()
            merged = np.concatenate(there[row])
            own = _cells(h1[places], h2[places], row, bits)
            places = places[merged[np.minimum(np.searchsorted(merged, own), len(merged) - 1)] == own]
        text_of = np.searchsorted(ptr, firsts[places], side="right") - 1
        docs, salts = block.column(names.doc).to_numpy()[text_of], block.column(names.salt).to_numpy()[text_of]
        both = (h2[places] >> np.uint64(32) << np.uint64(32)) | places.astype(np.uint64)  # a block has fewer than 2**32 windows
        return pa.Table.from_arrays([pa.array(h1[places].view(np.int64)), pa.array(both.view(np.int64)), pa.array(docs), pa.array(salts, pa.int32())], schema=asked)

    sketches = blocks.groupBy(names.block).applyInArrow(sketch, "shard int, _block long, cells binary")
    shared = sketches.groupBy("shard").applyInArrow(merge, "_block long, shard int, cells binary")
    rows = blocks.groupBy(names.block).cogroup(shared.groupBy("_block")).applyInArrow(suspects, "h1 long, h2_place long, doc long, salt int")
    rows = rows.repartition("h1")  # else the window's keys would travel beside the packed column
    place = F.col("h2_place").bitwiseAND(F.lit(0xFFFFFFFF))
    order = F.row_number().over(Window.partitionBy("h1", F.shiftright("h2_place", 32)).orderBy("doc", "salt", place))
    return rows.withColumn("n", order).where("n > 1").select("doc", "salt", place.alias("place"))


def _kept_words(text: bytes | None, covered: np.ndarray) -> bytes:
    words = (text or b"").split()  # ASCII white space, as the word pattern has it
    return b" ".join(compress(words, (~covered).tolist()) if covered.any() else words)


def _salts(docs: DataFrame, doc: Column) -> DataFrame:
    """(doc, salts) of the ids whose rows together hold more text than a block; most tables have none."""
    sizes = docs.groupBy(doc.alias("doc")).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"))
    return keep(sizes.where((F.col("n") > 1) & (F.col("bytes") > BLOCK_BYTES)).select("doc", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("long").alias("salts")))


def _run(docs: DataFrame, outputs, schema: str) -> DataFrame:
    """Applies `outputs(block in order, word bounds, covered flags)` to each block."""
    names = _Names(*free_names(docs, "_doc", "_hash", "_block", "_salt"))
    id_, salts = free_names(docs, "_id", "_salts")
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    of = lambda doc, salt: F.pmod(F.xxhash64(doc, salt), F.lit(n_bytes // BLOCK_BYTES + 1))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_bytes // TASK_BYTES)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))  # null comes first
    heavy = _salts(docs, doc).select(F.col("doc").alias(id_), F.col("salts").alias(salts))
    # ranges of the hash, so that salts follow its order
    salt = F.shiftright((F.shiftright(names.hash, 33) + F.lit(1 << 30)) * F.coalesce(F.col(salts), F.lit(1)), 31).cast("int")
    known = docs.withColumns({names.doc: doc, names.hash: F.xxhash64("text")}).join(heavy, F.col(names.doc) == F.col(id_), "left")
    blocks = known.withColumn(names.salt, salt).withColumn(names.block, of(F.col(names.doc), F.col(names.salt))).drop(id_, salts)
    blocks = by_bytes(blocks).repartition(tasks, names.block)

    def finish(block, later):
        if not block.num_rows:
            return outputs(block, np.zeros(1, dtype=np.int64), np.zeros(0, dtype=bool))
        block = names.ordered(block)
        ptr, firsts, h1, h2 = block_windows(block.column("text").combine_chunks())
        gone = ~_settle(h1, h2)
        gone[later.column("place").to_numpy()] = True
        return outputs(block, ptr, _covered(int(ptr[-1]), firsts[gone]))

    later = later_windows(blocks, n_bytes // 6 + 1, names).select(of(F.col("doc"), F.col("salt")).alias("_block"), "place")
    return blocks.groupBy(names.block).cogroup(later.groupBy("_block")).applyInArrow(finish, schema)


def removed(docs: DataFrame) -> DataFrame:
    """The contract's digest: doc_id, n_words, n_removed, kept_sha256."""

    def digest(block, ptr, covered):
        texts = block.column("text").cast(pa.binary()).to_pylist()
        parts = [covered[a:b] for a, b in zip(ptr[:-1], ptr[1:])] if len(texts) else []
        return pa.table({
            "doc_id": block.column("doc_id"), "n_words": pa.array(np.diff(ptr) if len(texts) else [], pa.int64()), "n_removed": pa.array([int(p.sum()) for p in parts], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(_kept_words(t, p)).hexdigest() for t, p in zip(texts, parts)], pa.string())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _run(rows, digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the repeated passages cut out of `text`, and `n_chars`, if there, brought up to date.

    A text that loses nothing stays as it is; in others the kept words are joined by one space.
    """
    names = docs.columns

    def cut(block, ptr, covered):
        texts = block.column("text").to_pylist()
        parts = [covered[a:b] for a, b in zip(ptr[:-1], ptr[1:])] if len(texts) else []
        new = [_kept_words(t.encode(), p).decode() if p.any() else t for t, p in zip(texts, parts)]
        table = block.select(names).set_column(names.index("text"), "text", pa.array(new, block.schema.field("text").type))
        if "n_chars" in names:
            kind = block.schema.field("n_chars").type
            lengths = [len(n) if p.any() else c for n, p, c in zip(new, parts, block.column("n_chars").to_pylist())]
            table = table.set_column(names.index("n_chars"), "n_chars", pa.array(lengths, kind))
        return table

    return _run(docs, cut, docs.schema)
