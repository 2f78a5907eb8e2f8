"""Near-duplicate documents by min-max hashing.

A document's set is its distinct five-word shingles, each named by 128 bits of hash over the bytes of its words.
Each of 63 permutations gives two values of its signature, the least and the greatest hash, so 126 values cost
63 evaluations; both agree between two sets with the probability of their similarity. Bands of values find
candidates: plan() takes the widest bands of which a pair at the asked similarity shares none with a probability
of 1e-6 at most (25 bands of five values and 4e-7 at 0.85, 31 of four and 8e-8 at 0.80). Candidates are confirmed
on full sets.

Copies of one set are one node throughout. In every bucket the members are compared with the bucket's least
document, and, where very many are not known to be connected, with further hubs, one a round as long as that helps; hubs
are the same in buckets with the same members. The members that are left over then meet in blocks of bounded size, by rows and by
bytes, each pair of blocks by itself. Only links that connect what its task has not yet connected come out, so no link
that matters is lost to a bucket's size, and a bucket's pairs are never listed.

Defined results: documents without words or text have 0 shingles and are their own component; very long texts
count whole, with all of their shingles; rows with the same doc_id are one document of the table, linked by the
text of any of them (one_of_each() counts every row by itself); a null doc_id has a null component and is kept;
ties go to the smallest doc_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_pairs, in_blocks
from .components import components
from .shared import among, by_bytes, free_names, keep
from .words import find_words, mix, short_texts, text_slices, windows

SHINGLE = 5
PERMUTATIONS = 63
BLOCK = 256  # members of a bucket that are compared at a time, and of a hub's salt
ROUNDS, MEETINGS = 8, 16_384  # further hubs, where members would meet more others than that in blocks, as long as they help
UNSHARED, UNDER = 1e-6, 1e-7  # chances that a pair at the asked similarity shares no band, or has fewer agreeing values than asked
_rng = np.random.default_rng(85)
_FACTORS = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _rng.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
SIGNATURES = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, signature binary"


class Plan(NamedTuple):
    bands: int
    rows: int
    agree: int  # equal values of two signatures; pairs with fewer are no candidates in the second round


def plan(percent: int) -> Plan:
    """Bands and the least agreement that keep pairs at `percent` but for UNSHARED and UNDER."""
    values, s = 2 * PERMUTATIONS, percent / 100
    wide = [r for r in range(1, values + 1) if 0 < s <= 1 and (1 - s**r) ** (values // r) <= UNSHARED]
    if not wide:
        raise ValueError(f"{values} values do not find pairs at a similarity of {percent} percent")
    agree, under = 0, (1 - s) ** values
    while under <= UNDER and agree < values:
        agree += 1
        under += math.comb(values, agree) * s**agree * (1 - s) ** (values - agree)
    return Plan(values // wide[-1], wide[-1], agree)


class Sets(NamedTuple):
    h: np.ndarray  # two hashes of each distinct shingle, by text and then by h
    g: np.ndarray
    bounds: np.ndarray  # shingles bounds[i] to bounds[i + 1] belong to text i

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.bounds[i], self.bounds[i + 1])
        return self.h[own], self.g[own]


def shingle_sets(texts: pa.Array) -> Sets:
    words = find_words(texts, lower=True)
    lanes, counts = words.hashes(2), words.counts
    _, h, g = windows(lanes, words.ptr, SHINGLE)
    text_of = np.repeat(np.arange(len(counts)), np.maximum(counts - (SHINGLE - 1), 0))
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = short_texts(lanes, words.ptr, short, SHINGLE)
        h, g, text_of = np.concatenate([h, whole[0]]), np.concatenate([g, whole[1]]), np.concatenate([text_of, short])
    order = np.lexsort((h, text_of))
    again = _repeats(h, text_of, order)
    if (g[order[1:]] != g[order[:-1]])[again].any():  # two shingles under one first hash
        order = np.lexsort((g, h, text_of))
        again = _repeats(h, text_of, order) & (g[order[1:]] == g[order[:-1]])
    order = order[np.concatenate([[True], ~again])] if len(order) else order
    return Sets(h[order], g[order], np.searchsorted(text_of[order], np.arange(len(counts) + 1)))


def _repeats(h: np.ndarray, text_of: np.ndarray, order: np.ndarray) -> np.ndarray:
    a, b = order[:-1], order[1:]
    return (h[b] == h[a]) & (text_of[b] == text_of[a])


def common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Shingles that two sets share, by both hashes."""
    if not len(a[0]) or not len(b[0]):
        return 0
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    return int(((a[0][at] == b[0]) & (a[1][at] == b[1])).sum())


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], percent: int) -> bool:
    shared = common(a, b)
    return 100 * shared >= percent * (len(a[0]) + len(b[0]) - shared)


def min_max(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Signatures (texts x 126 values) of the non-empty sets that `bounds` cuts out."""
    starts = bounds[:-1]
    out = np.empty((len(starts), 2 * PERMUTATIONS), dtype=np.uint64)
    for p in range(PERMUTATIONS):
        v = (sets ^ _MASKS[p]) * _FACTORS[p]
        out[:, p] = np.minimum.reduceat(v, starts)
        out[:, PERMUTATIONS + p] = np.maximum.reduceat(v, starts)
    return out


def signatures(docs: DataFrame, bands_of: int, rows_of: int) -> DataFrame:
    """Set size, a 128-bit name of the set, band keys and a 16-bit signature of every whole text."""

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sets = shingle_sets(batch.column("text"))
                n = np.diff(sets.bounds)
                some = np.flatnonzero(n > 0)
                s1, s2 = (np.zeros(len(n), dtype=np.uint64) for _ in range(2))
                bands: list = [[]] * len(n)
                signature: list = [b""] * len(n)
                if len(some):
                    inner = np.append(sets.bounds[some], sets.bounds[-1])
                    s1[some] = np.add.reduceat(mix(sets.h, 21), inner[:-1])
                    s2[some] = np.add.reduceat(mix(sets.g, 22), inner[:-1])
                    values = min_max(sets.h, inner)
                    keys = np.empty((len(some), bands_of), dtype=np.uint64)
                    for b in range(bands_of):
                        key = np.full(len(some), b + 1, dtype=np.uint64)
                        for r in range(rows_of):
                            key = mix(key ^ values[:, b * rows_of + r], 3)
                        keys[:, b] = key
                    small = mix(values, 5).astype(np.uint16)
                    for i, own, bits in zip(some.tolist(), keys.view(np.int64).tolist(), small):
                        bands[i], signature[i] = own, bits.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(bands, pa.list_(pa.int64())), pa.array(signature, pa.binary())],
                                                 ["doc_id", "n_shingles", "s1", "s2", "bands", "signature"])

    return by_bytes(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SIGNATURES)


def agreeing(pairs: DataFrame, reps: DataFrame, agree: int) -> DataFrame:
    """The (a, b) pairs whose signatures have `agree` equal values at least; no text travels for the others."""
    sides = [reps.select(F.col("id").alias(c), F.col("signature").alias(f"of_{c}")) for c in ("a", "b")]

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(batch.num_rows, 2 * PERMUTATIONS) for c in ("of_a", "of_b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= agree))

    return by_bytes(pairs.join(sides[0], "a").join(sides[1], "b")).select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long").distinct()


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, most: int) -> DataFrame:
    """The (a, b) pairs, of which there are `most` at most, whose full sets have 100 * intersection >= percent * union.

    Pairs gather at b in salts of about BLOCK members, each with a copy of b's text, which comes first; a task
    holds one b's set at a time.
    """
    pairs = keep(pairs, rows=most)
    salts = keep(pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("salts")), rows=most)
    members = pairs.join(salts, "b").select(F.col("a").alias("doc_id"), "b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"))
    hubs = salts.select(F.col("b").alias("doc_id"), "b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rows = members.withColumn("hub", F.lit(False)).unionByName(hubs.withColumn("hub", F.lit(True))).join(texts, "doc_id")

    def run(batches):
        at, hubs_of = object(), []
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sets = shingle_sets(batch.column("text"))
                out_a, out_b = [], []
                for i, (doc, b, salt, hub) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "b", "salt", "hub")))):
                    if (b, salt) != at:
                        at, hubs_of = (b, salt), []
                    if hub:
                        hubs_of.append(tuple(x.copy() for x in sets.of(i)))
                    elif any(similar(other, sets.of(i), percent) for other in hubs_of):
                        out_a.append(doc)
                        out_b.append(b)
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return rows.repartition("b", "salt").sortWithinPartitions("b", "salt", F.desc("hub")).select("doc_id", "b", "salt", "hub", "text").mapInArrow(run, "a long, b long").distinct()


def _sizes_allow(x: str, y: str, percent: int):
    return 100 * F.least(F.col(x), F.col(y)) >= percent * F.greatest(F.col(x), F.col(y))


def _labels(links: DataFrame, most: int) -> DataFrame:
    """(id, label): ids with one label are connected; two steps along the links stand in for whole components."""
    one = links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
    two = one.select(F.col("id").alias("label"), F.col("label").alias("next"))
    return keep(one.join(two, "label", "left").select("id", F.coalesce("next", "label").alias("label")), rows=most)


def _set_rows(texts: DataFrame) -> DataFrame:
    """(doc_id, shingles): the two hashes of each text's distinct shingles as bytes."""

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sets = shingle_sets(batch.column("text"))
                raw = [b"".join(x.tobytes() for x in sets.of(i)) for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())], ["doc_id", "shingles"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles binary")


def _open_members(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """((key, band, id, n_shingles, label, lo) of buckets that hold several labels, their rows, pairs in their buckets).

    The bucket's first hub is left out: it has met all others. lo is the bucket's least label.
    """
    m = members.where("id != hub").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    open_ = keep(m.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).where("lo != hi").select("key", "lo", "n"))
    size = open_.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2), F.lit(0.0))).first()
    return keep(m.join(open_, "key").select("key", "band", "id", "n_shingles", "label", "lo")), size[0], size[1]


def _connect(members: DataFrame, links: DataFrame, reps: DataFrame, texts: DataFrame, percent: int, how: Plan, most: int) -> tuple[DataFrame, DataFrame]:
    """(links, members of buckets that are still open) after as many further hubs as it takes to leave few meetings.

    A round's hub of a bucket is the member with the least hash that is not under the bucket's least label. Where
    most pairs of a group are similar, each round connects a large part of what the rounds before have left.
    """
    m, rows, pairs = _open_members(members, _labels(links, most))
    for number in range(ROUNDS):
        if pairs <= MEETINGS * rows:
            break
        order = F.xxhash64("id", F.lit(number))
        hubs = keep(m.where("label != lo").groupBy("key").agg(F.min_by(F.struct("id", "label", "n_shingles"), order).alias("h")).select("key", F.col("h.id").alias("b"), F.col("h.label").alias("of"), F.col("h.n_shingles").alias("size")))
        asked = m.join(hubs, "key").where("id != b and label != of").where(_sizes_allow("n_shingles", "size", percent)).select(F.col("id").alias("a"), "b").distinct()
        links, before = keep(links.unionByName(confirm(agreeing(asked, reps, how.agree), texts, percent, rows))), pairs
        m, rows, pairs = _open_members(members, components(links).withColumnRenamed("component", "label"))
        if pairs > 0.9 * before:  # the rest is not linked, or not by way of hubs
            break
    return links, m


def _across_labels(m: DataFrame, reps: DataFrame, texts: DataFrame, percent: int, agree: int) -> DataFrame:
    """Confirmed (a, b) links that connect a bucket's members under different labels.

    Blocks of a bucket meet two at a time and hold their members' sets. A pair is looked at in the first band
    that it shares, unless links found before in the same task have connected it.
    """
    wanted = m.select("id").distinct()
    sets = _set_rows(texts.join(wanted.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")).withColumnRenamed("doc_id", "id")
    held = keep(reps.join(wanted, "id").select("id", "bands", "signature").join(sets, "id"))
    rows = m.select("key", "band", "id", "label").join(held, "id")
    keys = ["key", "band"]
    blocks = in_blocks(rows, keys, BLOCK, "id", "label", "bands", "signature", "shingles", weight=F.octet_length("shingles") + F.octet_length("signature"))
    labels_of = F.transform("rows", lambda x: x["label"])
    blocks = keep(blocks.withColumns({"lo": F.array_min(labels_of), "hi": F.array_max(labels_of)}))
    met = block_pairs(blocks, keys, "band", where="not (lo = hi and lo2 = hi2 and lo = lo2)")

    def run(batches):
        for batch in batches:
            out_a, out_b = [], []
            for band, left, right in zip(batch.column("band").to_pylist(), batch.column("rows"), batch.column("rows2")):
                a, b = _Block(left.values), _Block(right.values)
                known = _Joined()
                for i in range(len(a.ids)):
                    # an earlier band in common has seen the pair
                    go = (b.labels != a.labels[i]) & (b.ids != a.ids[i]) & ~(b.bands[:, :band] == a.bands[i, :band]).any(axis=1)
                    go &= 100 * np.minimum(b.sizes, a.sizes[i]) >= percent * np.maximum(b.sizes, a.sizes[i])
                    at = np.flatnonzero(go)
                    for j in at[(b.signatures[at] == a.signatures[i]).sum(axis=1) >= agree].tolist() if len(at) else ():
                        if known.apart(a.labels[i], b.labels[j]) and similar(a.set(i), b.set(j), percent):
                            known.join(a.labels[i], b.labels[j])
                            out_a.append(max(a.ids[i], b.ids[j]))
                            out_b.append(min(a.ids[i], b.ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return met.mapInArrow(run, "a long, b long").distinct()


class _Joined:
    """Labels that links have connected within one pair of blocks."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (up := self.above.get(x, x)) != x:
            x = up
        return x

    def apart(self, x: int, y: int) -> bool:
        return self.top(x) != self.top(y)

    def join(self, x: int, y: int) -> None:
        self.above[self.top(x)] = self.top(y)


class _Block:
    """Members of a bucket as arrays."""

    def __init__(self, rows: pa.StructArray):
        self.ids, self.labels = rows.field("id").to_numpy(), rows.field("label").to_numpy()
        self.bands = rows.field("bands").flatten().to_numpy().reshape(len(rows), -1)
        self.signatures = np.frombuffer(b"".join(rows.field("signature").to_pylist()), dtype=np.uint16).reshape(len(rows), 2 * PERMUTATIONS)
        self._raw = rows.field("shingles").to_pylist()
        self.sizes = np.array([len(r) // 16 for r in self._raw])

    def set(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        both = np.frombuffer(self._raw[i], dtype=np.uint64)
        return both[: len(both) // 2], both[len(both) // 2 :]


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    how = plan(percent)
    signed = keep(signatures(docs, how.bands, how.rows).withColumn("row", F.monotonically_increasing_id()))
    n = signed.count()
    most = n * how.bands  # members of buckets
    sets = signed.where("n_shingles > 0 and doc_id is not null")
    # one row stands for all of one set; the others are found by the sets' names alone
    copies = sets.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("n")).where("n > 1")
    others = keep(sets.select("doc_id", "s1", "s2", "row").join(copies, ["s1", "s2"]).where("row != first.row").select("row", "doc_id", F.col("first.doc_id").alias("rep")))
    same_set = others.where("rep != doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = among(sets, "row", others.select("row"), "left_anti").select(F.col("doc_id").alias("id"), "n_shingles", "bands", "signature")

    banded = reps.select("id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    # a table of its own, so that the join below may split a hot key's rows
    hubs = keep(banded.groupBy("key").agg(F.min(F.struct("id", "n_shingles")).alias("h"), F.count("*").alias("n")).where("n > 1").select("key", F.col("h.id").alias("hub"), F.col("h.n_shingles").alias("hub_size")), rows=most)
    members = keep(banded.join(hubs, "key"))
    ids = keep(members.select("id").distinct(), rows=n)
    reps = keep(among(reps, "id", ids))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = keep(among(texts, "doc_id", ids.withColumnRenamed("id", "doc_id")))

    first = members.where(F.col("id") != F.col("hub")).where(_sizes_allow("n_shingles", "hub_size", percent)).select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = keep(confirm(agreeing(first, reps, how.agree), texts, percent, most), rows=most)
    links, left = _connect(members, links, reps, texts, percent, how, most)
    second = _across_labels(left, reps, texts, percent, how.agree)
    found = components(links.unionByName(second).unionByName(same_set))
    out = signed.select("doc_id", "n_shingles").join(found.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """docs with one row of each group of linked rows: the one with the least doc_id, null last.

    Rows count by themselves even where they share a doc_id or have none; only then are they numbered first.
    """
    found, number = free_names(docs, "_found", "_row")
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("doc_id is null or n > 1").isEmpty():
        gone = near_duplicates(docs, percent).where(~F.col("kept")).select(F.col("doc_id").alias(found))
        return docs.join(gone, F.col("doc_id").cast("long") == F.col(found), "left_anti")
    rows = keep(docs.withColumn(number, F.monotonically_increasing_id()))
    groups = near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"), percent).select(F.col("doc_id").alias(number), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", number))
    kept = rows.select(number, "doc_id").join(groups, number).groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{number}").alias(found))
    return rows.join(kept, F.col(number) == F.col(found), "left_semi").drop(number)
