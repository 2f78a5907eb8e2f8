"""Near-duplicate vectors by a forest of random-projection trees with spill.

Every tree splits space again and again along random directions; vectors close to a border go to both sides, so
two vectors at the similarity asked for share a leaf of most trees. Vectors are compared within leaves, in blocks
of bounded size, by the exact cosine in double precision.

Trees grow in rounds inside the executors: every leaf with too many rows is split on, by a subtree of a few levels
that a bounded sample of the leaf's own rows settles. Nothing of a tree reaches the driver. A border lies where few
of the sample are near it; a leaf that has no such border, because its rows are near copies of each other, is closed
and stays one leaf. Rows that lie in one closed leaf of the first tree meet there only, not in the other trees too.

A pair counts in the first leaf that both its vectors lie in. From a pair of blocks come the numbers of links of its
rows and a spanning set of its links, never the links themselves. Identical vectors of one label are one node with
a multiplicity.

Defined results: vectors that are null, zero or hold null or non-finite components, rows with a null label and
rows of different length link with nothing; a row's own copies with the same vec_id count as other vectors; a
null vec_id has a null component and is kept; ties go to the smallest vec_id; very long vectors count whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_pairs, in_blocks
from .components import components
from .shared import by_bytes, keep
from .vectors import matrix, unit, usable

TREES, LEAF, SAMPLE, BLOCK = 6, 256, 2048, 512
SPILL = 0.8  # of the standard deviation of a linked pair's projected distance, to either side
LEVELS = 6  # of a subtree
FEW = 32  # sample rows that a split needs on either side together
CROWDED, TRIES = 0.35, 3  # no border has more of the sample near it; directions tried for one that has less
_TREE = 1 << 48  # a leaf's number: its tree's times this, plus its place in heap order
_DEEPEST = 1 << 40
_KEYS = ["label", "d", "leaf"]


@lru_cache(maxsize=4096)
def _direction(leaf: int, place: int, attempt: int, d: int) -> np.ndarray:
    v = np.random.default_rng([leaf, place, attempt]).standard_normal(d)
    return v / np.linalg.norm(v)


def border(p: np.ndarray, margin: float) -> tuple[float, float]:
    """(the place, of nine between the tenths of the projections, with the fewest of them near it; their share)."""
    p = np.sort(p)
    places = np.quantile(p, np.arange(1, 10) / 10)
    near = (np.searchsorted(p, places + margin, side="right") - np.searchsorted(p, places - margin)) / len(p)
    # of like shares the most even: copies that all lie on one side of a place leave nothing there
    even = np.abs(np.searchsorted(p, places) / len(p) - 0.5)
    best = int(np.lexsort((even, np.round(near + even / 2, 2)))[0])
    return float(places[best]), float(near[best])


def subtree(x: np.ndarray, leaf: int, n: int, margin: float) -> np.ndarray:
    """(3, 2 ** LEVELS) border, direction's attempt and 1 for closed, by place in heap order; a border of NaN is a leaf.

    x: sampled unit vectors of a leaf with n rows. Either the root is split or it is closed.
    """
    out = np.zeros((3, 1 << LEVELS))
    out[0] = np.nan
    held = {1: x}
    for place in range(1, 1 << LEVELS):
        own = held.pop(place, None)
        if own is None or place > 1 and (len(own) < FEW or len(own) * n <= LEAF * len(x)):
            continue
        for attempt in range(TRIES if len(own) > 1 else 0):
            p = own @ _direction(leaf, place, attempt, x.shape[1])
            at, share = border(p, margin)
            left, right = p < at + margin, p >= at - margin
            if share <= CROWDED and left.sum() < len(own) and right.sum() < len(own):
                out[:2, place] = at, attempt
                if 2 * place < 1 << LEVELS:
                    held[2 * place], held[2 * place + 1] = own[left], own[right]
                break
        else:
            out[2, place] = 1
    return out


def descend(x: np.ndarray, home: np.ndarray, leaf: int, tree: np.ndarray, margin: float) -> tuple[np.ndarray, ...]:
    """(row, leaf, home, closed) of each leaf of a subtree that a row reaches; home: no border was crossed by spill."""
    row, place, home, done = np.arange(len(x)), np.ones(len(x), dtype=np.int64), home.copy(), []
    for _ in range(LEVELS):
        going = (place < tree.shape[1]) & ~np.isnan(tree[0, np.minimum(place, tree.shape[1] - 1)])
        done.append((row[~going], place[~going], home[~going]))
        row, place, home = row[going], place[going], home[going]
        off = np.empty(len(row))
        for at in np.unique(place).tolist():
            own = np.flatnonzero(place == at)
            off[own] = x[row[own]] @ _direction(leaf, at, int(tree[1, at]), x.shape[1]) - tree[0, at]
        left, right = off < margin, off >= -margin
        row, place, home = np.concatenate([row[left], row[right]]), np.concatenate([2 * place[left], 2 * place[right] + 1]), np.concatenate([home[left] & (off[left] < 0), home[right] & (off[right] >= 0)])
    done.append((row, place, home))
    row, place, home = (np.concatenate(c) for c in zip(*done))
    closed = (place < tree.shape[1]) & (tree[2, np.minimum(place, tree.shape[1] - 1)] > 0)
    # below the leaf's own place: as many levels as the place in the subtree has
    depth = np.floor(np.log2(place)).astype(np.int64)
    number, base = leaf % _TREE, leaf - leaf % _TREE
    deeper = (np.int64(number) << depth) + place - (np.int64(1) << depth)
    return row, base + deeper, home, closed | (deeper >= _DEEPEST)


def _leaves(nodes: DataFrame, distance: float) -> DataFrame:
    """(label, d, leaf, id, home, closed) of every node in every tree; labels of one leaf have one tree."""

    def build(rows: pa.Table) -> pa.Table:
        x, leaf, d = unit(matrix(rows.column("v").combine_chunks())), rows.column("leaf")[0].as_py(), rows.column("d")[0].as_py()
        tree = subtree(x, leaf, rows.column("n")[0].as_py(), SPILL * distance / math.sqrt(d))
        return pa.table({"label": rows.column("label")[:1], "d": rows.column("d")[:1], "leaf": rows.column("leaf")[:1], "tree": pa.array([tree.tobytes()], pa.binary())})

    def route(batches):
        for batch in batches:
            label, d, leaf, home = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "d", "leaf", "home"))
            order = np.lexsort((leaf, d, label))
            new = np.flatnonzero(np.concatenate([[True], (np.diff(leaf[order]) != 0) | (np.diff(d[order]) != 0) | (np.diff(label[order]) != 0)])) if len(order) else []
            for own in np.split(order, new[1:]) if len(order) else []:
                first = int(own[0])
                x = unit(matrix(batch.column("v").take(pa.array(own))))
                tree = np.frombuffer(batch.column("tree")[first].as_py()).reshape(3, -1)
                row, to, at_home, closed = descend(x, home[own], int(leaf[first]), tree, SPILL * distance / math.sqrt(d[first]))
                taken = batch.select(["label", "d", "id"]).take(pa.array(own[row]))
                yield pa.RecordBatch.from_arrays([taken.column("label"), taken.column("d"), pa.array(to, pa.int64()), taken.column("id"), pa.array(at_home, pa.bool_()), pa.array(closed, pa.bool_())], ["label", "d", "leaf", "id", "home", "closed"])

    sizes = keep(nodes.groupBy("label", "d").agg(F.count("*").alias("n")))
    last = F.when(F.col("n") > LEAF, TREES - 1).otherwise(0)
    planted = nodes.select("label", "d", "id").join(sizes, ["label", "d"]).withColumn("tree", F.explode(F.sequence(F.lit(0), last)))
    now = keep(planted.select("label", "d", (F.col("tree") * F.lit(_TREE) + 1).cast("long").alias("leaf"), "id", F.lit(True).alias("home"), F.lit(False).alias("closed")))
    vectors = nodes.select("id", "v")
    while True:
        large = keep(now.where("not closed").groupBy(*_KEYS).agg(F.count("*").alias("n")).where(F.col("n") > LEAF))
        if large.isEmpty():
            return now
        asked = now.join(large, _KEYS)
        sampled = asked.where(F.pmod(F.xxhash64("id", "leaf"), F.ceil(F.col("n") / SAMPLE)) == 0).join(vectors, "id")
        trees = keep(sampled.groupBy(*_KEYS).applyInArrow(build, "label long, d int, leaf long, tree binary"))
        routed = by_bytes(asked).join(trees, _KEYS).join(vectors, "id").select("label", "d", "leaf", "id", "home", "v", "tree").mapInArrow(route, "label long, d int, leaf long, id long, home boolean, closed boolean")
        # leaves from which the sample took no row wait for the next round's
        done = now.join(trees.select(*_KEYS), _KEYS, "left_anti")
        now = keep(done.select("label", "d", "leaf", "id", "home", "closed").unionByName(routed))


def _met_before(a: pa.ListArray, b: pa.ListArray, leaf: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """True for the (rows of a, columns of b) that share a leaf with a lower number than `leaf`."""
    held = []
    for lists, which in ((a, rows), (b, columns)):
        own = lists.take(pa.array(which))
        counts = pa.compute.list_value_length(own).to_numpy()
        held.append((np.repeat(np.arange(len(which)), counts), own.flatten().to_numpy()))
    codes = np.intersect1d(held[0][1], held[1][1])
    codes = codes[codes < leaf]
    if not len(codes):
        return np.zeros((len(rows), len(columns)), dtype=bool)
    marks = []
    for (row, code), which in zip(held, (rows, columns)):
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        there = codes[at] == code
        mark = np.zeros((len(which), len(codes)), dtype=np.float32)
        mark[row[there], at[there]] = 1
        marks.append(mark)
    return marks[0] @ marks[1].T > 0


def spanning(ids: np.ndarray, other: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """(id, least id of its part) pairs that connect what the matrix of links connects."""
    out, row_left = [], linked.any(axis=1)
    while row_left.any():
        rows = np.zeros(len(ids), dtype=bool)
        rows[int(row_left.argmax())] = True
        columns = np.zeros(len(other), dtype=bool)
        fresh = rows.copy()
        while fresh.any():
            seen = linked[fresh].any(axis=0) & ~columns
            columns |= seen
            fresh = linked[:, seen].any(axis=1) & ~rows if seen.any() else np.zeros(len(ids), dtype=bool)
            rows |= fresh
        part = np.unique(np.concatenate([ids[rows], other[columns]]))
        out += [(int(x), int(part[0])) for x in part[1:]]
        row_left &= ~rows
    return out


def links(nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, near) of (id, label, d, v, copies) nodes with the same label, length and a cosine of at least `threshold`.

    Rows without b say that `near` other vectors, copies counted, are linked with a; those with b that a and b are
    connected. Sums over a and components over (a, b) make the result.
    """
    leaves = keep(_leaves(nodes, math.sqrt(max(0.0, 2 - 2 * threshold))))
    tags = keep(leaves.where(F.col("home") & F.col("closed") & (F.col("leaf") < _TREE)).select("id", F.col("leaf").alias("tag")))
    every = leaves.groupBy("id").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
    rows = leaves.select(*_KEYS, "id").join(tags, "id", "left").withColumn("tag", F.coalesce("tag", F.lit(0)))
    rows = rows.join(nodes.select("id", "v", "copies").join(every, "id"), "id")
    blocks = in_blocks(rows, [*_KEYS, "tag"], BLOCK, "id", "v", "copies", "leaves")
    blocks = keep(blocks.withColumn("block", F.shiftright(F.xxhash64("tag", "block"), 2)))  # unique in a leaf
    met = block_pairs(blocks, _KEYS, "leaf", where=f"leaf < {_TREE} or tag = 0 or tag <> tag2")

    def compare(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("near", pa.int64())])
        for batch in batches:
            for leaf, left, right in zip(batch.column("leaf").to_pylist(), batch.column("rows"), batch.column("rows2")):
                (ia, a, ca), (ib, b, cb) = ((x.values.field("id").to_numpy(), unit(matrix(x.values.field("v"))), x.values.field("copies").to_numpy()) for x in (left, right))
                linked = (a @ b.T >= threshold) & (ia[:, None] != ib[None, :])
                i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
                if not len(i):
                    continue
                linked = linked[np.ix_(i, j)] & ~_met_before(left.values.field("leaves"), right.values.field("leaves"), leaf, i, j)
                near = [(ia[i], linked @ cb[j])]
                if not np.array_equal(ia, ib):  # a block with itself has each pair both ways
                    near.append((ib[j], linked.T @ ca[i]))
                ids, n = np.concatenate([x for x, _ in near]), np.concatenate([x for _, x in near])
                pairs = np.array(spanning(ia[i], ib[j], linked), dtype=np.int64).reshape(-1, 2)
                ids, n = ids[n > 0], n[n > 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids, pairs[:, 0]])), pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(pairs[:, 1])]), pa.array(np.concatenate([n, np.zeros(len(pairs), dtype=np.int64)]))], schema=schema)

    return by_bytes(met).mapInArrow(compare, "a long, b long, near long")


def near_vectors(embeddings: DataFrame, threshold: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"))
    good = usable(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    nodes = rows.where(good).groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = keep(nodes.withColumns({"d": F.size("v"), "id": F.monotonically_increasing_id()}))
    found = keep(links(nodes, threshold))
    near = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("near").alias("near"))
    parts = keep(components(found.where("b is not null").select("a", "b")))
    least = parts.join(nodes.select("id", "least"), "id").groupBy("component").agg(F.min("least").alias("of_part"))
    known = nodes.join(near, "id", "left").join(parts.join(least, "component").select("id", "of_part"), "id", "left")
    known = known.select("label", "v", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("of_part", "least").alias("component_id"))
    out = rows.where(good).join(known, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(good, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
