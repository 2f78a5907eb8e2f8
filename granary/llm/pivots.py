"""Exact top-k inner products by a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it; the distances cut each pivot's vectors into
annuli. A query visits the annuli in order of the best score that the triangle inequality allows there: the
first of them give its k-th best score so far, and only annuli that could still reach it are visited then.

Inner products are bounded through distances: 2 <q, x> = |q|^2 + |x|^2 - |q - x|^2, and |q - x| is at least the
gap between the query's distance to the pivot and the annulus.

The index holds every row. Vectors meet those of their own length. The lengths that a bounded sample holds often
have pivots of their own, at most LENGTHS of them with at most PIVOTS * MOST_RINGS annuli each, whose few figures
the driver holds; a rarer length is one annulus, which all its queries visit. The annuli's rows are cut into blocks
of bounded size, and each pair of a block of queries and a block of rows is dealt out by itself.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor do rows
with a null vec_id; very long vectors count whole; rows that share a query's vec_id are its own; a vec_id that stands
there several times asks once, with its least vector; ties go to the smaller vec_id; repeated rows are candidates
each; scores beyond 64 bits are drawn in to their ends; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import in_blocks, meet
from .shared import by_bytes, keep
from .vectors import matrix, usable

PIVOTS, SAMPLE, LENGTHS = 32, 4096, 64
RINGS, MOST_RINGS, RING_ROWS = 16, 256, 2048  # annuli of a pivot: one for so many rows, between two bounds
BLOCK, QUERIES = 2048, 256
FIRST_ROWS = 8192  # candidates that a query's first annuli hold together, at least
_LONG = np.iinfo(np.int64)
_CELL = ["d", "cell"]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T, 0))


def _fit(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: pivots, far from each other, from the sample, and each pivot's ring borders."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()["v"].tolist()
    total, by_length = vectors.count(), {}
    for v in sample:
        by_length.setdefault(len(v), []).append(v)
    out = {}
    for length, own in by_length.items():
        if len(own) * LENGTHS < len(sample):
            continue
        x = np.array(own, dtype=np.float64)
        rows = total * len(own) / len(sample)
        rings = int(min(MOST_RINGS, max(RINGS, rows // (PIVOTS * RING_ROWS))))
        chosen, gap = [0], np.full(len(x), np.inf)
        while len(chosen) < min(PIVOTS, len(x)):
            gap = np.minimum(gap, np.linalg.norm(x - x[chosen[-1]], axis=1))
            if gap.max() == 0:
                break
            chosen.append(int(gap.argmax()))
        pivots = x[chosen]
        d = _distances(x, pivots)
        near = d.argmin(axis=1)
        out[length] = pivots, np.array([np.quantile(d[near == p, p], np.arange(1, rings) / rings) if (near == p).any() else np.zeros(rings - 1) for p in range(len(pivots))])
    return out


def inner_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, drawn in to 64 bits."""
    most = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
    if most < 2**53:
        return np.rint(q @ c.T).astype(np.int64)
    if most < 2**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = [[[int(x) for x in row] for row in m] for m in (q, c)]
    return np.array([[min(max(sum(map(int.__mul__, a, b)), _LONG.min + 1), _LONG.max) for b in whole[1]] for a in whole[0]], dtype=np.int64).reshape(len(q), len(c))


def top_k(embeddings: DataFrame, is_query, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) with integer inner products of floor(256 * x) vectors."""
    spark = embeddings.sparkSession
    rows = embeddings.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))

    def whole(batches):
        for batch in batches:
            v = batch.column("v")
            values = pa.array(np.floor(256 * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)))
            ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(v).to_numpy(zero_copy_only=False), dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["vec_id", "v"])

    vectors = keep(by_bytes(vectors).mapInArrow(whole, "vec_id long, v array<double>"))
    shared = spark.sparkContext.broadcast(_fit(vectors))  # at most LENGTHS times PIVOTS vectors and their borders

    def key(batches):
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                own = batch.take(pa.array(np.flatnonzero(lengths == length)))
                n = own.num_rows
                cell, distance, norm = np.full(n, -1), np.zeros(n), np.zeros(n)
                if int(length) in shared.value:
                    p, cuts = shared.value[int(length)]
                    x = matrix(own.column("v"))
                    d = _distances(x, p)
                    near = d.argmin(axis=1)
                    distance, norm = d[np.arange(n), near], (x * x).sum(axis=1)
                    cell = near * (cuts.shape[1] + 1) + (distance[:, None] > cuts[near]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, length), pa.int32()), pa.array(cell, pa.int32()), pa.array(distance), pa.array(norm), own.column("vec_id"), own.column("v")], ["d", "cell", "distance", "norm", "vec_id", "v"])

    keyed = keep(by_bytes(vectors).mapInArrow(key, "d int, cell int, distance double, norm double, vec_id long, v array<double>"))
    figured = keyed.where("cell >= 0").groupBy("d", "cell").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"), F.max("norm").alias("norm"), F.count("*").alias("n"))
    cells = {d: own.sort_values("cell") for d, own in figured.toPandas().groupby("d")}  # at most PIVOTS * MOST_RINGS rows a length
    blocks = keep(in_blocks(keyed, _CELL, BLOCK, "vec_id", "v"))
    figures = spark.sparkContext.broadcast((shared.value, cells))
    queries = vectors.where(is_query(F.col("vec_id"))).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    # routing a query costs a look at every annulus: few queries are not left to few tasks
    queries = keep(queries.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "query_id"))

    def visits(queries: DataFrame, first: bool) -> DataFrame:
        """(cell, query_id, v): the annuli of the first wave, or the others that could reach `least`."""

        def run(batches):
            models, figures_of = figures.value
            for batch in batches:
                lengths = pa.compute.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
                for length in np.unique(lengths).tolist():
                    own = batch.take(pa.array(np.flatnonzero(lengths == length)))
                    if length in figures_of:
                        go, cell = reached(own, *models[length], figures_of[length])
                    else:
                        go, cell = np.full((own.num_rows, 1), first), np.array([-1])
                    i, j = np.nonzero(go)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), length), pa.int32()), pa.array(cell[j], pa.int32()), own.column("query_id").take(pa.array(i)), own.column("v").take(pa.array(i))], ["d", "cell", "query_id", "v"])

        def reached(asked, p, cuts, c):
            cell, lo, hi, norm, n = (c[x].to_numpy() for x in ("cell", "lo", "hi", "norm", "n"))
            q = matrix(asked.column("v"))
            d = _distances(q, p)[:, cell // (cuts.shape[1] + 1)]
            apart = np.maximum(0, np.maximum(d - hi, lo - d))
            size = (q * q).sum(axis=1)[:, None]
            best = np.minimum((size + norm - apart**2) / 2, np.sqrt(size * norm))
            best += 1e-9 * (size + norm) + 1e-6  # rounding never closes an annulus
            order = np.argsort(-best, axis=1, kind="stable")
            before = np.cumsum(n[order], axis=1) - n[order]
            early = np.zeros_like(best, dtype=bool)
            np.put_along_axis(early, order, before < FIRST_ROWS, axis=1)
            go = early if first else ~early & (best >= asked.column("least").to_numpy(zero_copy_only=False)[:, None])
            return go, cell

        return by_bytes(queries).mapInArrow(run, "d int, cell int, query_id long, v array<double>")

    def search(visited: DataFrame) -> DataFrame:
        asked = keep(in_blocks(visited, _CELL, QUERIES, "query_id", "v"))

        def run(batches):
            for batch in batches:
                for one, many in zip(batch.column("rows"), batch.column("rows2")):
                    (qi, q), (ci, c) = ((x.values.field(i).to_numpy(), matrix(x.values.field("v"))) for x, i in ((one, "query_id"), (many, "vec_id")))
                    score = inner_products(q, c)
                    by_id = np.argsort(ci, kind="stable")
                    score, ci = score[:, by_id], ci[by_id]
                    out = []
                    for r in range(len(qi)):
                        s = np.where(ci == qi[r], _LONG.min, score[r])
                        if len(s) > k:  # all that reach the k-th best, so that ties are settled by vec_id
                            at = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                        else:
                            at = np.arange(len(s))
                        at = at[ci[at] != qi[r]]
                        at = at[np.lexsort((ci[at], -s[at]))][:k]
                        out.append((np.full(len(at), qi[r]), ci[at], s[at]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[x] for o in out])) for x in range(3)], ["query_id", "vec_id", "score"])

        return best_of(by_bytes(meet(asked, blocks, _CELL)).mapInArrow(run, "query_id long, vec_id long, score long"))

    def best_of(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    early = keep(search(visits(queries.withColumn("least", F.lit(0.0)), first=True)))
    least = early.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))
    waiting = queries.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    late = search(visits(waiting, first=False))
    return best_of(early.drop("rank").unionByName(late.drop("rank"))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
