"""Top-k search and near-duplicate vectors against brute force."""

import numpy as np
from pyspark.sql import functions as F

from granary.llm import forest, pivots

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, n=600, d=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)).astype(np.float32)
    near = base[:120] + rng.standard_normal((120, d)).astype(np.float32) * 0.05
    return np.vstack([base, near, base[:60], np.repeat(base[:1], 50, axis=0), base[:10] * 3])


def frame(spark, v, labels):
    rows = [(i, [float(x) for x in row], int(l)) for i, (row, l) in enumerate(zip(v, labels))]
    odd = [(9001, None, 1), (9002, [], 1), (9003, [float("nan")] * v.shape[1], 1), (9004, [0.0] * v.shape[1], 1), (9005, [1.0, None], 1), (9006, [1.0, 2.0], 1), (9050, None, 1)]
    return spark.createDataFrame(rows + odd, SCHEMA).withColumns({"v": F.lit(1), "id": F.lit(2), "rank": F.lit(3)}), rows


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(pivots, "FIRST_ROWS", 50)
    monkeypatch.setattr(pivots, "BLOCK", 64)
    v = vectors()
    df, rows = frame(spark, v, np.zeros(len(v)))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in pivots.top_k(df, lambda i: i % 50 == 0).collect())
    q = np.floor(v.astype(np.float64) * 256).astype(np.int64)
    ids, want = np.arange(len(v)), []
    for i in range(0, len(v), 50):
        s = q @ q[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:5]
        want += [(i, n + 1, int(j), int(s[j])) for n, j in enumerate(order)]
    assert got == sorted(want)


def test_top_k_of_few(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (50, [0.0, -1.0], 1), (0, [1.0, 0.0], 1), (None, [1.0, 1.0], 1)], SCHEMA)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in pivots.top_k(few, lambda i: i % 50 == 0).collect())
    assert [x[:3] for x in got if x[0] == 0] == [(0, 1, 1), (0, 2, 50)]
    assert pivots.top_k(few.limit(0), lambda i: i % 50 == 0).count() == 0


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 32)
    monkeypatch.setattr(forest, "BLOCK", 16)
    v = vectors(1)
    labels = np.arange(len(v)) % 600 % 3
    df, rows = frame(spark, v, labels)
    df = df.unionByName(spark.createDataFrame([(9100, [float(x) for x in v[0]], None)], SCHEMA), allowMissingColumns=True)
    got = {r.vec_id: r for r in forest.near_vectors(df).collect()}
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    c = (u @ u.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(c, False)
    component = np.arange(len(v))
    while True:
        new = np.array([min(component[i], component[c[i]].min(initial=len(v))) for i in range(len(v))])
        if (new == component).all():
            break
        component = new
    assert [got[i].n_links for i in range(len(v))] == c.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(v))] == component.tolist()
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in (9001, 9002, 9003, 9004, 9005, 9006, 9100))
    assert forest.near_vectors(df.limit(0)).count() == 0


def test_a_group_of_near_copies_meets_once(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 32)
    monkeypatch.setattr(forest, "BLOCK", 64)
    rng = np.random.default_rng(5)
    n, d = 3000, 24
    v = rng.standard_normal((n, d))
    v[::2] = v[0] / np.linalg.norm(v[0]) + rng.standard_normal((n // 2, d)) * 0.02
    v = v.astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in row], 1) for i, row in enumerate(v)], SCHEMA)
    nodes = df.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"), F.lit(1).alias("copies"), F.lit(d).alias("d"))
    leaves = forest._leaves(nodes, np.sqrt(2 - 2 * 0.98))
    assert leaves.count() < 6 * 4 * n  # the group's rows are not dealt to both sides of every border
    assert leaves.where("home").groupBy("id", (F.col("leaf") / forest._TREE).cast("int")).count().where("count != 1").isEmpty()
    got = {r.vec_id: r for r in forest.near_vectors(df).collect()}
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    c = u @ u.T >= 0.98
    np.fill_diagonal(c, False)
    assert [got[i].n_links for i in range(n)] == c.sum(axis=1).tolist()
    assert sum(r.kept for r in got.values()) == n // 2 + 1 or all(got[i].component_id == 0 for i in range(0, n, 2) if c[i].any())


def test_vectors_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.001], 1), (0, [0.001, 1.0], 1), (None, [1.0, 0.0], 1)]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in forest.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("0", 1, "0"), ("1", 1, "0"), ("1", 1, "1"), ("2", 1, "1"), ("None", 0, "None")]


def test_top_k_of_mixed_lengths_and_large_numbers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(d)], 1) for i, d in enumerate([2] * 60 + [3] * 40 + [5] * 2)]
    rows += [(200, [1e20, -1e20], 1), (201, [1e20, 3e20], 1), (202, [4e16 / 256, 1.0], 1)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in pivots.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), lambda i: i % 20 == 0).collect())
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows}
    want = []
    for q in whole:
        if q % 20 == 0:
            scores = [(min(max(sum(a * b for a, b in zip(whole[q], v)), -(2**63) + 1), 2**63 - 1), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])]
            want += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:5])]
    assert got == sorted(want)
