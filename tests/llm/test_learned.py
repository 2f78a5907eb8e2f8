"""Classifiers: held-out accuracy and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import quality, toxicity
from granary.llm.queries import table

ODD = [(None, None, None), (1, "", 1), (2, None, 0), (3, "a", None), (3, "a", 1), (4, "x" * 200_000, 0), (5, "word " * 50_000, 1)]


@pytest.mark.parametrize(("operator", "label"), [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_held_out_rows_are_told_apart(spark, operator, label):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").join(labels.select("doc_id"), "doc_id", "left_semi")
    held = operator(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    y, predicted = held[label].to_numpy(), held["predicted"].to_numpy()
    assert len(y) > 300 and (y == predicted).mean() > 0.95
    assert held["score"].between(0, 1).all()
    assert held.loc[y == 1, "score"].mean() > held.loc[y == 0, "score"].mean() + 0.5


@pytest.mark.parametrize("operator", [quality.quality, toxicity.toxicity])
def test_odd_rows(spark, operator):
    docs = spark.createDataFrame([(i, t) for i, t, _ in ODD], "doc_id long, text string").withColumns({"y": F.lit(1), "score": F.lit(9), "label": F.lit("x")})
    labels = spark.createDataFrame([(i, l, l) for i, _, l in ODD], "doc_id long, quality int, toxic int")
    rows = operator(docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert operator(docs.limit(0), labels).count() == 0
    assert operator(docs, labels.limit(0)).count() == len(ODD)


def test_segments_against_all_subsequences():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 25))
        hits = [(int(i), float(rng.integers(1, 8))) for i in np.flatnonzero(rng.random(n) < 0.4)]
        scores = np.full(n, -1.0)
        for i, s in hits:
            scores[i] = s
        found = toxicity.maximal_segments(hits, 1.0)
        best = max([0.0, *(scores[a:b].sum() for a in range(n) for b in range(a + 1, n + 1))])
        assert max([0.0, *(s for *_, s in found)]) == pytest.approx(best)
        assert all(s == pytest.approx(scores[a:b].sum()) and s > 0 for a, b, s in found)
        assert all(b <= c for (_, b, _), (c, _, _) in zip(found, found[1:]))


def test_passages_are_reported(spark):
    model = toxicity.ToxicModel({"vile": 5.0, "nast|": 5.0}, drift=0.1, lam=1.0, k=0.01, slope=1.0, bias=-2.0)
    docs = spark.createDataFrame([(1, "a fine day"), (2, "Vile and nastily said. " + "fine " * 100 + "vile vile")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1].n_passages == 0 and got[1].score == 0
    assert [(p.start, p.end) for p in got[2].passages] == [(0, 3), (104, 106)] and got[2].score > 0.9
    assert [r.doc_id for r in toxicity.drop_toxic(docs, model).collect()] == [1]


def brute_segments(scores):
    """Maximal scoring segments by their definition: the best of all, then the same to its left and right."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best = max(((sums[b] - sums[a], -(b - a), -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 1e-12:
        return []
    a, b = -best[2], best[3]
    return brute_segments(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in brute_segments(scores[b:])]


def test_all_maximal_segments():
    rng = np.random.default_rng(7)
    for _ in range(300):
        scores = rng.standard_normal(int(rng.integers(0, 18))) - 0.3
        found = toxicity.maximal_segments(list(enumerate(scores.tolist())), 0.5)
        assert [(a, b) for a, b, _ in found] == brute_segments(scores)
        assert all(s == pytest.approx(scores[a:b].sum()) for a, b, s in found)


def test_scan_is_linear():
    import time

    def took(n):
        falling = [(3 * i, 1.0) for i in range(n)]  # every candidate begins below all before it
        began = time.perf_counter()
        assert len(toxicity.maximal_segments(falling, 2.0)) == n
        return time.perf_counter() - began

    took(1000)
    assert took(200_000) < 5


def test_token_weights_by_hand(spark):
    counts = spark.createDataFrame([("", 900, 100), ("bad", 5, 60), ("fine", 400, 2), ("rare", 1, 1)], "token string, c0 long, c1 long")
    got = {r.token: r.w for r in toxicity.token_weights(counts, 900, 100, 20.0, 3.0).collect()}
    want = {}
    for token, c0, c1 in (("bad", 5, 60), ("fine", 400, 2), ("rare", 1, 1)):
        a = 20 * (c0 + c1) / 1000
        delta = np.log((c1 + a) / (120 - c1 - a)) - np.log((c0 + a) / (920 - c0 - a))
        left = abs(delta) - 3 * np.sqrt(1 / (c1 + a) + 1 / (c0 + a))
        if left > 0:
            want[token] = np.sign(delta) * left
    assert set(got) == set(want) and all(got[t] == pytest.approx(want[t]) for t in want) and got["bad"] > 0 > got["fine"]


def test_tails_of_clean_texts_are_calibrated():
    rng = np.random.default_rng(9)
    n = np.full(4000, 300)
    best = rng.gumbel(np.log(0.05 * 300) / 0.8, 1 / 0.8, 4000)
    lam, k = toxicity.gumbel(np.maximum(best, 1e-6), n)
    assert lam == pytest.approx(0.8, rel=0.1)
    model = toxicity.ToxicModel(lam=lam, k=k)
    assert np.mean(best >= 8) == pytest.approx(model.tail(8.0, 300), rel=0.3)


def test_quality_densities_by_the_plain_formula(spark):
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(rng.choice(["Alpha", "beta.", "GAMMA!!", "12", "#$", "word,"], int(rng.integers(1, 60)), p=p)), int(y)) for i, (y, p) in enumerate([(1, [0.2, 0.5, 0.02, 0.03, 0.05, 0.2]), (0, [0.1, 0.1, 0.4, 0.2, 0.1, 0.1])] * 60)]
    docs, labels = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    import zlib

    import pyarrow as pa

    used = [t for t in texts if zlib.crc32(str(t[0]).encode()) % 5]
    x = quality.statistics(quality.find_words(pa.array([t for _, t, _ in used])))
    y = np.array([y for *_, y in used])
    z = (x - x.mean(axis=0)) / np.maximum(x.std(axis=0), 1e-3)
    own = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = own[0] * (y == 0).mean() + own[1] * (y == 1).mean()
    density = []
    for c in (0, 1):
        s = 0.9 * own[c] + 0.1 * pooled + 0.05 * np.eye(z.shape[1])
        off = z - z[y == c].mean(axis=0)
        density.append(-0.5 * (np.linalg.slogdet(s)[1] + np.einsum("ij,jk,ik->i", off, np.linalg.inv(s), off)))
    d = density[1] - density[0]
    assert np.allclose(model.difference(x), np.sign(d) * np.log1p(np.abs(d)))
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert all(scores[i] == pytest.approx(1 / (1 + np.exp(-np.clip(model.slope * v + model.bias, -50, 50)))) for (i, _, _), v in zip(used, model.difference(x)))
