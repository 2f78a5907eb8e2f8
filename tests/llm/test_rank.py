"""Ranked lexical search against a plain version, and its SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from granary.llm import rank
from granary.llm.oracles import RANK

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    tf = [(doc, Counter(_terms(t))) for doc, t in docs if _terms(t)]
    n_docs, n_terms, df = len(tf), sum(sum(c.values()) for _, c in tf), Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        asked = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(_terms(text)) if df[t]}
        scores = []
        for doc, c in tf:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
            scores.append((-sum(w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in asked.items() if c[t]), doc is None, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(sorted(x for x in scores if x[0] < 0)[:k])]
    return sorted(out, key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "ß1", "A", "a", "_", "x-y", "日本", "\x7f", "\u0085z"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(500)]
    docs += [(1000 + i, "w1 w2 w3") for i in range(50)] + [(5000, None), (5001, ""), (None, "w1 w2 w3"), (1000, "w1 w2 w3"), (6000, "w5 " * 5000)]
    return docs, [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))) for i in range(150)] + [(900, None), (901, "nowhere"), (902, "w1 W1 w2 w3")]


def found(spark, docs, items, **how):
    a = spark.createDataFrame([(*d, 1, 2) for d in docs], DOCS + ", n long, item_id long").repartition(5)
    b = spark.createDataFrame([(*i, 3.0) for i in items], ITEMS + ", score double")
    return sorted((tuple(r) for r in rank.rank_documents(a, b, **how).collect()), key=str)


@pytest.mark.parametrize("how", [{}, {"k": 3}, {"group": 40}, {"k": 1000}])
def test_against_plain_scores(spark, how):
    docs, items = corpus()
    assert found(spark, docs, items, **how) == brute(docs, items, how.get("k", 10))


def test_tiles_narrower_than_a_block(spark, monkeypatch):
    for name, value in (("COLUMNS", 7), ("ITEMS", 5), ("DOCS", 16)):
        monkeypatch.setattr(rank, name, value)
    docs, items = corpus(2)
    assert found(spark, docs, items) == brute(docs, items)


def test_sql(spark):
    docs, items = corpus(3)
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(docs, DOCS).toArrow())
    con.register("benchmark", spark.createDataFrame(items, ITEMS).toArrow())
    assert sorted(con.sql(f"SELECT item_id, rank, doc_id, score FROM ({RANK})").fetchall(), key=str) == found(spark, docs, items)


def test_best_keeps_the_least_ids_of_ties():
    best = rank.Best(1, 3)
    for docs in ([9, 8, 7, 6], [5, 4], [3, 2, 1]):
        best.add(np.full((1, len(docs)), 5, dtype=np.int64), np.array(docs))
    best.add(np.array([[6, 5, 0]]), np.array([50, 0, 51]))
    assert best.doc.tolist() == [[50, 0, 1]] and best.score.tolist() == [[6, 5, 5]]


def test_terms_that_share_a_first_hash():
    words = rank.Vocabulary(np.array([5, 5, 5, 9], dtype=np.uint64), np.array([1, 2, 3, 4], dtype=np.uint64))
    assert words.numbers(np.array([5, 5, 5, 9, 9, 1], dtype=np.uint64), np.array([3, 1, 7, 4, 5, 1], dtype=np.uint64)).tolist() == [2, 0, -1, 3, -1, -1]


def test_partial_sums_are_exact():
    assert rank.weights(np.array([0]), 2**62)[0] < rank.WEIGHT and rank.impacts(np.array([2**32]), np.array([2**32]), 1, 2**33)[0] < 10**6


def test_nothing(spark):
    docs, items = corpus()
    assert found(spark, [], items) == [] == found(spark, docs, []) == found(spark, [(1, None)], items)
