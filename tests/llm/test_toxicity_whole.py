"""The whole toxicity query against a plain version of it: families, weights, segments, calibration and scores."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from granary.llm import queries, toxicity
from granary.llm.words import find_words, mix, windows

SF = "/root/testdata/sf0.01"


def plain_tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_forms(word):
    return [word] + [f"{word[:n]}|" for n in (5, 4) if len(word) > n]


def plain_ends(text):
    """Least and greatest hash of the three-word windows, each hashed alone, as signed numbers."""
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0, 0
    if len(words) < 3:
        h = mix(find_words(pa.array([" ".join(words)])).hashes()[0])
    else:
        each = find_words(pa.array([" ".join(words[i : i + 3]) for i in range(len(words) - 2)]))
        h = windows(each.hashes(), each.ptr, 3)[1]
    return int(h.min().view(np.int64)), int(h.max().view(np.int64))


def plain_segments(score, a=0, b=None):
    """By definition: the best run, of equal ones the shortest, then the same on both sides of it; (a, b, sum)."""
    out, todo = [], [(0, len(score))]
    while todo:
        a, b = todo.pop()
        best, low, at = (1e-12, 0, 0), 0.0, a
        total = 0.0
        for i in range(a, b):
            if total <= low:
                low, at = total, i
            total += score[i]
            if total - low > best[0] + 1e-12:
                best = (total - low, at, i + 1)
        if best[2]:
            out.append((best[1], best[2], best[0]))
            todo += [(a, best[1]), (best[2], b)]
    return out


def plain_weights(sample):
    n, held = [0, 0], {}
    for _, text, y in sample:
        n[y] += 1
        for form in {f for w in plain_tokens(text) for f in plain_forms(w)}:
            held.setdefault(form, [0, 0])[y] += 1
    out = {}
    for form, (c0, c1) in held.items():
        a = 20.0 * (c0 + c1) / sum(n)
        odds = lambda c, n: math.log((c + a) / (n + 20.0 - c - a))
        delta = odds(c1, n[1]) - odds(c0, n[0])
        left = abs(delta) - 3.0 * math.sqrt(1 / (c1 + a) + 1 / (c0 + a))
        if left > 0:
            out[form] = math.copysign(left, delta)
    return out


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    y = {r.doc_id: int(r.toxic) for r in queries.table(spark, SF, "labels").where("toxic is not null").collect()}
    sample = [(i, t, y[i], *plain_ends(t)) for i, t in rows if i in y and zlib.crc32(str(i).encode()) % 5]
    before = len(sample)
    for end in (3, 4):
        first = {}
        for r in sorted(sample, key=lambda r: (r[0], r[2])):
            first.setdefault(r[end], r)
        sample = list(first.values())
    assert 20 < len(sample) <= before
    sample = [r[:3] for r in sample]
    weights = plain_weights(sample)

    def segments(text):
        words = plain_tokens(text)
        return len(words), plain_segments([max([weights[f] for f in plain_forms(w) if f in weights], default=0.0) - 0.7 for w in words])

    clean = [(n, max([s for *_, s in found], default=0.0)) for n, found in (segments(t) for _, t, c in sample if c == 0) if n]
    some = np.array([b for _, b in clean if b > 0])
    lam = min(2.0, math.pi / (math.sqrt(6) * max(some.std(), 1e-9))) if len(some) >= 20 else 1.0
    k = len(clean) / sum(n * math.exp(-lam * b) for n, b in clean)

    def evidence(n, found):
        each = [lam * s - math.log(k * n) for *_, s in found]
        return max([-8.0, *each, sum(e for e in each if e > 0)]) if each else -8.0

    return rows, sample, weights, segments, lam, k, evidence


def test_the_model_is_the_plain_one(spark, plain):
    _, sample, weights, segments, lam, k, evidence = plain
    model = toxicity.fit(queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels"))
    assert model.weights.keys() == weights.keys() and len(weights) > 5
    assert all(model.weights[f] == pytest.approx(w) for f, w in weights.items())
    assert (model.lam, model.k) == (pytest.approx(lam), pytest.approx(k))
    # slope and bias lie where the penalised likelihood, which is concave, has no gradient
    x, y = np.array([evidence(*segments(t)) for _, t, _ in sample]), np.array([c for *_, c in sample])
    z, slope = (x - x.mean()) / x.std(), model.slope * x.std()
    level = model.bias + model.slope * x.mean()
    off = y - 1 / (1 + np.exp(-(slope * z + level)))
    assert abs((z * off).sum() - 1e-2 * slope) < 1e-4 and abs(off.sum() - 1e-2 * level) < 1e-4


def test_every_score_is_the_plain_one(spark, plain):
    rows, _, _, segments, lam, k, evidence = plain
    model = toxicity.fit(queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels"))
    name = next(n for n in queries.queries() if n.startswith("op10_"))
    got = {r.doc_id: r for r in queries.queries()[name](spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        n, found = segments(text)
        p = 1 / (1 + math.exp(-max(-50.0, min(50.0, model.slope * evidence(n, found) + model.bias)))) if any(s > 0 for *_, s in found) else 0.0
        row = got[i]
        assert row.score == pytest.approx(p, abs=1e-6) and row.predicted == int(p >= 0.5) and row.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert row.n_passages == sum(-math.expm1(-k * n * math.exp(-lam * s)) <= 1e-3 for *_, s in found)
    assert {r.predicted for r in got.values()} == {0, 1}
