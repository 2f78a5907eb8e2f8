"""Toxicity by maximum-scoring segments.

Each token scores its log-odds of standing in a toxic text, by the labelled texts that hold it, with an informative
Dirichlet prior, drawn towards zero by its standard errors; every token, known or not, then pays the same drift, so
that ordinary words score below zero and a segment does not grow across them. Inflected words share their first letters, so a word scores as the best of
itself and its first five and four letters. A linear-time scan finds every maximal scoring segment of a text; a
segment is significant when its extreme-value (Karlin-Altschul) tail under clean texts is small. The document's
score is a calibrated function of that tail.

Defined results: null and empty texts have no segment and the lowest score; very long texts are scanned whole, in
linear time; repeated rows are scored alike; of segments with equal scores all are kept, and of equal weights of a
word's forms it matters not which counts; an empty table gives an empty result; columns of the input besides doc_id
and text are ignored (drop_toxic() hands them on). Without labelled rows of both classes every score is 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_bytes, held_out, keep, labelled_sample
from .words import find_words, mix, text_slices, windows

TOKEN = re.compile(r"[^\W_]+")
REMEMBERED = 300_000  # words whose scores a worker keeps
SCORE_SCHEMA = "doc_id long, score double, n_passages int, passages array<struct<start:int,end:int,score:double,p_value:double>>"


@dataclass
class ToxicModel:
    weights: dict[str, float] = field(default_factory=dict)  # what tokens and beginnings score, for toxicity or against it
    drift: float = 0.7  # what every token pays
    lam: float = 1.0  # Gumbel scale and size under clean texts
    k: float = 1.0
    slope: float = 0.0
    bias: float = -50.0

    def evidence(self, segments: list[float], n: int) -> float:
        """The extreme-value sum statistic of segment scores in a text of n tokens.

        lambda * S - ln(K n) is minus the log of the expected number of such segments in a clean text; those
        above zero add up, and without one the best counts.
        """
        if not segments:
            return -8.0
        size = math.log(max(self.k * n, 1e-9))
        each = [self.lam * s - size for s in segments]
        return max(-8.0, max(each), sum(x for x in each if x > 0))

    def tail(self, s: float, n: int) -> float:
        """Probability that a clean text of n tokens has a segment of that score or more."""
        return -math.expm1(-self.k * n * math.exp(-self.lam * s))

    def score(self, segments: list[float], n: int) -> float:
        """0 for a text without any segment, else the calibrated probability."""
        if not segments:
            return 0.0
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * self.evidence(segments, n) + self.bias))))


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def forms(word: str) -> tuple[str, ...]:
    """The word and its beginnings; a bar keeps beginnings apart from whole words."""
    return (word, word[:5] + "|", word[:4] + "|") if len(word) > 5 else (word, word[:4] + "|") if len(word) > 4 else (word,)


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token + 1, score) in one pass.

    Tokens outside `hits` score -drift. Kept candidates form a stack with their prefix sums on the left and right.
    A new candidate joins the nearest one whose left sum is lower than its own, if its right sum is higher; each
    candidate points at the nearest one before it with a lower left sum, so the search skips all between.
    """
    first, last, left, right, lower = [], [], [], [], []  # of each candidate on the stack
    total, at = 0.0, 0
    for i, s in hits:
        total -= drift * (i - at)
        start, before = i, total
        total += s
        at = i + 1
        if s <= 0:
            continue
        while True:
            j = len(first) - 1
            while j >= 0 and left[j] >= before:
                j = lower[j]
            if j < 0 or right[j] >= total:
                break
            start, before = first[j], left[j]
            del first[j:], last[j:], left[j:], right[j:], lower[j:]
        first.append(start)
        last.append(at)
        left.append(before)
        right.append(total)
        lower.append(j)
    return [(a, b, r - l) for a, b, l, r in zip(first, last, left, right)]


class Scorer(dict):
    """Weights of words by a model, remembered up to a bound; 0 for those without any."""

    def __init__(self, model: ToxicModel):
        self.model = model

    def __missing__(self, word: str) -> float:
        weights = self.model.weights
        self[word] = score = max((weights[x] for x in forms(word) if x in weights), default=0.0)
        return score

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """(number of tokens, maximal segments) of a whole text."""
        if len(self) > REMEMBERED:
            self.clear()
        words = tokens(text)
        own = np.fromiter(map(self.__getitem__, words), dtype=np.float64, count=len(words))
        drift = self.model.drift
        if not (own > drift).any():
            return len(words), []
        at = np.flatnonzero(own)
        return len(words), maximal_segments(list(zip(at.tolist(), (own[at] - drift).tolist())), drift)


def one_of_a_family(sample: DataFrame) -> DataFrame:
    """(doc_id, text, y) with one row of texts that share their least or greatest three-word hash.

    Without this a family of near copies would pass its own vocabulary off as evidence.
    """

    def keyed(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("y", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64())])
        for whole in batches:
            for batch in text_slices(whole, "text"):
                words = find_words(batch.column("text"), lower=True)
                (hashes,) = words.hashes()
                first, h = windows([hashes], words.ptr, 3)
                ends = np.searchsorted(first, words.ptr)
                lo, hi = [], []
                for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                    own = h[a:b] if b > a else mix(hashes[words.ptr[i] : words.ptr[i + 1]])
                    lo.append(int(own.min().view(np.int64)) if len(own) else 0)
                    hi.append(int(own.max().view(np.int64)) if len(own) else 0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text").cast(pa.string()), batch.column("y").cast(pa.int32()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], schema=schema)

    out = sample.select("doc_id", "text", "y").mapInArrow(keyed, "doc_id long, text string, y int, lo long, hi long")
    for key in ("lo", "hi"):
        out = out.groupBy(key).agg(F.min_by(F.struct("doc_id", "text", "y", "lo", "hi"), F.struct("doc_id", "y")).alias("r")).select("r.*")
    return keep(out.select("doc_id", "text", "y"))


def token_counts(sample: DataFrame) -> DataFrame:
    """(token, c0, c1): texts of each class that hold a token or beginning; the token '' counts all texts."""

    def count(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                for w in {x for w in set(tokens(text.as_py())) for x in forms(w)} | {""}:
                    seen.setdefault(w, [0, 0])[y] += 1
            yield pa.RecordBatch.from_pydict({"token": list(seen), "c0": [c[0] for c in seen.values()], "c1": [c[1] for c in seen.values()]},
                                             schema=pa.schema([("token", pa.string()), ("c0", pa.int64()), ("c1", pa.int64())]))

    return sample.select("text", "y").mapInArrow(count, "token string, c0 long, c1 long").groupBy("token").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def token_weights(counts: DataFrame, n0: int, n1: int, prior: float, errors: float) -> DataFrame:
    """(token, w): log-odds of a token in toxic against clean texts, less `errors` standard errors, without those left at zero.

    `prior` texts of either class are spread over the tokens as the whole sample is.
    """
    a = F.lit(prior) * (F.col("c0") + F.col("c1")) / F.lit(n0 + n1)
    y1, y0 = F.col("c1") + a, F.col("c0") + a
    delta = F.log(y1 / (F.lit(n1 + prior) - y1)) - F.log(y0 / (F.lit(n0 + prior) - y0))
    left = F.greatest(F.abs(delta) - errors * F.sqrt(1 / y1 + 1 / y0), F.lit(0.0))
    return counts.where(F.col("token") != "").select("token", (F.signum(delta) * left).alias("w")).where((F.col("w") != 0) & ~F.isnan("w"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 8000, prior: float = 20.0, errors: float = 3.0, drift: float = 0.7) -> ToxicModel:
    """Learn from at most `per_class` labelled documents a class.

    The driver sees the tokens of that sample whose log-odds outweigh their standard errors, which takes several
    texts each, and three numbers a text.
    """
    sample = one_of_a_family(labelled_sample(docs, labels, label, per_class))
    counts = keep(token_counts(sample))
    total = counts.where(F.col("token") == "").first()
    if total is None or not total.c0 or not total.c1:
        return ToxicModel()
    model = ToxicModel({r.token: r.w for r in token_weights(counts, total.c0, total.c1, prior, errors).collect()}, drift)

    def scanned(value) -> DataFrame:
        packed = docs.sparkSession.sparkContext.broadcast(model)

        def scan(batches):
            scorer = Scorer(packed.value)
            for batch in batches:
                rows = [scorer.segments(t.as_py()) for t in batch.column("text")]
                yield pa.RecordBatch.from_pydict({"y": batch.column("y").to_pylist(), "n": [n for n, _ in rows], "x": [value(packed.value, [s for *_, s in found], n) for n, found in rows]},
                                                 schema=pa.schema([("y", pa.int32()), ("n", pa.int64()), ("x", pa.float64())]))

        return sample.select("text", "y").mapInArrow(scan, "y int, n long, x double").toPandas()  # at most 2 * per_class rows

    best = scanned(lambda m, segments, n: max(segments, default=0.0))
    model.lam, model.k = gumbel(best["x"].to_numpy()[best["y"] == 0], best["n"].to_numpy()[best["y"] == 0])
    evidence = scanned(lambda m, segments, n: m.evidence(segments, n))
    model.slope, model.bias = logistic_1d(evidence["x"].to_numpy(), evidence["y"].to_numpy())
    model.slope = max(model.slope, 1e-3)
    return model


def gumbel(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(lambda, K) of clean texts' best segment scores: P(best > s) = 1 - exp(-K n exp(-lambda s)) in a text of n tokens."""
    best, n = best[n > 0], n[n > 0]
    some = best[best > 0]
    lam = min(2.0, 1 / max(float(some.std()) * math.sqrt(6) / math.pi, 1e-3)) if len(some) >= 20 else 1.0
    return lam, max(float(len(best)), 1.0) / max(float((n * np.exp(-lam * best)).sum()), 1e-9)


def logistic_1d(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and bias by Newton steps, with the classes weighed as in the sample."""
    scale, middle = float(x.std()) or 1.0, float(x.mean())
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1] - w[0] * middle / scale)


def score(docs: DataFrame, model: ToxicModel, significance: float = 1e-3) -> DataFrame:
    """doc_id, score and the significant passages (token range, segment score, tail probability) of every whole text."""
    packed = docs.sparkSession.sparkContext.broadcast(model)  # the labelled sample bounds its weights

    def run(batches):
        m = packed.value
        scorer = Scorer(m)
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_passages", pa.int32()),
                            ("passages", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())])))])
        for whole in batches:
            for batch in text_slices(whole, "text"):
                scores, found = [], []
                for text in batch.column("text"):
                    n, segments = scorer.segments(text.as_py())
                    passages = []
                    for a, b, s in segments:
                        p = m.tail(s, n)
                        if p <= significance:
                            passages.append({"start": a, "end": b, "score": s, "p_value": p})
                    scores.append(m.score([s for _, _, s in segments], n))
                    found.append(passages)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").cast(pa.int64()), "score": scores, "n_passages": [len(p) for p in found], "passages": found}, schema=schema)

    return by_bytes(docs).select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, SCORE_SCHEMA)


def drop_toxic(docs: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that score below the threshold."""
    packed = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = packed.value
        scorer = Scorer(m)
        for whole in batches:
            for batch in text_slices(whole, "text"):
                kept = []
                for text in batch.column("text"):
                    n, segments = scorer.segments(text.as_py())
                    kept.append(m.score([s for *_, s in segments], n) < threshold)
                yield batch.filter(pa.array(kept, pa.bool_()))

    return by_bytes(docs).mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's digest: doc_id, held_out, score, predicted, n_passages."""
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages")
