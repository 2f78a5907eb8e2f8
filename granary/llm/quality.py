"""Quality by a regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance, shrunk towards the pooled covariance and its diagonal. A text's score
is a logistic curve over the difference of the two Gaussian log densities; Mahalanobis distances use Cholesky
factors inverted once when the model is fitted.

Defined results: null and empty texts are scored from their statistics (all zero) like any other; very long texts
count whole; repeated rows are scored alike, and equal scores stay equal; an empty table gives an empty result; other columns are ignored. Without labelled rows
of both classes every score is the share of label 1, or 0.5 without labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import held_out, labelled_sample
from .toxicity import logistic_1d
from .words import Words, find_words, text_slices

_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[65:91] = 1
_KINDS[48:58] = 2
for _code, _chars in ((3, ".,;:'\"-?()"), (4, "!"), (5, "#$%&*@^~+=<>/\\|_[]{}`"), (6, "\n")):
    for _c in _chars:
        _KINDS[ord(_c)] = _code
_KINDS[97:123] = 7
_KINDS[128:] = 8
FEATURES = ("words", "word length", "length spread", "upper", "digit", "mark", "shout", "symbol", "line", "lower", "distinct", "repeated", "top word", "marked ends", "capital starts", "lone symbols")


def statistics(words: Words) -> np.ndarray:
    """One row of transformed statistics a text, from arrays over all bytes and words of a batch."""
    n = words.counts.astype(np.float64)
    some = np.maximum(n, 1)
    lengths = (words.ends - words.starts).astype(np.float64)
    per_text = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])[words.ptr])
    total = per_text(lengths)
    mean = total / some
    spread = np.sqrt(np.maximum(per_text(lengths**2) / some - mean**2, 0))
    kinds = _KINDS[words.data]
    counts = []
    for code in (1, 2, 3, 4, 5, 6, 7):
        sums = np.concatenate([[0], np.cumsum(kinds == code, dtype=np.int64)])
        # bytes from a text's first word to its last; line ends outside words count there too
        first = np.minimum(words.ptr[:-1], max(len(words.starts) - 1, 0))
        last = np.maximum(words.ptr[1:] - 1, 0)
        if len(words.starts):
            counts.append(np.where(n > 0, sums[words.ends[last]] - sums[words.starts[first]], 0).astype(np.float64))
        else:
            counts.append(np.zeros(len(n)))
    (hashes,) = words.hashes()
    text_of = np.repeat(np.arange(len(n)), words.counts)
    order = np.lexsort((hashes, text_of))
    sorted_hashes, sorted_text = hashes[order], text_of[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (sorted_hashes[1:] != sorted_hashes[:-1]) | (sorted_text[1:] != sorted_text[:-1])
    distinct = np.bincount(sorted_text[new], minlength=len(n)).astype(np.float64)
    runs = np.diff(np.append(np.flatnonzero(new), len(order)))
    top = np.zeros(len(n))
    np.maximum.at(top, sorted_text[new], runs.astype(np.float64))
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])
    starts, ends = (kinds[words.starts], kinds[words.ends - 1]) if len(lengths) else (np.zeros(0), np.zeros(0))
    upper, digit, mark, shout, symbol, line, lower = counts
    chars = np.maximum(total, 1)
    share = lambda x: np.sqrt(x / chars)  # noqa: E731  the root spreads small shares out
    return np.column_stack([
        np.log1p(n), np.log1p(mean), np.log1p(spread), share(upper), share(digit), share(mark), share(shout), share(symbol), np.sqrt(line / some), share(lower),
        np.log((distinct + 1) / (n + 1)), np.sqrt(per_text(again) / some), np.sqrt(top / some), np.sqrt(per_text(np.isin(ends, (3, 4, 5))) / some), np.sqrt(per_text(starts == 1) / some),
        np.sqrt(per_text((lengths <= 2) & np.isin(starts, (3, 4, 5))) / some),
    ])


@dataclass
class QualityModel:
    middle: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: tuple[np.ndarray, np.ndarray] | None = None
    inverse: tuple[np.ndarray, np.ndarray] | None = None  # inverted lower Cholesky factors of the class covariances
    log_det: tuple[float, float] = (0.0, 0.0)
    slope: float = 1.0
    bias: float = 0.0
    constant: float = 0.5

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of label 1 minus that of label 0, drawn in so that far outliers stay finite."""
        z = np.clip((x - self.middle) / self.scale, -30, 30)
        density = [-0.5 * (self.log_det[c] + (((z - self.means[c]) @ self.inverse[c].T) ** 2).sum(axis=1)) for c in (0, 1)]
        d = density[1] - density[0]
        return np.sign(d) * np.log1p(np.abs(d))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.bias, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 8000, shrink: float = 0.1, ridge: float = 0.05) -> QualityModel:
    """Learn from at most `per_class` labelled documents a class; the driver sees their statistics, 16 numbers each.

    Class covariance = (1 - shrink) * own + shrink * pooled, plus `ridge` on the (standardised) diagonal.
    """

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                x = statistics(find_words(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("y").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    seen = labelled_sample(docs, labels, label, per_class).mapInArrow(run, "y int, x array<double>").toPandas()
    y = seen["y"].to_numpy()
    if len(y) == 0 or y.min() == y.max() or min((y == 0).sum(), (y == 1).sum()) < 2:
        return QualityModel(constant=float(y.mean()) if len(y) else 0.5)
    x = np.vstack(seen["x"].to_list())
    model = QualityModel(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3))
    z = (x - model.middle) / model.scale
    model.means = (z[y == 0].mean(axis=0), z[y == 1].mean(axis=0))
    own = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum(own[c] * (y == c).mean() for c in (0, 1))
    factors = [np.linalg.cholesky((1 - shrink) * s + shrink * pooled + ridge * np.eye(len(s))) for s in own]
    model.inverse = (np.linalg.inv(factors[0]), np.linalg.inv(factors[1]))
    model.log_det = tuple(float(2 * np.log(np.diag(f)).sum()) for f in factors)
    model.slope, model.bias = logistic_1d(model.difference(x), y)
    model.slope = max(model.slope, 1e-3)
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of every whole text, one pass without a shuffle."""
    packed = docs.sparkSession.sparkContext.broadcast(model)  # a few small matrices

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                s = packed.value.score(statistics(find_words(batch.column("text"))))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's digest: doc_id, held_out, score, predicted (1 from a score of 0.3)."""
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
