"""Words and word windows of Arrow text columns as numpy arrays.

A word is a maximal run of bytes outside space and 0x09-0x0D, as in the pattern ``[^\\x20\\x09-\\x0D]+``
on UTF-8. Null texts hold no words. Hashes depend only on the bytes, so every executor agrees on them; two lanes
make 128 bits.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_IS_TERM = np.ones(256, dtype=bool)  # letters and digits of ASCII, and every byte of other characters
_IS_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_CUT = 1 << 16  # words worked on at a time
_LONG = 64  # bytes; longer words are hashed by BLAKE2
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs; the order counts."""
    x = a * np.uint64(0xD6E8FEB86659FD93)
    x += b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return x


def _spans(v: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k neighbours, from those of 1, 2, 4, ... by the binary digits of k."""
    out, done, width = None, 0, 1
    while True:
        if k & width:
            out = v if out is None else _joined(out[: len(v) - done], v[done:])
            done += width
        width *= 2
        if width > k:
            return out
        v = _joined(v[: -(width // 2)], v[width // 2 :])


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # byte offsets of each word
    ends: np.ndarray
    ptr: np.ndarray  # words ptr[i] to ptr[i + 1] belong to text i

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def hashes(self, lanes: int = 1) -> list[np.ndarray]:
        """`lanes` independent 64-bit hashes of each word: every eight bytes pass through a finaliser, so that no
        pattern of letters makes two words alike."""
        out = [np.empty(len(self.starts), dtype=np.uint64) for _ in range(lanes)]
        for at in range(0, len(self.starts), _CUT):
            starts, ends = self.starts[at : at + _CUT], self.ends[at : at + _CUT]
            first = int(starts[0])
            padded = np.zeros(int(ends[-1]) - first + 8, dtype=np.uint8)
            padded[:-8] = self.data[first : int(ends[-1])]
            eight = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
            lengths = ends - starts
            own = [mix(lengths.astype(np.uint64), 31 + lane) for lane in range(lanes)]
            live, done = np.flatnonzero(lengths <= _LONG), 0
            while len(live):
                left = lengths[live] - done
                piece = eight[starts[live] - first + done] & _FIRST_BYTES[np.minimum(left, 8)]
                for lane in range(lanes):
                    own[lane][live] = mix(own[lane][live] ^ piece, lane)
                done += 8
                live = live[left > 8]
            for i in np.flatnonzero(lengths > _LONG).tolist():
                digest = hashlib.blake2b(self.data[starts[i] : ends[i]], digest_size=8 * lanes).digest()
                for lane, value in enumerate(np.frombuffer(digest, dtype="<u8")):
                    own[lane][i] = value
            for lane in range(lanes):
                out[lane][at : at + _CUT] = own[lane]
        return out


def find_terms(texts: pa.Array) -> Words:
    """Maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z as a-z."""
    return find_words(texts, lower=True, member=_IS_TERM)


def find_words(texts: pa.Array, lower: bool = False, member: np.ndarray = _IS_WORD) -> Words:
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, dtype=np.int64)
    raw = texts.buffers()[2] if n else None
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    word = member[data]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = word[edges]
    end[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: list[np.ndarray], ptr: np.ndarray, k: int) -> list[np.ndarray]:
    """[first word of each window of k words within one text, then one hash array a lane of `hashes`]."""
    counts = np.maximum(np.diff(ptr) - (k - 1), 0)
    before = np.cumsum(counts) - counts
    firsts = np.arange(int(counts.sum())) + np.repeat(ptr[:-1] - before, counts)
    out = [firsts]
    for lane in hashes:
        spans = np.empty(max(0, len(lane) - k + 1), dtype=np.uint64)
        for at in range(0, len(spans), _CUT):
            part = mix(_spans(lane[at : at + _CUT + k - 1], k))
            spans[at : at + len(part)] = part
        out.append(spans[firsts])
    return out


def short_texts(hashes: list[np.ndarray], ptr: np.ndarray, which: np.ndarray, k: int) -> list[np.ndarray]:
    """A hash array a lane of the whole word sequence of the texts `which`, of fewer than k words each."""
    counts = np.diff(ptr)[which]
    out = []
    for lane in hashes:
        own = counts.astype(np.uint64)
        for i in range(k - 1):
            more = np.flatnonzero(counts > i)
            own[more] = _joined(own[more], lane[ptr[which[more]] + i])
        out.append(mix(own, 7))
    return out


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 19):
    """The batch in slices of about `limit` text bytes, so that working arrays stay small."""
    i = batch.schema.get_field_index(column)
    lengths = pa.compute.binary_length(batch.column(i)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
