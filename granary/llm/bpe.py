"""Byte-level BPE encoding and decoding by a segment tree over adjacent pair ranks.

A piece's leaves hold rank and place of each adjacent pair; the root is the leftmost pair of the lowest rank.
Merging it changes three leaves and their ways to the root, until the root holds no mergeable pair. Many
pieces of like length are worked on at once, a row of one array each; in one long piece all places of the root's
rank that do not touch are merged in a step. A worker remembers the pieces it has seen, up to a bound, because most
words return.

Defined results: null texts are empty (no ids); very long texts are encoded whole; a special token's string in a text
is its id, as in the library; of equal ranks the leftmost pair is merged first; repeated rows are encoded alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import by_bytes
from .words import text_slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
_NONE = np.int64(1 << 62)
_LONG = 2048  # leaves of a piece that is worked on by itself
_SPACE = "\\t-\\r \\x85\\xa0"
_LATIN = 0x250  # below it the character classes are written out; other texts are split by the library itself
_OTHER_SCRIPT = re.compile(f"[^\\x00-{chr(_LATIN - 1)}]")


def _category_class(kind: str) -> str:
    """The characters of one general category below _LATIN, as ranges of a regular expression class."""
    codes = [c for c in range(_LATIN) if unicodedata.category(chr(c))[0] == kind]
    out, start = [], None
    for c, following in zip(codes, [*codes[1:], -1]):
        start = c if start is None else start
        if following != c + 1:
            out.append(f"\\u{start:04x}-\\u{c:04x}")
            start = None
    return "".join(out)


LETTER, NUMBER = _category_class("L"), _category_class("N")
# the contractions begin with a mark, so words, by far the most pieces, may be tried before them
PIECES = re.compile(f" ?[{LETTER}]+| ?[{NUMBER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_SPACE}{LETTER}{NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b) if b in shown else chr(spare))
        spare += b not in shown
    return out


class PairTree:
    """Merges of many pieces at once; rows of the arrays are pieces."""

    def __init__(self, pairs: np.ndarray, made: np.ndarray):
        """pairs: left id * 2**20 + right id of each merge by rank; made: the merged ids."""
        self.made = made
        # whether every pair of a merged token ranks behind all merges that make it; then a merge opens no earlier one
        last = np.full(1 << 20, -1, dtype=np.int64)
        np.maximum.at(last, made, np.arange(len(pairs)))
        self.ordered = bool((np.maximum(last[pairs >> 20], last[pairs & ((1 << 20) - 1)]) < np.arange(len(pairs))).all())
        # one probe a lookup: pairs that share a slot go to a sorted rest, searched only where a slot says so
        self.bits = 64 - max(16, (8 * len(pairs)).bit_length())
        slots = self._slots(pairs)
        self.keys = np.full(1 << (64 - self.bits), -1, dtype=np.int64)
        self.ranks = np.zeros(len(self.keys), dtype=np.int64)
        self.keys[slots], self.ranks[slots] = pairs, np.arange(len(pairs))
        rest = np.flatnonzero(self.keys[slots] != pairs)
        rest = rest[np.argsort(pairs[rest])]
        self.rest_keys, self.rest_ranks = pairs[rest], rest.astype(np.int64)
        self.crowded = np.zeros(len(self.keys), dtype=bool)
        self.crowded[slots[rest]] = True

    def _slots(self, wanted: np.ndarray) -> np.ndarray:
        return ((wanted.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.bits)).view(np.int64)

    def _leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        wanted = (left << 20) + right
        slots = self._slots(wanted)
        same = self.keys[slots] == wanted
        out = np.where(same, (self.ranks[slots] << 32) + place, _NONE)
        other = np.flatnonzero(self.crowded[slots] & ~same)
        if len(other):
            asked = wanted[other]
            at = np.minimum(np.searchsorted(self.rest_keys, asked), len(self.rest_keys) - 1)
            out[other] = np.where(self.rest_keys[at] == asked, (self.rest_ranks[at] << 32) + place[other], _NONE)
        return out

    def encode(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, number of ids of each), from the initial ids."""
        starts = np.cumsum(sizes) - sizes
        made, counts = flat.copy(), sizes.copy()  # each piece's ids at its own start, then closed up
        widths = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
        for width in np.unique(widths[sizes > 1]).tolist():
            members = np.flatnonzero((widths == width) & (sizes > 1))
            if width >= _LONG and self.ordered:
                for i in members.tolist():
                    ids = self._encode_long(flat[starts[i] : starts[i] + sizes[i]].copy(), width)
                    counts[i] = len(ids)
                    made[starts[i] : starts[i] + len(ids)] = ids
                continue
            rows = max(1, (1 << 15) // width)
            for at in range(0, len(members), rows):
                part = members[at : at + rows]
                own = np.arange(width) < sizes[part][:, None]
                ids, left = self._encode_rows(flat[(starts[part][:, None] + np.arange(width))[own]], own, width)
                counts[part] = left
                made[(starts[part][:, None] + np.arange(width))[np.arange(width) < left[:, None]]] = ids
        ends = np.cumsum(counts)
        return made[np.repeat(starts - (ends - counts), counts) + np.arange(int(counts.sum()))], counts

    def _encode_long(self, ids: np.ndarray, width: int) -> np.ndarray:
        """One piece: the root's rank is merged wherever it stands, from the left, before the root is asked again.

        In an ordered vocabulary these merges come next in turn anyway, as none of them makes a pair of lower rank.
        """
        n = len(ids)
        following, previous = np.arange(1, n + 1), np.arange(-1, n)
        tree = np.full(2 * width, _NONE, dtype=np.int64)
        tree[width : width + n - 1] = self._leaves(ids[:-1], ids[1:], np.arange(n - 1))
        span = width
        while span > 1:
            tree[span // 2 : span] = np.minimum(tree[span : 2 * span : 2], tree[span + 1 : 2 * span : 2])
            span //= 2
        while tree[1] < _NONE:
            rank, nodes = tree[1] >> 32, np.array([1])
            while nodes[0] < width:
                nodes = np.stack([2 * nodes, 2 * nodes + 1], axis=1).ravel()
                nodes = nodes[tree[nodes] >> 32 == rank]
            places = nodes - width
            # of places that touch every second one, from the left
            begins = np.concatenate([[True], places[1:] != following[places[:-1]]])
            first = np.flatnonzero(begins)
            i = places[(np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))) % 2 == 0]
            j = following[i]
            after = following[j]
            ids[i] = self.made[rank]
            following[i] = after
            previous[after] = i
            before = previous[i]
            at = np.unique(np.concatenate([i, before[before >= 0]]))
            right = following[at]
            tree[width + j] = _NONE
            tree[width + at] = np.where(right < n, self._leaves(ids[at], ids[np.minimum(right, n - 1)], at), _NONE)
            nodes = np.unique(np.concatenate([at, j]) + width)
            while nodes[0] > 1:
                nodes = np.unique(nodes >> 1)
                tree[nodes] = np.minimum(tree[2 * nodes], tree[2 * nodes + 1])
        alive, at = [], 0
        while at < n:
            alive.append(at)
            at = int(following[at])
        return ids[alive]

    def _encode_rows(self, flat: np.ndarray, own: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        k, sizes = len(own), own.sum(axis=1)
        ids = np.full((k, width + 1), -1, dtype=np.int64)  # a column more: what "no neighbour" points at
        ids[:, :width][own] = flat
        following = np.broadcast_to(np.arange(1, width + 2), (k, width + 1)).copy()
        following[np.arange(k), sizes - 1] = width
        previous = np.broadcast_to(np.arange(-1, width), (k, width + 1)).copy()
        previous[:, 0] = width
        alive = ids >= 0
        tree = np.full((k, 2 * width), _NONE, dtype=np.int64)
        pair = alive[:, 1:width] if width > 1 else alive[:, :0]
        row, place = np.nonzero(pair)
        tree[row, width + place] = self._leaves(ids[row, place], ids[row, place + 1], place)
        span = width
        while span > 1:
            tree[:, span // 2 : span] = np.minimum(tree[:, span : 2 * span : 2], tree[:, span + 1 : 2 * span : 2])
            span //= 2
        flat_tree, flat_ids, flat_next, flat_before = tree.ravel(), ids.ravel(), following.ravel(), previous.ravel()
        rows = np.arange(k)
        while True:
            root = flat_tree[rows * (2 * width) + 1]
            going = root < _NONE
            rows, root = rows[going], root[going]
            if not len(rows):
                break
            base = rows * (width + 1)
            i = root & 0xFFFFFFFF
            j = flat_next[base + i]
            after = flat_next[base + j]
            before = flat_before[base + i]
            new = self.made[root >> 32]
            flat_ids[base + i] = new
            flat_next[base + i] = after
            flat_before[base + after] = i
            alive[rows, j] = False
            right = np.where(after < width, self._leaves(new, flat_ids[base + after], i), _NONE)
            left = np.where(before < width, self._leaves(flat_ids[base + before], new, before), _NONE)
            leaf = rows * (2 * width) + width
            flat_tree[leaf + i] = right
            flat_tree[leaf + j] = _NONE
            has = before < width
            flat_tree[(leaf + before)[has]] = left[has]
            own = np.concatenate([rows, rows, rows[has]]) * (2 * width)
            node = np.concatenate([i, j, before[has]]) + width
            while node[0] > 1:
                node = node >> 1
                flat_tree[own + node] = np.minimum(flat_tree[own + 2 * node], flat_tree[own + 2 * node + 1])
        alive = alive[:, :width]
        return ids[:, :width][alive], alive.sum(axis=1)


class Bpe:
    """One vocabulary file; `remember` bounds the pieces whose ids a worker keeps."""

    def __init__(self, path: str, remember: int = 100_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.remember = path, remember
        vocabulary = spec["model"]["vocab"]
        letters = _byte_letters()
        self.byte_ids = np.array([vocabulary[c] for c in letters], dtype=np.int64)
        byte_of = {c: b for b, c in enumerate(letters)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.tree = PairTree(np.array([(vocabulary[a] << 20) + vocabulary[b] for a, b in merges], dtype=np.int64), np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.ints = list(range(size))
        self.digits = [str(i) for i in self.ints]
        self.bytes = [b""] * size
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.byte_of = byte_of
        self.known: dict[str, tuple[int, ...]] = {}
        self._splitter = None

    def pieces(self, text: str) -> list[str]:
        if not _OTHER_SCRIPT.search(text):
            return PIECES.findall(text)
        if self._splitter is None:
            from tokenizers import Tokenizer

            self._splitter = Tokenizer.from_file(self.path).pre_tokenizer
        return [bytes(self.byte_of[c] for c in p).decode("utf-8", "surrogateescape") for p, _ in self._splitter.pre_tokenize_str(text)]

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        split, wanted = [], set()
        for text in texts:
            parts = [text or ""]
            if self.special_split and any(s in parts[0] for s in self.special):
                parts = self.special_split.split(parts[0])
            found = [(p,) if n % 2 else self.pieces(p) for n, p in enumerate(parts)]  # odd parts are special tokens
            split.append(found)
            for n, p in enumerate(found):
                if n % 2 == 0:
                    wanted.update(p)
        if len(self.known) > self.remember:
            self.known.clear()
        new = [p for p in wanted if p not in self.known]
        for at in range(0, len(new), 1 << 16):
            some = new[at : at + (1 << 16)]
            raw = [p.encode("utf-8", "surrogateescape") for p in some]
            ids, counts = self.tree.encode(self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)], np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
            shared = list(map(self.ints.__getitem__, ids.tolist()))
            ends = np.cumsum(counts).tolist()
            self.known.update(zip(some, map(tuple, (shared[a:b] for a, b in zip([0, *ends[:-1]], ends)))))
        known = self.known.__getitem__
        out = []
        for found in split:
            ids: list[int] = []
            for n, p in enumerate(found):
                ids.extend([self.special[p[0]]] if n % 2 else chain.from_iterable(map(known, p)))
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""

    def run(batches):
        bpe = load(path)
        for whole in batches:
            for batch in text_slices(whole, "text"):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(bpe.encode_batch(batch.column("text").to_pylist()), pa.list_(pa.int32()))], ["doc_id", "ids"])

    return by_bytes(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""

    def run(batches):
        bpe = load(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([bpe.decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return by_bytes(encoded).select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def bpe_round_trip(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The contract's digest: ids are made and decoded in one pass, so that they need not travel."""

    def run(batches):
        bpe = load(path)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for whole in batches:
            for batch in text_slices(whole, "text"):
                encoded = bpe.encode_batch(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(map(len, encoded), pa.int64()), pa.array([digest(",".join(map(bpe.digits.__getitem__, ids))) for ids in encoded], pa.string()), pa.array([digest(bpe.decode(ids)) for ids in encoded], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return by_bytes(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
