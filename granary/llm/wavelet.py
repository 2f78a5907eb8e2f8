"""Token ids as a wavelet matrix per shard.

A shard is one self-contained blob: a header, document ids and lengths, and one bit plane a bit of the
vocabulary. Every plane holds that bit of all tokens, in the order that a stable partition by the planes before it
leaves. Planes lie in chunks that are compressed each on its own, with the number of ones before each chunk, so
token access, the number of times a token occurs before a place (rank) and the place of its n-th occurrence
(select) inflate only the chunks that they touch.

Shards are rows of a Parquet table in ascending document order, written with Spark's commit protocol, so a lost
executor's task is simply run again.

Defined results: null and empty texts have the end id alone; a null doc_id comes first and is read back as null;
rows with the same doc_id stay apart, ordered by their text's hash; repeated rows are encoded alike; an empty table
gives an empty result; other columns are ignored; a very long text is encoded whole, and a document longer than a
shard gets a shard of its own.
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _LATIN, _SPACE, LETTER, NUMBER
from .shared import by_bytes, keep
from .words import text_slices

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
PLANES = 16
_NULL_ID = -(2**63)  # stands for a null doc_id in a shard
SHARD_TOKENS = 1 << 20
TASK_BYTES = 128 << 20  # of text a task
_MAGIC = b"GWM2"
_HEAD = struct.Struct("<4sIQI")
_LIBRARY_ONLY = re.compile(f"[\\x1c-\\x1f{chr(_LATIN)}-{chr(0x10FFFF)}]")
_JOINED = 512
_CHUNK = 1 << 13  # bytes of a plane that are compressed together
_PIECES = re.compile(f"[{LETTER}]+|[{NUMBER}]|'s|'t|'re|'ve|'m|'ll|'d|[^{_SPACE}{LETTER}{NUMBER}]+")


class WaveletMatrix:
    """Access, rank and select over the bit planes of one shard, as they lie in its blob."""

    def __init__(self, raw: bytes):
        magic, planes, self.n, documents = _HEAD.unpack_from(raw)
        if magic != _MAGIC:
            raise ValueError("not a wavelet shard")
        self._raw, self._inflate, at = raw, zstandard.ZstdDecompressor().decompress, _HEAD.size
        chunks = -(-self.n // (8 * _CHUNK))
        self.zeros = struct.unpack_from(f"<{planes}Q", raw, at)
        at += 8 * planes
        # where each chunk ends, and the ones before it in its plane
        self._ends, self._ones = np.frombuffer(raw, dtype="<i8", count=2 * planes * chunks, offset=at).reshape(2, planes, chunks)
        at += 16 * planes * chunks
        sizes = struct.unpack_from("<2Q", raw, at)
        at += 16
        self.doc_ids = np.frombuffer(self._inflate(raw[at : at + sizes[0]]), dtype="<i8", count=documents)
        at += sizes[0]
        self.lengths = np.frombuffer(self._inflate(raw[at : at + sizes[1]]), dtype="<i8", count=documents)
        self._base = at + sizes[1]
        self._starts = np.concatenate([[0], self._ends.ravel()[:-1]]).reshape(planes, chunks) if chunks else self._ends
        self._chunk = lru_cache(maxsize=4 * planes)(self._inflated)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        return cls(raw)

    def to_bytes(self) -> bytes:
        return self._raw

    @classmethod
    def build(cls, tokens: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, planes: int = PLANES) -> WaveletMatrix:
        pack = zstandard.ZstdCompressor(level=1).compress
        zeros, chunks, ones = [], [], []
        current = tokens.astype(np.uint16)
        for b in range(planes - 1, -1, -1):
            bit = (current & np.uint16(1 << b)) != 0
            plane = np.packbits(bit, bitorder="little")
            parts = [plane[i : i + _CHUNK] for i in range(0, len(plane), _CHUNK)]
            counts = [int(np.bitwise_count(p).sum()) for p in parts]
            ones.append(np.cumsum(counts, dtype=np.int64) - counts)
            chunks += [pack(p.tobytes()) for p in parts]
            low = current[~bit]
            zeros.append(len(low))
            current = np.concatenate([low, current[bit]])
        ends = np.cumsum([len(c) for c in chunks], dtype="<i8")
        ids, sizes = (pack(np.asarray(x, dtype="<i8").tobytes()) for x in (doc_ids, lengths))
        head = _HEAD.pack(_MAGIC, planes, len(tokens), len(doc_ids)) + struct.pack(f"<{planes}Q", *zeros)
        return cls(b"".join([head, ends.tobytes(), np.concatenate(ones).astype("<i8").tobytes(), struct.pack("<2Q", len(ids), len(sizes)), ids, sizes, *chunks]))

    def _inflated(self, level: int, chunk: int) -> np.ndarray:
        start, end = self._starts[level, chunk], self._ends[level, chunk]
        return np.frombuffer(self._inflate(self._raw[self._base + start : self._base + end]), dtype=np.uint8)

    def tokens(self) -> np.ndarray:
        """All tokens: the stable partitions undone from the last plane to the first."""
        planes, chunks = self._ends.shape
        current = np.zeros(self.n, dtype=np.uint16)
        for level in range(planes - 1, -1, -1):
            plane = np.concatenate([self._inflated(level, c) for c in range(chunks)]) if chunks else np.zeros(0, dtype=np.uint8)
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            above = np.empty_like(current)
            above[~bit] = current[: self.zeros[level]]
            above[bit] = current[self.zeros[level] :] | np.uint16(1 << (planes - 1 - level))
            current = above
        return current

    def _rank1(self, level: int, i: int) -> int:
        """Ones before place i: those before its chunk, and those of one chunk."""
        chunk, rest = divmod(i, 8 * _CHUNK)
        if not rest:
            if i == 0:
                return 0
            if chunk == self._ones.shape[1]:
                return self.n - self.zeros[level]
            return int(self._ones[level, chunk])
        own = self._chunk(level, chunk)
        whole = int(np.bitwise_count(own[: rest >> 3]).sum())
        if rest & 7:
            whole += int(own[rest >> 3] & ((1 << (rest & 7)) - 1)).bit_count()
        return int(self._ones[level, chunk]) + whole

    def _bit(self, level: int, i: int) -> int:
        chunk, rest = divmod(i, 8 * _CHUNK)
        return (int(self._chunk(level, chunk)[rest >> 3]) >> (rest & 7)) & 1

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.zeros)):
            bit = self._bit(level, i)
            value = value << 1 | bit
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        first, last = 0, end
        for level in range(len(self.zeros)):
            a, b = self._rank1(level, first), self._rank1(level, last)
            if token >> (len(self.zeros) - 1 - level) & 1:
                first, last = self.zeros[level] + a, self.zeros[level] + b
            else:
                first, last = first - a, last - b
        return first, last

    def rank(self, token: int, end: int | None = None) -> int:
        """Occurrences of a token before `end` (in the whole shard by default)."""
        first, last = self._range(token, self.n if end is None else end)
        return last - first

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of that value: the chunk by its count before, then the place in it."""
        before = self._ones[level] if bit else np.arange(self._ones.shape[1]) * (8 * _CHUNK) - self._ones[level]
        chunk = int(np.searchsorted(before, k, side="right")) - 1
        start = chunk * 8 * _CHUNK
        bits = np.unpackbits(self._chunk(level, chunk), count=min(8 * _CHUNK, self.n - start), bitorder="little")
        return start + int(np.flatnonzero(bits == bit)[k - int(before[chunk])])

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence; IndexError if there are fewer."""
        first, last = self._range(token, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        i = first + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def places(self, token: int) -> list[int]:
        """Every place of a token, in order."""
        return [self.select(token, k) for k in range(self.rank(token))]


class _Numbered(dict):
    """Numbers strings as they come up; those that are new since the last call to fresh() are kept apart."""

    def __init__(self):
        self.pending: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.pending.append(key)
        return number

    def number(self, strings: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, strings), dtype=np.int64, count=len(strings))

    def fresh(self) -> list[str]:
        out, self.pending = self.pending, []
        return out


class _Spans:
    """Token ids of numbered strings: one flat array, and where each string's own begin."""

    def __init__(self):
        self.flat, self.used = np.empty(1 << 16, dtype=np.uint16), 0
        self.ends, self.n = np.zeros(1 << 16, dtype=np.int64), 0

    def append(self, ids: np.ndarray, counts: np.ndarray) -> None:
        for name, used, more in (("flat", self.used, len(ids)), ("ends", self.n + 1, len(counts))):
            old = getattr(self, name)
            if used + more > len(old):
                new = np.empty(2 * (used + more), dtype=old.dtype)
                new[:used] = old[:used]
                setattr(self, name, new)
        self.flat[self.used : self.used + len(ids)] = ids
        self.ends[self.n + 1 : self.n + 1 + len(counts)] = self.used + np.cumsum(counts)
        self.used, self.n = self.used + len(ids), self.n + len(counts)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the strings one after the other, number of ids of each)."""
        starts = self.ends[numbers]
        counts = self.ends[numbers + 1] - starts
        after = np.cumsum(counts)
        return self.flat[np.repeat(starts - (after - counts), counts) + np.arange(after[-1] if len(after) else 0)], counts


class WordBpe:
    """The library's encoding with a bounded memory of words and pieces; the library encodes each new piece.

    No piece crosses white space. Texts that have characters from U+0250 on once they are in lower case, or
    control characters on whose class str.split() and the library differ, go to the library whole.
    """

    def __init__(self, path: str, words: int = 700_000, pieces: int = 900_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a piece
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.most_words, self.most_pieces = words, pieces
        self.words, self.word_ids = _Numbered(), _Spans()
        self.pieces, self.piece_ids = _Numbered(), _Spans()

    def _learn(self, words: list[str]) -> None:
        """Ids of words between white space: those of their pieces, of which the library encodes the new ones."""
        if len(self.pieces) > self.most_pieces:
            self.pieces, self.piece_ids = _Numbered(), _Spans()
        found = list(map(_PIECES.findall, words))
        numbers = self.pieces.number(list(chain.from_iterable(found)))
        new = self.pieces.fresh()
        for at in range(0, len(new), _JOINED):  # many pieces a call: each ends with an id that ends a piece
            some = new[at : at + _JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids)
            ends = np.flatnonzero(self.last[ids])
            if len(ends) == len(some):
                self.piece_ids.append(ids, np.diff(ends, prepend=-1))
            else:  # a piece that is more than one to the library, or none
                each = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                self.piece_ids.append(np.array(list(chain.from_iterable(each)), dtype=np.uint16), np.fromiter(map(len, each), dtype=np.int64, count=len(each)))
        ids, counts = self.piece_ids.take(numbers)
        per_word = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        sums = np.concatenate([[0], np.cumsum(counts)])
        self.word_ids.append(ids, np.diff(sums[np.concatenate([[0], np.cumsum(per_word)])]))

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.words) > self.most_words:
            self.words, self.word_ids = _Numbered(), _Spans()
        whole, sizes, numbers = [], [], []
        for i, text in enumerate(texts):
            low = text.lower() if text else ""
            if low and ((not low.isascii() or not low.isprintable()) and _LIBRARY_ONLY.search(low) or any(s in text for s in self.special)):
                whole.append(i)
                found = []
            else:
                found = low.split()
            sizes.append(len(found))
            numbers.append(self.words.number(found))
        if new := self.words.fresh():
            self._learn(new)
        ids, counts = self.word_ids.take(np.concatenate(numbers) if numbers else np.zeros(0, dtype=np.int64))
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)] if sizes else []
        out = np.split(ids, ends[:-1]) if len(ends) else []
        for i in whole:
            out[i] = np.array(self.tokenizer.encode_batch_fast([texts[i]], add_special_tokens=False)[0].ids, dtype=np.uint16)
        return out


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def write_shards(docs: DataFrame, path: str = VOCABULARY, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the table read back.

    part: place of the task in doc_id order; first: tokens of that part before the shard; n_tokens; shard: the blob.
    """

    def run(batches):
        bpe, part = load(path), TaskContext.get().partitionId()
        ids, lengths, arrays, size, first = [], [], [], 0, 0
        end = np.array([end_id], dtype=np.uint16)

        def flush():
            tokens = np.concatenate(arrays)
            blob = WaveletMatrix.build(tokens, np.array(ids), np.array(lengths)).to_bytes()
            return pa.RecordBatch.from_pydict({"part": [part], "first": [first], "n_tokens": [len(tokens)], "shard": [blob]},
                                              schema=pa.schema([("part", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("shard", pa.binary())]))

        for whole in batches:
            for batch in text_slices(whole, "text"):
                for doc_id, tokens in zip(batch.column("doc_id").to_pylist(), bpe.encode_batch(batch.column("text").to_pylist())):
                    if size and size + len(tokens) >= shard_tokens:
                        yield flush()
                        first += size
                        ids, lengths, arrays, size = [], [], [], 0
                    arrays += [tokens, end]
                    ids.append(_NULL_ID if doc_id is None else doc_id)
                    lengths.append(len(tokens) + 1)
                    size += len(tokens) + 1
        if size:
            yield flush()

    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_bytes // TASK_BYTES)
    rows = by_bytes(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return keep(ordered.mapInArrow(run, "part int, first long, n_tokens long, shard binary"))


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the shards.

    Only one sum a part reaches the driver: there are as many as write_shards() had tasks.
    """
    before, total = {}, 0
    for row in sorted(shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        before[row.part] = total
        total += row.n

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for part, first, blob in zip(batch.column("part").to_pylist(), batch.column("first").to_pylist(), batch.column("shard")):
                matrix = WaveletMatrix.from_bytes(blob.as_py())
                tokens = matrix.tokens().astype("<u4")
                ends = np.cumsum(matrix.lengths)
                starts = ends - matrix.lengths
                crc = [zlib.crc32(tokens[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(matrix.doc_ids, pa.int64(), mask=matrix.doc_ids == _NULL_ID), pa.array(starts + (before[part] + first), pa.int64()), pa.array(matrix.lengths, pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    return shards.select("part", "first", "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """(part, first, n): how often a token occurs in each shard, by rank alone."""

    def run(batches):
        for batch in batches:
            n = [WaveletMatrix.from_bytes(b.as_py()).rank(token) for b in batch.column("shard")]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("first"), pa.array(n, pa.int64())], ["part", "first", "n"])

    return shards.select("part", "first", "shard").mapInArrow(run, "part int, first long, n long")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """(part, first, place): every place of a token within its shard, by select."""

    def run(batches):
        for batch in batches:
            for part, first, blob in zip(batch.column("part").to_pylist(), batch.column("first").to_pylist(), batch.column("shard")):
                matrix = WaveletMatrix.from_bytes(blob.as_py())
                places = matrix.places(token)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(places), pa.int32()), pa.array([first] * len(places), pa.int64()), pa.array(places, pa.int64())], ["part", "first", "place"])

    return shards.select("part", "first", "shard").mapInArrow(run, "part int, first long, place long")


def token_output(docs: DataFrame) -> DataFrame:
    """The contract's digest, read back from the written shards."""
    return read_shards(write_shards(docs))
