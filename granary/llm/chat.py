"""Chat formatting at token level.

Each turn becomes TURN role TEXT content END: the segments are encoded apart from each other and reserved ids,
outside the vocabulary, are spliced between them, so no text can produce a marker. Control strings inside texts
get a backslash after their first character (one more where there are some), which reading back takes away.
The loss mask of a conversation comes from prefix sums over segment lengths and covers assistant texts.

Turns are encoded where they are read; only then are conversations brought together, by id and in turn order,
and streamed turn by turn, so that a conversation of any length needs the memory of one turn. The formatted turns
are written as a table, from which the digests are read back.

Defined results: null role and null text are empty; a very long text is encoded as by one call; turns with the same
number are ordered by role and text; null turns come first; rows with a null conv_id form one conversation; repeated
rows are turns of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_bytes, keep

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
TURN, TEXT, END = 50257, 50258, 50259
MARKERS = {TURN: "<|turn|>", TEXT: "<|text|>", END: "<|end|>"}
CONTROLS = (*MARKERS.values(), "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_PLAIN = re.compile("|".join(f"(?<={re.escape(c[0])})(?=\\\\*{re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile("|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in CONTROLS))
# white space as the splitting pattern has it; longer runs exceed the depth to which the library can go back
_BLANKS = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{1000,}")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a whole text.

    A long run of white space is one piece up to its last character, which goes with what follows; so the pattern
    always cuts before the run and before that character.
    """
    ids, at = [], 0
    for run in _BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        ids += enc.encode_ordinary(text[at : run.start()]) + enc._encode_single_piece(text[run.start() : end])
        at = end
    return ids + enc.encode_ordinary(text[at:])


def encode_turns(turns: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(conv_id, turn, role, text, head, body, loss): little-endian int32 ids of TURN role TEXT and of the text."""

    def run(batches):
        enc = encoding(path)
        for batch in batches:
            heads, bodies, loss = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                heads.append(np.array([TURN, *encode_text(enc, escape(role or "")), TEXT], dtype="<i4").tobytes())
                bodies.append(np.array(encode_text(enc, escape(text or "")), dtype="<i4").tobytes())
                loss.append(role == "assistant")
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), batch.column("role"), batch.column("text"), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary()), pa.array(loss, pa.bool_())],
                                             ["conv_id", "turn", "role", "text", "head", "body", "loss"])

    rows = by_bytes(turns).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, head binary, body binary, loss boolean")


def assemble(turns: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(conv_id, start, ids, mask): a row a turn, in order within a partition.

    `start` is the turn's first position in its conversation; ids are little-endian int32, mask a byte a token.
    """

    def run(batches):
        conv, at = object(), 0
        for batch in batches:
            convs = batch.column("conv_id").to_pylist()
            parts, lengths, deltas_at = [], [], []
            for head, body, loss in zip(batch.column("head").to_pylist(), batch.column("body").to_pylist(), batch.column("loss").to_pylist()):
                parts += [head, body, np.array([END], dtype="<i4").tobytes()]
                lengths += [len(head) // 4, len(body) // 4, 1]
                deltas_at.append(loss)
            ids = np.frombuffer(b"".join(parts), dtype="<i4")
            ends = np.cumsum(lengths)
            change = np.zeros(len(ids) + 1, dtype=np.int64)
            on = np.flatnonzero(deltas_at)
            np.add.at(change, ends[3 * on], 1)  # the text begins where the head ends
            np.add.at(change, ends[3 * on + 1], -1)
            mask = np.cumsum(change[:-1]).astype(np.uint8)
            bounds = np.concatenate([[0], ends[2::3]])
            starts, out_ids, out_mask = [], [], []
            for i, c in enumerate(convs):
                if c != conv:
                    conv, at = c, 0
                starts.append(at)
                out_ids.append(ids[bounds[i] : bounds[i + 1]].tobytes())
                out_mask.append(mask[bounds[i] : bounds[i + 1]].tobytes())
                at += int(bounds[i + 1] - bounds[i])
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(starts, pa.int64()), pa.array(out_ids, pa.binary()), pa.array(out_mask, pa.binary())], ["conv_id", "start", "ids", "mask"])

    encoded = encode_turns(turns, path).repartition("conv_id").sortWithinPartitions("conv_id", "turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    return encoded.select("conv_id", "head", "body", "loss").mapInArrow(run, "conv_id long, start long, ids binary, mask binary")


def read_back(formatted: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """One row a conversation, from ids and mask alone, brought into the order of `start`."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        enc = encoding(path)
        text_of = lambda ids: enc.decode_bytes(ids.tolist()).decode("utf-8") if len(ids) else ""
        conv, state, done = object(), None, []
        finish = lambda: done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]))
        for batch in batches:
            for c, raw, raw_mask in zip(batch.column("conv_id").to_pylist(), batch.column("ids").to_pylist(), batch.column("mask").to_pylist()):
                if c != conv:
                    if state:
                        finish()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                ids, mask = np.frombuffer(raw, dtype="<i4"), np.frombuffer(raw_mask, dtype=np.uint8).astype(bool)
                marks = np.flatnonzero(ids >= TURN)
                role, text = text_of(ids[1 : marks[1]]), text_of(ids[marks[1] + 1 : marks[2]])
                loss = unescape(text_of(ids[mask]))
                state[0] += 1
                state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(role) + len(text) + sum(map(len, MARKERS.values()))
                state[5] += len(ids)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in done], schema=schema)
                done.clear()
        if state:
            finish()
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in done], schema=schema)

    in_order = by_bytes(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "start").select("conv_id", "ids", "mask")
    return in_order.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long")


def chat_format(conversations: DataFrame) -> DataFrame:
    """The contract's digest over all conversations and conversation -1, whose texts hold control strings."""
    spark = conversations.sparkSession
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return read_back(keep(assemble(rows.unionByName(extra)))).drop("n_tokens")
