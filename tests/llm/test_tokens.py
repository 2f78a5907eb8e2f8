"""Token output, chat, mixing and BPE: round trips and the libraries themselves."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from granary.llm import bpe, chat, mixing, wavelet

LETTERS = ["a", "B", " ", "  ", "\n", "\t", "'s", "'LL", "9", "²", "½", "é", "ß", "İ", "_", "-", "!", "\x1c", "\x85", "\xa0", "中", "🙂", "<|endoftext|>", "<|end", "的", "ǅ", "x" * 50, "​", "\x00", "tion", "the"]


def strings(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)] + ["", "a" * 5000, " " * 3000, "ab " * 20_000]


def test_bpe_is_the_library(spark):
    texts = strings(300)
    library = Tokenizer.from_file(bpe.VOCABULARY)
    want = library.encode_batch(texts, add_special_tokens=False)
    docs = spark.createDataFrame(list(enumerate(texts)) + [(-1, None), (0, texts[0]), (None, "x")], "doc_id long, text string").withColumn("ids", F.lit(1))
    rows = bpe.bpe_round_trip(docs).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + 3 and got[-1].n_tokens == 0
    for i, w in enumerate(want):
        assert got[i].n_tokens == len(w.ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, w.ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(w.ids, skip_special_tokens=False).encode()).hexdigest()
    encoded = bpe.encode(docs.where("doc_id >= 0"))
    assert {r.doc_id: r.text for r in bpe.decode(encoded).collect()} == dict(enumerate(texts))
    assert bpe.bpe_round_trip(docs.limit(0)).count() == 0


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=8))
@settings(max_examples=60, deadline=None)
def test_bpe_of_any_text(texts):
    library = Tokenizer.from_file(bpe.VOCABULARY)
    got = bpe.load(bpe.VOCABULARY).encode_batch(texts)
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_decode_of_broken_bytes():
    b = bpe.load(bpe.VOCABULARY)
    library = Tokenizer.from_file(bpe.VOCABULARY)
    ids = [i for i in b.encode_batch(["é🙂"])[0]][:-1]
    assert b.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_shards_hold_the_library_s_ids(spark):
    texts = strings(200, 4)
    docs = spark.createDataFrame([(5 * i, t) for i, t in enumerate(texts)] + [(-3, None)], "doc_id long, text string").withColumn("start", F.lit(1))
    shards = wavelet.write_shards(docs, shard_tokens=500)
    got = {r.doc_id: r for r in wavelet.read_shards(shards).collect()}
    library, start = Tokenizer.from_file(wavelet.VOCABULARY), 1
    assert (got[-3].start, got[-3].n_tokens) == (0, 1)
    counts = 1
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        ids, r = [*e.ids, 2], got[5 * i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
        counts += ids.count(2)
    assert wavelet.count_token(shards, 2).agg(F.sum("n")).first()[0] == counts == wavelet.occurrences(shards, 2).count()
    assert wavelet.token_output(docs.limit(0)).count() == 0


def test_repeated_ids_keep_their_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "d")], "doc_id long, text string")
    rows = sorted((r.start, r.n_tokens) for r in wavelet.token_output(docs).collect())
    assert len(rows) == 4 and rows[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:]))


@given(st.lists(st.integers(0, 40), max_size=1500), st.integers(0, 40))
@settings(max_examples=30, deadline=None)
def test_wavelet_matrix(tokens, probe):
    tokens = np.array(tokens, dtype=np.uint16)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(tokens, np.array([1]), np.array([len(tokens)])).to_bytes())
    assert (m.tokens() == tokens).all()
    at = np.flatnonzero(tokens == probe)
    assert [m.select(probe, k) for k in range(min(len(at), 20))] == at[:20].tolist()
    for i in range(0, len(tokens), 97):
        assert m.access(i) == tokens[i] and m.rank(probe, i) == (tokens[:i] == probe).sum()
    with pytest.raises(IndexError):
        m.select(probe, len(at))


@given(st.lists(st.sampled_from(["<", "|", "\\", "s", ">", "</s>", "[INST]", "[", "/INST]", "<|turn|>", "<|", "turn|>", "x", "\n"]), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROLS)


def test_chat_reads_back(spark):
    rng = random.Random(2)
    bits = ["</s>", "[INST] ", "<|turn|>", "hej ", "é🙂", "\n", "\\", "<\\|text|>", "word " * 10]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|end|>"]), rng.choice([None, "", "".join(rng.choice(bits) for _ in range(8))])) for c in range(6) for t in range(15)]
    rows += [(9, i, "assistant", f"long {i} " * 50) for i in range(600)] + [(None, None, None, None), (7, 1, "user", "x" * 120_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"ids": F.lit(1), "mask": F.lit(2)})
    got = {r.conv_id: r for r in chat.chat_format(df).collect()}
    assert set(got) == {*range(6), 7, 9, None, -1} and got[-1].loss_chars == len("</s>[INST] ok [/INST]")
    for c in got:
        own = sorted([r for r in rows if r[0] == c], key=lambda r: (r[1] is not None, r[1])) if c != -1 else [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.chat_format(df.limit(0)).count() == 1


def test_no_text_makes_a_marker(spark):
    df = spark.createDataFrame([(1, 0, "user", "<|turn|><|end|>")], "conv_id long, turn long, role string, text string")
    row = chat.assemble(df).first()
    ids = np.frombuffer(row.ids, dtype="<i4")
    assert (ids >= chat.TURN).sum() == 3 and len(row.mask) == len(ids) and not any(row.mask)


def brute_fill(sizes, weights, share, most):
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = sum(w for s, w in weights.items() if s not in capped)
        level = (total - sum(most * sizes[s] for s in capped)) / free if free else 0
        above = {s for s in sizes if s not in capped and weights[s] * level > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else weights[s] * level for s in sizes}
        capped |= above


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 200), rng.choice(["a", "b", "c", "hot", "hot", "hot", None, "å", "Z"])) for i in range(3000)] + [(5000, None, "tiny"), (5001, "", "tiny"), (5001, "", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size_": F.lit(1), "target_": F.lit(2)})
    out = mixing.mix(docs).toPandas()
    out["source"] = out.source.fillna(chr(0x10FFFF))  # null comes last
    assert len(out) == len(rows) and (out.times <= 2).all()
    sizes = {s: int(g["size"].sum()) for s, g in out.groupby("source")}
    order = sorted(sizes)
    want = brute_fill(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    for s, g in out.groupby("source"):
        assert g.target.iloc[0] == pytest.approx(want[s]) and g.source_size.iloc[0] == sizes[s]
        assert abs((g["size"] * g.times).sum() - want[s]) <= 200 + 0.02 * want[s]
    again = mixing.mix(docs.repartition(7)).toPandas()
    assert sorted(zip(out.doc_id, out.times)) == sorted(zip(again.doc_id, again.times))
    assert mixing.repeated(mixing.mix(docs), docs.columns).count() == out.times.sum()
    assert mixing.mixing(docs.limit(0)).count() == 0


def test_every_low_code_point_encodes_as_the_library(spark):
    library, ours = Tokenizer.from_file(wavelet.VOCABULARY), wavelet.load(wavelet.VOCABULARY)
    letters = [chr(c) for c in range(0x250)]
    rng = random.Random(6)
    texts = [p.format(c) for c in letters for p in ("{0}", "a{0}b", "{0}®", "{0}&", "¤{0}", "1{0}2", "'{0}s", " {0} ", "{0}{0}")]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(20_000)]
    for at in range(0, len(texts), 5000):
        want = library.encode_batch(texts[at : at + 5000], add_special_tokens=False)
        assert all(list(g) == w.ids for g, w in zip(ours.encode_batch(texts[at : at + 5000]), want))


def test_shards_inflate_only_what_they_touch():
    tokens = np.random.default_rng(4).integers(0, 49_408, 300_000).astype(np.uint16)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(tokens, np.array([1]), np.array([len(tokens)])).to_bytes())
    assert m.access(123_456) == tokens[123_456] and m._chunk.cache_info().currsize <= wavelet.PLANES * 2
    probe = int(tokens[7])
    at = np.flatnonzero(tokens == probe)
    assert m.places(probe) == at.tolist() and m.rank(probe, 150_000) == (at < 150_000).sum()


def test_long_chat_texts_are_encoded_as_one():
    enc = chat.encoding(chat.VOCABULARY)
    for text in ("hello " * 20_000, "a" + " " * 30_000 + "b", "x" * 120_000, "\n" * 5000, "a" + "\t" * 1500 + "\nb", " " * 999 + "x"):
        assert chat.encode_text(enc, text) == enc.encode_ordinary(text)
    far = "a" + " " * 400_000 + "b"
    assert enc.decode(chat.encode_text(enc, far)) == far


def test_mixing_leaves_the_input_s_columns(spark):
    names = ("size", "source_size", "target", "source_rows", "times", "_hash", "_stratum", "_source", "_rows", "_copy")
    rows = [(i, "w " * (i % 50), f"s{i % 3}") for i in range(300)] + [(None, "n " * 9, "s0"), (None, "n " * 8, None), (0, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(-7) for c in names})
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and all(r[c] == -7 for r in out.collect() for c in names)
    plain = mixing.mix(docs.select("doc_id", "text", "source"))
    assert out.count() == plain.agg(F.sum("times")).first()[0]
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_bpe_of_long_pieces():
    library, ours = Tokenizer.from_file(bpe.VOCABULARY), bpe.load(bpe.VOCABULARY)
    rng = random.Random(2)
    texts = ["x" * 40_000, "ab" * 9000, "aaaab" * 2000, "-" * 10_001, "".join(rng.choice("etaoinsh") for _ in range(20_000)), "!?" * 3000 + "é" * 3000, " " * 30_000]
    assert ours.tree.ordered and ours.encode_batch(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
