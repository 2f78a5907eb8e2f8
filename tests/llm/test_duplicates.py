"""Near-duplicate documents and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from granary.llm import minhash, substring
from granary.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute_components(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in inverted[s])
        for s in sets[i]:
            inverted[s].append(i)
        for j, k in common.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def family(seed, n):
    """Texts edited further and further from one another, so that links chain."""
    rng = random.Random(seed)
    words = [f"w{seed}x{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(n):
        if rng.random() < 0.5:
            words = list(words)
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


ODD = ["", None, "  \n ", "one two", "One TWO", "one two three four five", "a\x0bb\x1cc d é É", "x" * 100_000, "y " * 30_000]


def corpus():
    texts = [t for s in range(12) for t in family(s, 25)] + ODD + ODD
    random.Random(5).shuffle(texts)
    return list(enumerate(texts))


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"component_id": F.lit(1), "kept": F.lit(True), "key": F.lit("k")})
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    want = brute_components(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, "a b"), (7, "a b"), (8, "A b")], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in minhash.near_duplicates(rows).collect()) == [("7", "7", True), ("7", "7", True), ("8", "7", False), ("None", "None", True), ("None", "None", True)]


def test_min_max_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    errors = []
    for _ in range(50):
        a = rng.integers(0, 2**63, 300, dtype=np.uint64)
        b = np.concatenate([a[:270], rng.integers(0, 2**63, 30, dtype=np.uint64)])
        s = minhash.min_max(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 300, 600]))
        errors.append((s[0] == s[1]).mean() - 270 / 330)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (300, 300)] + [(1000 + i, 1000) for i in range(50)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[200] == 100 and got[1049] == 1000 and 300 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, k=20):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        words = WORD.findall(t or "")
        covered = [False] * len(words)
        for p in range(len(words) - k + 1):
            w = tuple(words[p : p + k])
            if w in seen:
                covered[p : p + k] = [True] * k
            seen.add(w)
        out.append((str(i), len(words), sum(covered), hashlib.sha256(" ".join(w for w, c in zip(words, covered) if not c).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block", [500, 1 << 22])
def test_repeats(spark, monkeypatch, block):
    monkeypatch.setattr(substring, "BLOCK_BYTES", block)
    monkeypatch.setattr(substring, "SHARD_WINDOWS", 400)
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for i in range(80):
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 80))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, " ".join(own[:at] + ([passage] if i % 3 == 0 else passage.split()[: i % 25]) + own[at:]).replace(" ", "\n" if i % 2 else "  ", 3)))
    rows += [(200, "r " * 500), (201, "r " * 30), (202, ""), (203, None), (204, rows[5][1]), (None, passage), (205, "z" * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit(3))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.removed(docs).collect())
    assert got == brute_repeats(rows)


def test_texts_without_repeats(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, f"a  b {passage}", 9), (2, f"{passage}\nend here", 9), (2, f"{passage}\nend here", 9), (3, None, None)]
    out = substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"))
    assert out.columns == ["doc_id", "text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, f"a  b {passage}", 9), (2, "end here", 8), (2, "", 0), (3, None, None)], key=str)
    assert substring.removed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def least_linked(rows, percent):
    sets, least = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and (k := len(sets[a] & sets[b])) and 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k)]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize("percent", [80, 60])
def test_near_duplicates_at_other_similarities(spark, monkeypatch, percent):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng, texts = random.Random(percent), [t for s in range(3) for t in family(s, 20)]
    for i in range(150):  # pairs just above and just under: a copy whose end is another
        words = [f"q{i}x{k}" for k in range(204)]
        common = round(400 * percent / (100 + percent)) + rng.randrange(-3, 5)
        texts += [" ".join(words), " ".join(words[: common + 4] + [f"o{i}x{k}" for k in range(200 - common)])]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()}
    assert got == least_linked(rows, percent)


def test_plan_holds_at_every_similarity():
    for percent in range(11, 101):
        bands, rows, agree = minhash.plan(percent)
        assert bands * rows <= 2 * minhash.PERMUTATIONS and (1 - (percent / 100) ** rows) ** bands <= 1e-6
        assert percent == 100 or agree / 126 < percent / 100
    assert minhash.plan(85)[:2] == (25, 5)
    for percent in (0, 10, 101):
        with pytest.raises(ValueError):
            minhash.plan(percent)


def complements(n):
    """A word of n letters over a and b in which every block is followed by its opposite, and the opposite word."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_structured_long_words_differ(spark, n):
    a, b = complements(n)
    rest = " ".join(f"w{i}" for i in range(24))
    rows = [(1, f"{a} x y"), (2, f"{b} x y"), (3, f"{a} {rest}"), (4, f"{b} {rest}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()} == brute_components(rows)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.removed(docs).collect()) == brute_repeats(rows)


def test_further_hubs_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "MEETINGS", 1)
    rng = random.Random(8)
    base = [f"b{k}" for k in range(150)]
    texts = []
    for _ in range(150):  # about as many pairs above the similarity as below
        words = list(base)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts + [t for s in range(4) for t in family(s, 25)]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()}
    assert got == brute_components(rows)


def test_one_of_each_counts_rows(spark):
    text = " ".join(f"t{i}" for i in range(40))
    other = " ".join(f"o{i}" for i in range(40))
    rows = [(5, text, 1), (5, text, 2), (None, text, 3), (7, text + " more", 4), (7, other, 5), (None, None, 6), (None, "", 7), (3, other, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int").withColumn("_found", F.lit(1))
    out = minhash.one_of_each(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert sorted(r._row for r in kept if r._row > 2) == [6, 7, 8] and sum(r._row in (1, 2) for r in kept) == 1
    assert minhash.one_of_each(docs.limit(0)).count() == 0


def test_repeats_under_one_id_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 300)
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(7 if i % 3 else i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(20)) + " " + passage) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("_hash", "_doc", "_block", "_salt")})
    out = substring.removed(docs).toPandas()
    assert (out.n_removed == 0).sum() == 1 and (out.n_removed >= 30).sum() == 59 and out.n_removed[out.doc_id == 0].tolist() == [0]
    assert sorted(substring.without_repeats(docs).columns) == sorted(docs.columns)
