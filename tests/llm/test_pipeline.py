"""The pipeline's stages on a small corpus, each against what it should do to its own input."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import bpe, mixing
from granary.llm.shared import keep

from .test_duplicates import brute_components, brute_repeats, family


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    rows, labels = [], []
    passage = " ".join(f"shared{i}" for i in range(70))
    for i in range(400):
        words = [f"n{rng.randrange(3000)}" for _ in range(rng.randrange(30, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["rotten", "vermin", "scoundrel"]))
        if i % 11 == 1:
            words += passage.split()
        rows.append((i, " ".join(words), "en", f"s{i % 7}", 0))
        labels.append((i, 1, int(toxic)))
    for s in range(5):
        rows += [(1000 + 20 * s + k, t, None, "fam", None) for k, t in enumerate(family(s, 20))]
    rows += [(2000, None, None, None, None), (2001, "", "en", "s1", 0)]
    out = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = keep(stage(spark, docs, folder))
        rows = docs.collect()
        seen.append(name)
        if name != "bpe":
            assert docs.columns == columns
        if name == "toxicity":
            kept = {r.doc_id for r in rows}
            assert not kept & {i for i in range(0, 400, 5)} and kept >= {i for i in range(400) if i % 5} and {2000, 2001} <= kept
        if name == "near_dedup":
            want = brute_components([(i, r.text) for i, r in before.items()], 80)
            assert {r.doc_id for r in rows} == {i for i, (_, c) in want.items() if i == c}
        if name == "substring_dedup":
            want = {i: (n, gone) for i, n, gone, _ in brute_repeats([(i, r.text) for i, r in before.items()])}
            assert sum(gone for _, gone in want.values()) > 0
            assert all(len((r.text or "").split()) == want[str(r.doc_id)][0] - want[str(r.doc_id)][1] for r in rows)
        if name == "mixing":
            taken = {r.doc_id: r.times for r in mixing.mix(spark.createDataFrame(list(before.values()), docs.schema)).collect()}
            assert len(rows) == sum(taken.values()) and all(sum(r.doc_id == i for r in rows) == n for i, n in list(taken.items())[::20])
        if name == "bpe":
            assert len(rows) == sum(taken.values())
    assert seen == ["toxicity", "near_dedup", "substring_dedup", "mixing", "bpe"]
    assert corpus_pipeline.run(spark, folder).count() == len(rows)


def test_extra_columns_and_nothing(spark, folder, tmp_path):
    names = ("size", "target", "source_size", "source_rows", "times", "_hash", "_doc", "_block", "component_id", "kept", "score", "key", "label")
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({c: F.lit(-3) for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns, docs = docs.columns, keep(stage(spark, docs, folder))
        assert docs.columns == columns and docs.where("size = -3 and _hash = -3 and times = -3 and kept = -3").count() == docs.count() > 0
    empty = tmp_path / "none"
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
