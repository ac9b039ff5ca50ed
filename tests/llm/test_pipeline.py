"""The corpus pipeline against its stages in plain steps."""

import pytest

import corpus_pipeline

from .fixtures import awkward, frame, junk, prose


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = [r for r in awkward()] + [(1000 + i, junk(i, 90), "en", "z") for i in range(40)]
    rows += [(2000 + i, prose(2000 + i, 120), "en", "z") for i in range(120)]
    rows += [(3000, f"{prose(2000, 120)}", "en", "y"), (3001, f"{prose(5, 90)} password=fedcba9876543210ab", "en", "y")]
    frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    labels = [(1000 + i, 0, 0) for i in range(30)] + [(2000 + i, 1, int(i % 9 == 0)) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, columns = docs, docs.columns
    seen = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept = function(spark, kept, sf_dir)
        assert kept.columns == columns
        seen[name] = {r["doc_id"]: r["text"] for r in kept.collect()}
    selected, ruled, single, masked = seen.values()
    assert not any(1000 <= i < 1040 for i in ruled if i) and len([i for i in ruled if i and 2000 <= i < 2120]) >= 118
    assert set(ruled) <= set(selected) and set(masked) == set(single)
    assert 2000 in single and 3000 not in single  # an exact copy
    assert 6 in single and 7 not in single and 8 not in single
    assert masked[3001].endswith("password=[SECRET]")


def test_run_packs_every_kept_document(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in rows)
    assert 2000 in total and 1001 not in total


def test_every_stage_takes_an_empty_table(spark, sf_dir):
    nothing = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, nothing, sf_dir).count() == 0
