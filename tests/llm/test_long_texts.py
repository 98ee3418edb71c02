"""A text of 30 MB through the operators that read whole texts."""

import tracemalloc

import numpy as np
import pytest

import corpus_pipeline
from shredline.llm import quality, toxicity

MEGABYTES = 30


@pytest.fixture(scope="module")
def long_text():
    rng = np.random.default_rng(1)
    words = np.array(["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(30_000)])
    return " ".join(words[rng.integers(0, len(words), MEGABYTES * 1_000_000 // 6)])


def test_memory_of_cells(long_text):
    assert len(long_text) > 0.9 * MEGABYTES * 10**6
    wanted = np.zeros(1 << toxicity.BITS, bool)
    wanted[:: 1 << 6] = True
    tracemalloc.start()
    row, cell = toxicity.text_cells([long_text], wanted)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(cell) and (row == 0).all() and peak < 300e6


def test_through_toxicity_and_the_pipeline(spark, sf, long_text):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(30)
    docs = docs.unionByName(spark.createDataFrame([(10**6, long_text, "en", "web", len(long_text))], docs.schema))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(spark, docs, labels).collect()}
    assert 0 <= scores[10**6] <= 1
    assert 0 <= {r.doc_id: r.score for r in quality.quality_scores(spark, docs, labels).collect()}[10**6] <= 1
    kept = docs
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        kept = corpus_pipeline.Workspace(spark).save(stage(spark, kept, sf), "stage")
    assert 10**6 in {r.doc_id for r in kept.select("doc_id").collect()}
    packed = corpus_pipeline.pack_sequences(spark, kept, sf).where(f"doc_id = {10**6}")
    pieces = packed.agg({"piece": "count", "length": "sum"}).first()
    assert pieces["count(piece)"] == -(-pieces["sum(length)"] // 2048) > 1000
