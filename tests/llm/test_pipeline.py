import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shredline.llm import common, quality

from .test_decontamination import PlainWords, brute_tiles
from .test_jaccard_join import brute_force
from .test_packing import check


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    labels, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    good = {r.doc_id for r in quality.quality_scores(spark, docs, labels).where("predicted = 1").collect()}
    left = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    last = {}
    for i, t in left.items():
        last.setdefault(t.translate({c: c + 32 for c in range(65, 91)}), []).append(i)
    left = {i: left[i] for same in last.values() for i in [max(same)]}
    left = {i: left[i] for i, _, c in brute_force(sorted(left.items())) if i == c}
    plain = PlainWords()
    tests = [plain.text(r.text.encode()) for r in items.collect()]

    def dirty(text):
        t = plain.text(text.encode())
        return any(len(set(p.tolist()) & set(t.tolist())) >= 0.6 * len(set(p.tolist())) and sum(brute_tiles(p.tolist(), t.tolist(), 5)) >= 0.6 * len(p) for p in tests)

    left = {i: t for i, t in left.items() if not dirty(t)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
    assert {r.doc_id: r.text for r in docs.collect()} == left
    check(corpus_pipeline.run(spark, sf).collect(), list(left.items()), 2048)


def test_odd_documents(spark, sf, odd_docs, no_docs):
    """After quality, whose judgement of odd texts is not fixed, each stage keeps just what it should."""
    for start in (odd_docs, no_docs):
        kept = corpus_pipeline.keep_quality(spark, start, sf)
        assert kept.columns == start.columns and set(map(str, kept.collect())) <= set(map(str, start.collect()))
    text = {r.doc_id: r.text for r in odd_docs.collect()}
    docs = corpus_pipeline.drop_exact_duplicates(spark, odd_docs, sf)
    # 1 to 3 and the null row are empty; 5, 6 and 6 are equal, as is the row without an id
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == sorted([(k, text[k]) for k in (3, 4, 6, 7, 8, 9, 10)], key=str)
    docs = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    assert sorted(r.doc_id for r in docs.collect()) == [3, 4, 6, 7, 8, 9, 10]  # 8 has 3 of 4 shingles of 7
    docs = corpus_pipeline.drop_benchmark_passages(spark, docs, sf)
    assert sorted(r.doc_id for r in docs.collect()) == [3, 4, 6, 7, 8, 9, 10] and docs.columns == odd_docs.columns
    packed = corpus_pipeline.pack_sequences(spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == {3, 4, 6, 7, 8, 9, 10}
    empty = no_docs
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0


@pytest.mark.parametrize("few", [500_000, 0])  # broadcast, and by filter and join
def test_repeated_ids_lose_no_text(spark, sf, monkeypatch, few):
    monkeypatch.setattr(common, "BROADCAST_KEYS", few)
    rows = [(1, "alpha"), (1, "same"), (3, "same"), (3, "same"), (None, "only here"), (None, "only here"), (4, None), (4, "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, _h int")
    left = corpus_pipeline.drop_exact_duplicates(spark, docs, sf)
    assert left.columns == docs.columns
    got = [(r.doc_id, r.text or "") for r in left.collect()]
    assert sorted(got, key=str) == sorted([(1, "alpha"), (3, "same"), (None, "only here"), (4, "")], key=str)
    words = " ".join(f"w{k}" for k in range(60))
    near = spark.createDataFrame([(0, words), (1, words + " x"), (1, "quite another text"), (2, words + " y"), (None, words)], "doc_id long, text string")
    got = corpus_pipeline.drop_near_duplicates(spark, near, sf).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(0, words), (1, words + " x"), (1, "quite another text"), (None, words)], key=str)


def test_registered():
    names = list(entry.queries())
    assert "pipeline" in names
    assert [n for k in range(1, 11) if len([n for n in names if n.startswith(f"op{k}_")]) != 1 for n in [k]] == []
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
