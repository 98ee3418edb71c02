import hashlib

import pytest

from shredline.llm import exact_dedup
from tests.compare import assert_same


def test_matches_sql(spark, sf):
    assert_same(exact_dedup.op9_exact_dedup(spark, sf), exact_dedup.ORACLE, sf)


@pytest.mark.parametrize("weak_bits", [64, 2])  # with 2 bits nearly all weak hashes collide
def test_odd_documents(spark, odd_docs, weak_bits):
    got = sorted(map(tuple, exact_dedup.exact_duplicates(spark, odd_docs, weak_bits).collect()), key=str)
    rows = [(r.doc_id, (r.text or "").translate({c: c + 32 for c in range(65, 91)})) for r in odd_docs.collect()]
    wanted = []
    for i, t in rows:
        same = [j for j, u in rows if u == t]
        keep = max((j for j in same if j is not None), default=None)
        wanted.append((i, keep, len(same), i is not None and i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(wanted, key=str)


def test_collisions_are_found(spark, odd_docs):
    recipes = exact_dedup.chunk_recipes(odd_docs, 2)
    assert exact_dedup.unverified_ids(recipes).count() > 0
    assert exact_dedup.unverified_ids(exact_dedup.chunk_recipes(odd_docs)).count() == 0


def test_chunks_are_the_text(spark):
    text = "".join(f"Sentence {i} of some length. " for i in range(3000)) + "x" * 20_000 + "\n" + "y\n" * 10
    docs = spark.createDataFrame([(1, text), (2, "Inserted. " + text)], "doc_id long, text string")
    a, b = (set(r.weak) for r in exact_dedup.chunk_recipes(docs).orderBy("doc_id").collect())
    assert len(a & b) > 0.8 * len(a)  # cuts depend on content, so most chunks survive an insertion


def test_no_documents(spark, no_docs):
    assert exact_dedup.exact_duplicates(spark, no_docs).count() == 0
