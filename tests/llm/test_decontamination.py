import time
import tracemalloc

import numpy as np
import pytest

from shredline.llm import decontamination
from shredline.llm.decontamination import PlainWords, tile

ITEM = " ".join(f"w{i}" for i in range(40))
HALVES = " ".join([*ITEM.split()[20:], "between", *ITEM.split()[:20]])


def brute_tiles(p, t, least):
    """Repeatedly the longest common run of unmarked words."""
    free_p, free_t, out = [True] * len(p), [True] * len(t), []
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and free_p[i + n] and free_t[j + n] and p[i + n] == t[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sorted(out)
        for k in range(n):
            free_p[i + k] = free_t[j + k] = False
        out.append(n)


@pytest.mark.parametrize("seed", range(12))
def test_tiles_are_greedy(seed):
    rng = np.random.default_rng(seed)
    p = rng.integers(0, 40, 60).astype(np.uint64)
    t = np.concatenate([p[30:55], rng.integers(100, 200, 5).astype(np.uint64), p[:25], rng.integers(0, 40, 30).astype(np.uint64)])
    got = tile(p, t, np.ones(len(t), bool), 3)
    assert sum(n for *_, n in got) == sum(brute_tiles(p.tolist(), t.tolist(), 3))
    assert all((p[a : a + n] == t[b : b + n]).all() for a, b, n in got)


def hits(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(tuple(r)[:2] for r in decontamination.contaminated_pairs(spark, docs, items, **options).collect())


def test_cases(spark):
    docs = [
        (1, f"Before. {ITEM.upper()}! After"), (2, f"x {HALVES} y"), (3, " ".join(ITEM.split()[:23])), (4, " ".join(ITEM.split()[:25])),
        (5, None), (6, ""), (7, " ".join(reversed(ITEM.split()))), (8, "a short one"), (8, "a short one"), (9, "other words " * 5000 + ITEM),
    ]
    items = [(1, ITEM), (2, None), (3, ""), (4, "... !"), (5, "short one"), (1, ITEM)]
    wanted = [(d, 1) for d in (1, 2, 4, 9) for _ in range(2)] + [(8, 5)] * 2
    assert hits(spark, docs, items) == sorted(wanted)
    assert hits(spark, docs, []) == [] and hits(spark, [], items) == []


def test_blocks_give_the_same(spark, sf, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontamination.contaminated_pairs(spark, docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 2000)
    assert sorted(map(tuple, decontamination.contaminated_pairs(spark, docs, items).collect())) == whole
    kept = decontamination.without_contaminated(spark, docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {r[0] for r in whole}


def test_documents_against_brute_force(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    plain, wanted = PlainWords(), set()
    for d in docs:
        t = plain.text(d.text.encode())
        for item in items:
            p = plain.text(item.text.encode())
            if len(np.intersect1d(p, t)) >= 0.6 * len(np.unique(p)):
                if sum(brute_tiles(p.tolist(), t.tolist(), 5)) >= 0.6 * len(p):
                    wanted.add((d.doc_id, item.item_id))
    assert {tuple(r)[:2] for r in decontamination.op2_benchmark_decontamination(spark, sf).collect()} == wanted


def test_odd_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two"), (None, "very long text very long text")], "item_id long, text string")
    got = sorted((tuple(r)[:2] for r in decontamination.contaminated_pairs(spark, odd_docs, items).collect()), key=str)
    assert got == sorted([(5, 1), (6, 1), (6, 1), (None, 1), (7, None), (8, None)], key=str)
    assert decontamination.without_contaminated(spark, no_docs, items).count() == 0


def plain_tiles(p, t, least):
    """Greedy tiles by definition: the longest common run of unmarked words, of equal ones the first in the item, then in the document."""
    free_p, free_t, out = [True] * len(p), [True] * len(t), []
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and free_p[i + n] and free_t[j + n] and p[i + n] == t[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sorted(out)
        for k in range(n):
            free_p[i + k] = free_t[j + k] = False
        out.append((i, j, n))


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("words", [2, 4, 30])
def test_tiles_by_definition(seed, words):
    rng = np.random.default_rng(seed)
    p, t = rng.integers(0, words, rng.integers(0, 40)).astype(np.uint64), rng.integers(0, words, rng.integers(0, 60)).astype(np.uint64)
    usable = rng.random(len(t)) < 0.9
    t = np.where(usable, t, np.uint64(99))  # what is not usable matches nothing
    assert sorted(tile(p, t, usable, 2)) == plain_tiles(p.tolist(), t.tolist(), 2)


def test_repeats_are_cheap():
    start = time.perf_counter()
    spam = PlainWords().text(b"spam " * 2000)
    assert tile(spam, PlainWords().text(b"spam " * 20_000), np.ones(20_000, bool), 5) == [(0, 0, 2000)]
    text = PlainWords().text((" ".join(f"w{k % 50}" for k in range(3000)) + " x ") .encode() * 7)
    item = PlainWords().text(" ".join(f"w{k % 7}" for k in range(1000)).encode())
    tile(item, text, np.ones(len(text), bool), 5)
    assert time.perf_counter() - start < 2


def test_a_common_seed_of_many_items_and_places():
    common = "one two three four five"
    items = [(k, PlainWords().text(f"{common} {' '.join(f'i{k}x{j}' for j in range(30))}".encode())) for k in range(2000)]
    match = decontamination.Matcher([*items, (9999, PlainWords().text(f"{common} six seven".encode()))], 5, 0.6)
    tracemalloc.start()
    found = match(PlainWords().text(f"{common} ".encode() * 2000 + b"six seven"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[0] for f in found] == [9999] and peak < 40e6


def test_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)
    items = spark.createDataFrame([(1, "a b c d e f")] * 30 + [(2, "x " * 200), (3, None)], "item_id long, text string")
    cut, blocks = decontamination.blocks_of(spark, items)
    sizes = {}
    for r in cut.collect():
        sizes.setdefault(r.block, []).append(len(r.text))
    assert sorted(sizes) == blocks and all(sum(s) <= 100 or len(s) == 1 for s in sizes.values())
    assert cut.count() == 32
