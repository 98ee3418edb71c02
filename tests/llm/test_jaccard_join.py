import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from shredline.llm import graph, jaccard_join
from shredline.llm.common import Workspace
from shredline.llm.graph import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    """Sorted (doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(group, default=None) if sets[k] else i))
    return sorted(out, key=str)


def joined(spark, docs):
    return sorted(map(tuple, jaccard_join.jaccard_components(spark, docs).collect()), key=str)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert joined(spark, docs) == brute_force([(r.doc_id, r.text) for r in docs.collect()])


def family(seed):
    """Chains and clouds of near copies around the threshold, and passages that unlike texts share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    passage, out = [word() for _ in range(30)], []
    for _ in range(6):
        text = [word() for _ in range(rng.choice([3, 12, 60, 200]))]
        for _ in range(rng.randint(1, 12)):
            text = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 40))):
                text[rng.randrange(len(text))] = word()
            out.append(" ".join(text))
    out += [" ".join([word() for _ in range(rng.randint(0, 60))] + passage) for _ in range(25)]
    return out + [None, "", "a b", "A  B\n"]


@pytest.mark.parametrize("seed, small, hot", [(1, 64, 10**6), (2, 2, 10**6), (3, 2, 3)])
def test_recursion_and_split_regions(spark, monkeypatch, seed, small, hot):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "BLOCK_CELLS", 3000 if small == 2 else 4_000_000)
    rows = list(enumerate(family(seed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(spark, docs) == brute_force(rows)


def test_a_region_of_many_sets_at_default_settings(spark):
    """A passage that is most of 300 short texts, some of them near copies: more than SMALL sets meet in its shingles' regions."""
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for k in range(300):
        own = [f"o{k}x{j}" for j in range(rng.choice([2, 9, 12, 16, 30]))]
        texts.append(" ".join(passage + own))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = jaccard_join.Join(spark, docs)
    join.points()
    assert join.candidates.where("region IS NOT NULL").groupBy("region").count().agg({"count": "max"}).first()[0] > jaccard_join.SMALL
    assert joined(spark, docs) == brute_force(rows)


def test_large_regions_do_not_hold_shingles(spark):
    """300 texts of a passage and nine own words meet in regions of the passage, and class counts tell that none are linked."""
    rows = [(k, " ".join([f"p{j}" for j in range(60)] + [f"o{k}x{j}" for j in range(9)])) for k in range(300)]
    join = jaccard_join.Join(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    join.points()
    assert join.candidates.where("region IS NOT NULL").groupBy("region").count().agg({"count": "max"}).first()[0] == 300
    assert join.links().isEmpty()
    assert join.sets.count() < 30


def near_copies(n):
    """A text of 140 words, each word of which a copy has changed with a chance of 1 to 5 %: links are at 4 or 5 changes in both."""
    rng = random.Random(n)
    base = [f"b{j}" for j in range(140)]
    return [(k, " ".join(f"c{k}x{j}" if rng.random() < chance else w for j, w in enumerate(base))) for k in range(n) for chance in [rng.uniform(0.01, 0.05)]]


def pairs_of_pivots(join):
    tables = [join.spark.read.parquet(str(p)) for p in Path(join.space.root.removeprefix("file:")).glob("near-*")]
    return sum(t.where("b IS NOT NULL").count() for t in tables)


def test_pairs_of_near_copies_do_not_grow_with_the_square(spark, monkeypatch):
    made, joins, plain = [], [], jaccard_join.Join
    monkeypatch.setattr(jaccard_join, "Join", lambda *args: joins.append(plain(*args)) or joins[-1])
    for n in (200, 800):
        rows = near_copies(n)
        assert joined(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute_force(rows)
        made.append(pairs_of_pivots(joins[-1]))
    assert 0 < made[1] < 6 * made[0]


@pytest.mark.parametrize("cells, seed", [(4_000_000, 1), (3000, 2)])
def test_pivots_meet_all_sets_in_the_end(spark, monkeypatch, cells, seed):
    """One pair of a pivot and one block at a time, in regions with links and without."""
    for name, value in (("SMALL", 2), ("FEW", 1), ("MORE", 2), ("BLOCK_CELLS", cells)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = list(enumerate(family(seed))) + [(1000 + k, t) for k, t in near_copies(60)]
    assert joined(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute_force(rows)


def test_a_pivot_with_more_pairs_says_so():
    n, k = 40, jaccard_join.CLASSES
    classes = np.ones((n, k), np.uint8)
    classes[np.arange(1, n), np.arange(1, n)] += np.arange(1, n, dtype=np.uint8) % 5
    size = classes.sum(1, dtype=np.int64)
    sets = {"region": [3] * n, "fp": list(range(n)), "root": list(range(n)), "n": size, "at": [0] * n, "distance": [None] * n, "classes": [c.tobytes() for c in classes]}
    for most in (7, n - 1):
        rows = pa.table({c: pa.array([*v, v[0]], pa.float64() if c == "distance" else None) for c, v in sets.items()} | {"pivot": [False] * n + [True], "most": [most] * (n + 1)})
        got = jaccard_join.near_pivots(rows).to_pylist()
        assert [r for r in got if r["b"] is None] == ([{"a": 0, "b": None, "region": 3}] if most == 7 else [])
        near = [r["b"] for r in got if r["b"] is not None]
        assert near == ([5, 10, 15, 20, 25, 30, 35] if most == 7 else list(range(1, n)))


def test_passages_come_last_where_cells_are_full():
    """A passage in 130 texts, in cells that hold 650 shingles by chance."""
    counts = np.random.default_rng(4).poisson(650, 20_000)
    counts[:50] += 130
    levels = jaccard_join.order_levels(counts)
    assert (levels[:50, None] > np.quantile(levels[50:], 0.2)).all()  # a window has the first fifth of a set


@pytest.mark.parametrize("few", [0, 10**6])
def test_hot_keys_meet_in_no_task(spark, monkeypatch, few):
    monkeypatch.setattr(jaccard_join, "BROADCAST_KEYS", few)
    monkeypatch.setattr(graph, "BROADCAST_LINKS", few)
    rows = [(k, "one text that very many rows have in common") for k in range(400)] + [(1000 + k, " ".join(f"w{k // 3}x{j}" for j in range(40)) + " e" * (k % 3)) for k in range(60)] + [(None, "null id"), (5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(spark, docs) == brute_force(rows)


def test_colliding_points_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "point", lambda s, seed=0: len(s) if seed == 0 else int(s[0] >> np.uint64(1)) if len(s) else 0)
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    with pytest.raises(jaccard_join.PointCollision):
        jaccard_join.jaccard_components(spark, docs)


def test_parts_do_not_grow_with_the_documents(monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", 100)
    counts = np.full(1000, 5000)
    counts[7] = 12_000
    parts = jaccard_join.parts_of(counts)
    assert parts[7] == 20 and (np.delete(parts, 7) == 1).all()


def test_odd_documents(spark, odd_docs, no_docs):
    assert joined(spark, odd_docs) == brute_force([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert joined(spark, no_docs) == []


def test_windows_hold_every_link():
    rng = np.random.default_rng(5)
    levels, splits = np.zeros(1 << jaccard_join.CELL_BITS, np.int16), np.ones(1 << jaccard_join.CELL_BITS, np.int64)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 8))).astype(np.uint64)]))
        common = len(np.intersect1d(x, y))
        if len(y) and 5 * common >= 4 * (len(x) + len(y) - common):
            a, b = (jaccard_join.region_rows(s, 7, levels, splits)[:, 0] for s in (x, y))
            assert len(np.intersect1d(a, b))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 160)] + [(200, k) for k in range(201, 260)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark), "t").collect()}
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
