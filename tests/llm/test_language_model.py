import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shredline.llm import language_model
from shredline.llm.elias_fano import EliasFano, pack, unpack


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 5), (1000, 10**6), (1000, 300), (20_000, 2**60)])
def test_elias_fano_round_trip(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n).astype(np.uint64))
    sequence = EliasFano(unpack(np.frombuffer(pack(EliasFano.build(values, universe, "x")), np.uint8)), "x")
    asked = np.concatenate([values, rng.integers(0, universe, 500).astype(np.uint64)])
    at, equal = sequence.successor(asked)
    assert (at == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()
    assert not n or (sequence.access(np.arange(n)) == values).all()


def brute_force(rows):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    one, two, three = Counter(), Counter(), Counter()
    for words, h in zip(tokens, held):
        if not h:
            padded = [0, 0, *words]
            one.update(words)
            two.update(zip(padded[1:], words))
            three.update(zip(padded, padded[1:], words))
    c2, t2, c3, t3 = Counter(), Counter(), Counter(), Counter()
    for (v, _), n in two.items():
        c2[v], t2[v] = c2[v] + n, t2[v] + 1
    for (u, v, _), n in three.items():
        c3[u, v], t3[u, v] = c3[u, v] + n, t3[u, v] + 1
    total, size = sum(one.values()), len(one)

    def p(u, v, w):
        x = (one[w] + 1) / (total + size + 1)
        x = (two[v, w] + t2[v] * x) / (c2[v] + t2[v]) if t2[v] else x
        return (three[u, v, w] + t3[u, v] * x) / (c3[u, v] + t3[u, v]) if t3[u, v] else x

    out = []
    for (i, _), words, h in zip(rows, tokens, held):
        padded = [0, 0, *words]
        score = sum(math.log10(p(*x)) for x in zip(padded, padded[1:], words))
        base = sum(math.log10((one[w] + 1) / (total + size + 1)) for w in words)
        out.append((i, h, len(words), sum(one[w] > 0 for w in words), total, base, score))
    return out


def check(spark, docs):
    wanted = sorted(brute_force([(r.doc_id, r.text) for r in docs.collect()]), key=str)
    got = sorted(map(tuple, language_model.language_model_scores(spark, docs).collect()), key=str)
    key = lambda r: (str(r[:5]), round(r[5], 3))
    for a, b in zip(sorted(got, key=key), sorted(wanted, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6)
        assert a[6] == pytest.approx(b[6], abs=1e-3 * a[2])  # 16-bit codes


@pytest.mark.parametrize("shard, batch", [(3_000_000, 1_500_000), (5000, 3000)])
def test_documents(spark, sf, monkeypatch, shard, batch):
    monkeypatch.setattr(language_model, "SHARD_TOKENS", shard)
    monkeypatch.setattr(language_model, "BATCH_TOKENS", batch)
    check(spark, spark.read.parquet(f"{sf}/documents.parquet"))


@pytest.mark.parametrize("bits", [64 << 20, 1000])
def test_a_word_with_half_of_all_grams(spark, monkeypatch, bits):
    """The hot word is cut by the words before it, also where these are hot themselves."""
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 300)
    monkeypatch.setattr(language_model, "BATCH_TOKENS", 500)
    monkeypatch.setattr(language_model, "VOCABULARY_BYTES", bits)
    rng = np.random.default_rng(4)
    word = lambda: "the" if rng.random() < 0.5 else f"w{int(rng.zipf(1.3)) % 300}"
    rows = [(k, " ".join(word() for _ in range(int(rng.integers(0, 120))))) for k in range(150)] + [(900 + k, "the " * 400) for k in range(4)] + [(1000 + k, f"the new{k} the") for k in range(20)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_ranges_deal_every_gram_once():
    ranges = language_model.Ranges(np.array([0, 4, 5, 9, 12]), {4: 10 * language_model.SHARD_TOKENS})
    v, u = (x.ravel() for x in np.meshgrid(np.arange(-1, 12), np.arange(-1, 12), indexing="ij"))
    shard = ranges.of(v, u)
    assert (shard[v < 0] == -1).all() and set(shard[v >= 0]) == set(range(ranges.shards)) and (np.diff(shard) >= 0).all()
    assert len(set(shard[v == 4])) == 4 and all(len(set(shard[v == k])) == 1 for k in (0, 5, 11))
    assert [ranges.range_of(k) for k in range(ranges.shards)] == [0, 1, 1, 1, 1, 2, 3]


def test_odd_documents(spark, odd_docs, no_docs):
    check(spark, odd_docs)
    assert language_model.language_model_scores(spark, no_docs).count() == 0


@pytest.mark.parametrize("keep", [True, False])
def test_files_of_the_model(spark, sf, tmp_path, monkeypatch, keep):
    monkeypatch.setattr(language_model, "Workspace", lambda s: type("Space", (), {"root": f"file://{tmp_path}", "save": staticmethod(lambda df, n: language_model.common_save(s, df, f"{tmp_path}/{n}"))})())
    monkeypatch.setattr(language_model, "common_save", lambda s, df, path: (df.write.parquet(f"file://{path}"), s.read.parquet(f"file://{path}"))[1], raising=False)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert language_model.language_model_scores(spark, docs, keep_model=keep).count() == docs.count()
    assert bool(list(tmp_path.glob("model/trie-*"))) == keep and list(tmp_path.glob("model/words-*"))


def test_no_training_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    assert tuple(language_model.language_model_scores(spark, docs).first()) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_probabilities_sum_to_one():
    """A shard's probabilities after a context over all words, and the unknown one."""
    rng = np.random.default_rng(1)
    size = 12
    words = rng.integers(0, size, 400)
    counts = np.bincount(words, minlength=size)

    class Counts:
        pass

    vocabulary = Counts()
    vocabulary.size, vocabulary.tokens = size, int(counts.sum())
    vocabulary.counts = lambda ids: counts[ids]
    vocabulary.log_base = lambda c: np.log10((c + 1) / (counts.sum() + size + 1))
    u, v, w = words[:-2], words[1:-1], words[2:]
    grams = language_model.merge_grams([(v, u, w, np.ones(len(v), np.int64))], size)[:4]
    trie = language_model.Trie(unpack(np.frombuffer(pack(language_model.build_shard(*grams, 0, size + 1, vocabulary)), np.uint8)))
    for a, b in ((int(u[0]), int(v[0])), (-1, 3), (5, 5)):
        every = np.append(np.arange(size), -1)
        base = vocabulary.log_base(np.append(counts, 0))
        p = trie.log_probability(np.full(size + 1, a), np.full(size + 1, b), every, base)
        assert (10**p).sum() == pytest.approx(1, abs=1e-3)
