import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from shredline.llm import packing


def check(got, docs, capacity):
    """Every token of every document once, in order, in sequences without gaps."""
    tokenizer = Tokenizer.from_file(packing.word_tokenizer())
    wanted = []
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            wanted.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(wanted, key=str)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = packing.op7_best_fit_packing(spark, sf).collect()
    total = sum(r.length for r in got)
    assert check(got, docs, 2048) <= 1.02 * -(-total // 2048) + 1


@pytest.mark.parametrize("capacity", [2048, 5])
def test_odd_documents(spark, odd_docs, no_docs, capacity):
    got = packing.pack_documents(spark, odd_docs, packing.word_tokenizer(), capacity).collect()
    check(got, [(r.doc_id, r.text) for r in odd_docs.collect()], capacity)
    assert packing.pack_documents(spark, no_docs, packing.word_tokenizer()).count() == 0


def test_words_are_encoded_as_in_their_text():
    rng = random.Random(3)
    alphabet = list("aAbZé ÉßΣσςİ'’.,!?-_\u0301\u00a0\u2003\u200b\x1c\r\n\t1²¼中文😀<|>") + ["'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "don't", "I'm", "the", " of "]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    tokenizer = Tokenizer.from_file(packing.word_tokenizer())
    for text, blob in zip(texts, packing.WordEncoder(packing.word_tokenizer())(texts)):
        assert np.frombuffer(blob, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_small_caches_give_the_same(monkeypatch):
    texts = [f"word{i} Text{i % 7}." for i in range(50)]
    wanted = list(packing.WordEncoder(packing.word_tokenizer())(texts))
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    monkeypatch.setattr(packing, "CACHE_RUNS", 3)
    small = packing.WordEncoder(packing.word_tokenizer())
    assert [next(iter(small([t]))) for t in texts] == wanted


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 300])
    counts = {n: rng.choice([1, 2, 3, 50, 10_000]) for n in rng.sample(range(1, capacity + 1), min(capacity, 40))}
    patterns = packing.plan(counts, capacity)
    used: dict[int, int] = {}
    for parts, times in patterns:
        assert times > 0 and sum(parts) <= capacity
        for p in parts:
            used[p] = used.get(p, 0) + times
    assert used == counts


def test_exact_complements():
    for counts in ({6: 5, 4: 5}, {5: 4, 3: 4, 2: 4}, {4: 6, 3: 6, 2: 6, 1: 6}, {5: 2, 10: 1}):
        patterns = packing.plan(counts, 10)
        assert all(sum(p) == 10 for p, _ in patterns)
