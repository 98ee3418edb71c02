import zlib

import numpy as np
import pytest

from shredline.llm import quality, toxicity

CASES = {"quality": (quality.quality_scores, 0.3), "toxic": (toxicity.toxicity_scores, 0.5)}


def load(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


@pytest.mark.parametrize("column, accuracy", [("quality", 0.97), ("toxic", 0.93)])
def test_held_out_accuracy(spark, column, accuracy):
    docs, labels = load(spark, "/root/testdata/sf0.01")
    score, threshold = CASES[column]
    got = score(spark, docs, labels).toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= threshold)).all()
    held = got.merge(labels.toPandas(), on="doc_id").query("held_out")
    assert (held.predicted == held[column]).mean() >= accuracy


@pytest.mark.parametrize("column", list(CASES))
def test_held_out_labels_are_not_learned(spark, sf, column):
    docs, labels = load(spark, sf)
    score, _ = CASES[column]
    flipped = labels.withColumn(column, toxicity.F.when(toxicity.crc_mod(toxicity.F.col("doc_id"), 5) == 0, 1 - labels[column]).otherwise(labels[column]))
    a, b = (score(spark, docs, x).orderBy("doc_id").toPandas() for x in (labels, flipped))
    assert np.allclose(a.score, b.score)


@pytest.mark.parametrize("column", list(CASES))
def test_odd_documents(spark, sf, odd_docs, no_docs, no_labels, column):
    score, _ = CASES[column]
    got = score(spark, odd_docs, load(spark, sf)[1].withColumn("score", toxicity.F.lit(1))).collect()
    assert len(got) == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    alike = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(alike) == 1
    assert {r.score for r in score(spark, odd_docs, no_labels).collect()} == {0.5}
    assert score(spark, no_docs, no_labels).count() == 0


def test_good_documents_keep_their_columns(spark, sf):
    docs, labels = load(spark, sf)
    kept = quality.good_documents(spark, docs, labels)
    assert kept.columns == docs.columns
    wanted = {r.doc_id for r in quality.quality_scores(spark, docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == wanted


def test_discriminant_is_the_bayes_rule():
    rng = np.random.default_rng(0)
    d = len(quality.STATISTICS)
    x = {k: rng.normal(k, 1 + k, (4000, d)) for k in (0, 1)}
    model = quality.Discriminant({k: (len(v), v.sum(0), v.T @ v) for k, v in x.items()}, to_pooled=0.0, to_diagonal=0.0)
    test = rng.normal(0.3, 1.2, (50, d))
    z = np.zeros(50)
    for sign, v in ((-1, x[0]), (1, x[1])):
        cov = np.cov(v.T, bias=True)
        e = test - v.mean(0)
        z += sign * (-0.5 * np.einsum("ij,jk,ik->i", e, np.linalg.inv(cov), e) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.scores(test), 1 / (1 + np.exp(-z)), atol=1e-2)


def test_cells_of_a_text():
    row, cell = toxicity.text_cells(["Ab  c", None, "ab C", ""])
    same = [set(cell[row == k]) for k in range(4)]
    assert same[0] == same[2] and len(same[0]) == 4 + 3 + 2 + 1  # " ab c " has 6 characters
    assert same[1] == same[3] == set()


def brute_cells(text):
    """Cells of a text, character by character."""
    text = f" {' '.join((text or '').lower().split())} "
    out = set()
    for n in toxicity.SIZES:
        for k in range(len(text) - n + 1):
            h = 0
            for c in text[k : k + n]:
                h = (h * 0x01000193 + ord(c) + 1) & 0xFFFFFFFF
            out.add((((h ^ n) * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - toxicity.BITS))
    return out


def test_toxicity_against_brute_force(spark, sf):
    """Counts, ratios, kept cells and scores from sets of cells."""
    docs, labels = load(spark, sf)
    sample = toxicity.labelled_sample(spark, docs, labels, "toxic")
    rows = sample.collect()
    wanted = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    assert {r.doc_id: r.label for r in rows} == wanted
    text = {r.doc_id: r.text for r in docs.collect()}
    cells = {i: brute_cells(text[i]) for i in wanted}
    counts = np.zeros((2, 1 << toxicity.BITS), int)
    for i, k in wanted.items():
        counts[k, list(cells[i])] += 1
    assert (toxicity.class_counts(sample, spark).sum(0) == counts).all()
    n = [sum(k == c for k in wanted.values()) for c in (0, 1)]
    ratio = {c: np.log((counts[1, c] + 1) / (n[1] + 2)) - np.log((counts[0, c] + 1) / (n[0] + 2)) for c in np.flatnonzero(counts.sum(0) >= toxicity.LEAST_ROWS)}
    kept, ratios = toxicity.choose_cells(counts, np.array(n))
    most = sorted(ratio, key=lambda c: (-round(abs(ratio[c]) * np.sqrt(counts[:, c].sum()), 9), c))[: toxicity.CELLS]
    assert len(kept) == min(toxicity.CELLS, sum(abs(x) > 1e-12 for x in ratio.values()))
    assert np.allclose(ratios, [ratio[c] for c in kept])
    worst = abs(ratio[most[-1]]) * np.sqrt(counts[:, most[-1]].sum())
    assert all(abs(ratio[c]) * np.sqrt(counts[:, c].sum()) >= worst - 1e-9 for c in kept)
    weights, intercept = toxicity.fit(spark, docs, labels)
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(spark, docs, labels).collect()}
    for i in list(text)[:60]:
        z = intercept + weights[list(brute_cells(text[i]))].astype(float).sum()
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_quality_against_brute_force(spark, sf):
    """Class moments, shrinkage and the ratio of densities, from the labelled rows at once."""
    docs, labels = load(spark, sf)
    text = {r.doc_id: r.text for r in docs.collect()}
    known = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in text and zlib.crc32(str(r.doc_id).encode()) % 5}
    x = {i: quality.statistics((t or "").encode()) for i, t in text.items()}
    own = {k: np.stack([x[i] for i, q in known.items() if q == k]) for k in (0, 1)}
    cov = {k: np.cov(v.T, bias=True) for k, v in own.items()}
    d, n = len(quality.STATISTICS), {k: len(v) for k, v in own.items()}
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    pooled = (1 - quality.TO_DIAGONAL) * pooled + quality.TO_DIAGONAL * (np.diag(np.diag(pooled)) + 1e-4 * np.eye(d))
    z = {i: np.log((n[1] + 1) / (n[0] + 1)) for i in x}
    for sign, k in ((-1, 0), (1, 1)):
        c = (1 - quality.TO_POOLED) * cov[k] + quality.TO_POOLED * pooled + 1e-6 * np.eye(d)
        for i, v in x.items():
            e = v - own[k].mean(0)
            z[i] += sign * (-0.5 * e @ np.linalg.solve(c, e) - 0.5 * np.linalg.slogdet(c)[1])
    for r in quality.quality_scores(spark, docs, labels).collect():
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(z[r.doc_id], -500, 500))), abs=1e-6)


def test_windows_give_the_same_cells(monkeypatch):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc \u00e9 "), n)) for n in (0, 1, 5, 40, 333, 4000)] + [None, "x" * 1000, " " * 300, "ab " + " " * 200 + "cd" * 90]
    whole = toxicity.text_cells(texts)
    for window in (7, 64, 1000):
        monkeypatch.setattr(toxicity, "WINDOW", window)
        assert all((a == b).all() for a, b in zip(whole, toxicity.text_cells(texts)))


def test_the_sample_is_bounded(spark, sf, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 10)
    docs, labels = load(spark, sf)
    more = labels.unionByName(spark.range(10**6, 10**6 + 500).selectExpr("id as doc_id", "1 as quality", "1 as toxic"))  # without documents
    rows = toxicity.labelled_sample(spark, docs.unionByName(docs.withColumn("text", toxicity.F.concat("text", toxicity.F.lit("x")))).unionByName(docs), more.unionByName(labels), "toxic").collect()
    assert len(rows) == 10 and len({r.doc_id for r in rows}) == 10
