"""Toxicity by a linear classifier over character n-grams that are scaled by naive Bayes log-count ratios.

Texts are lower-cased, runs of white space become one space and the whole is padded with a space. The features are the
character n-grams of ``SIZES`` hashed into ``2**BITS`` cells; a text has a cell or has it not. The classifier is fitted
on at most ``SAMPLE_ROWS`` labelled training documents (those whose id hashes lowest): executors count in how many documents of
each class a cell occurs, the ``CELLS`` cells of at least ``LEAST_ROWS`` documents with the largest log-count ratios for their frequency
are kept, and logistic regression with an L2 penalty is fitted on presence times ratio until its gradient vanishes. Ratios and weights
flatter the rows that they come from, so slope and intercept of the final score are fitted on scores of ``CALIBRATION_FOLDS`` models, each
with cells, ratios and weights from the other folds alone. Scoring reads every whole text in one pass, in windows of ``WINDOW`` characters,
against one weight vector of fixed size.

Defined cases: null and empty texts have the n-grams of the padding alone, none, and score the intercept; very long texts are read in
windows that overlap, so memory does not grow with them but for the text itself; a score that equals the threshold is predicted as
1; repeated rows are each scored; of the rows of a labelled id one is learned from, and contradicting labels count as 1; a null label is no
label, and a label without a document is not used; with no labelled rows, or one class only, the score is the smoothed
prior; no documents give no rows; other columns are ignored; a null ``doc_id`` is scored, never held out and never labelled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, crc_mod, expand, lowest, slices, squeeze, table, vector_blocks, vector_sum

SIZES = (3, 4, 5, 6)
BITS = 20
SAMPLE_ROWS = 8192
#: Cells that are kept, and documents that a kept cell occurs in.
CELLS, LEAST_ROWS = 16384, 3
#: Characters whose n-grams are made at once.
WINDOW = 1 << 18
PENALTY = 1.0
TOLERANCE = 1e-6
CALIBRATION_FOLDS = 4
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5


def padded(text: str | None) -> Iterator[str]:
    """A text in lower case with single spaces and one at both ends, in consecutive parts of about WINDOW characters."""
    text = text or ""
    if len(text) <= WINDOW:
        yield f" {' '.join(text.lower().split())} "
        return
    at, space = 0, " "
    while at < len(text):
        end = min(len(text), at + WINDOW)
        cut = end
        while end < len(text) and cut > at and not text[cut - 1].isspace():
            cut -= 1
        cut = cut if cut > at else end  # within a word that is longer than a window
        if part := " ".join(text[at:cut].lower().split()):
            yield (" " if text[at].isspace() else space) + part
            space = " " if text[cut - 1].isspace() else ""
        else:
            space = " "
        at = cut
    yield " "


def window_cells(texts: list[str], rows: list[int], wanted: np.ndarray | None) -> np.ndarray:
    """Distinct row << BITS | cell of the texts, which have these row numbers."""
    sizes = np.array([len(p) for p in texts])
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.array(rows, np.int64), sizes)
    which = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    pairs, h = [], np.zeros(len(chars), np.uint32)
    for n in range(1, max(SIZES) + 1):
        if len(chars) < n:
            break
        h = h[: len(chars) - n + 1] * np.uint32(0x01000193) + chars[n - 1 :] + np.uint32(1)
        if n in SIZES:
            cell = ((h ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            ok = which[: len(h)] == which[n - 1 :]
            if wanted is not None:
                ok &= wanted[cell]
            at = np.flatnonzero(ok)
            pairs.append((row[at] << BITS) | cell[at])
    return np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)


def text_cells(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, cell) pairs in row order; with ``wanted`` only cells where it is true."""
    found, some, rows, size, kept = [np.empty(0, np.int64)], [], [], 0, 0
    for k, text in enumerate(texts):
        before = ""
        for part in padded(text):
            some.append(before + part)
            before = some[-1][1 - max(SIZES) :]
            rows.append(k)
            size += len(part)
            if size >= WINDOW:
                found.append(window_cells(some, rows, wanted))
                kept += len(found[-1])
                some, rows, size = [], [], 0
                if len(found) > 2 and kept > 4_000_000:  # a long text has most cells in every window
                    found = [np.unique(np.concatenate(found))]
                    kept = 0
    if some:
        found.append(window_cells(some, rows, wanted))
    both = np.unique(np.concatenate(found))
    return both >> BITS, both & ((1 << BITS) - 1)


def class_counts(sample: DataFrame, spark: SparkSession) -> np.ndarray:
    """Rows by fold and class that have each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2 * CALIBRATION_FOLDS, 1 << BITS), np.int32)
        for batch in slices(batches, 512):
            row, cell = text_cells(batch.column("text").to_pylist())
            kind = (2 * batch.column("fold").to_numpy() + batch.column("label").to_numpy())[row]
            for k in range(len(total)):
                total[k] += np.bincount(cell[kind == k], minlength=1 << BITS).astype(np.int32)
        yield vector_blocks(total.ravel())

    sums = vector_sum(sample.select("text", "label", "fold").mapInArrow(run, "block int, blob binary"), spark, "int32", 2 * CALIBRATION_FOLDS << BITS)
    return sums.reshape(CALIBRATION_FOLDS, 2, -1)


class SparseRows:
    """Presence times ratio in compressed rows."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.cols = np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int32)
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
        self.values, self.shape = ratio[self.cols], (len(rows), len(ratio))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.cols], self.shape[0])

    def transposed_dot(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, self.values * v[self.row], self.shape[1])


def fit_logistic(x: SparseRows, y: np.ndarray, penalty: float, steps: int = 100, inner: int = 100) -> tuple[np.ndarray, float]:
    """Newton steps by conjugate gradients, until the gradient is TOLERANCE of the first; the intercept is not penalised."""
    w, b = np.zeros(x.shape[1]), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    first = None
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w) + b, -40, 40)))
        s = np.maximum(p * (1 - p), 1e-6)
        gw, gb = x.transposed_dot(p - y) + penalty * w, float((p - y).sum())

        def hessian(v: np.ndarray, c: float) -> tuple[np.ndarray, float]:
            t = s * (x.dot(v) + c)
            return x.transposed_dot(t) + penalty * v, float(t.sum())

        dw, db = np.zeros_like(w), 0.0
        rw, rb = -gw, -gb
        pw, pb = rw.copy(), rb
        size = rw @ rw + rb * rb
        start = size
        first = size if first is None else first
        if size <= TOLERANCE**2 * first:
            break
        for _ in range(inner):
            if size <= 1e-4 * start or size < 1e-12:
                break
            hw, hb = hessian(pw, pb)
            a = size / (pw @ hw + pb * hb)
            dw, db, rw, rb = dw + a * pw, db + a * pb, rw - a * hw, rb - a * hb
            was, size = size, rw @ rw + rb * rb
            pw, pb = rw + size / was * pw, rb + size / was * pb
        w, b = w + dw, b + db
    return w, b


def log_ratio(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log of the smoothed shares of class 1's and class 0's rows."""
    share = [(counts[k] + 1.0) / (rows[k] + 2.0) for k in (0, 1)]
    return np.log(share[1] / share[0])


def fit_line(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on one score."""
    scale = scores.std() + 1e-9
    a, t = np.stack([scores / scale, np.ones_like(scores)], 1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ t, -40, 40)))
        t = t + np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (y - p) - 1e-3 * t)
    return float(t[0] / scale), float(t[1])


def choose_cells(counts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept cells and their log-count ratios: log of smoothed shares of class 1 over class 0."""
    ratio = log_ratio(counts, rows)
    total = counts.sum(0)
    weight = np.where(total >= LEAST_ROWS, np.abs(ratio) * np.sqrt(total), 0.0)
    cells = np.argsort(-weight, kind="stable")[:CELLS]
    cells = np.sort(cells[weight[cells] > 0])
    return cells, ratio[cells]


def among(cells: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Places in the sorted ``cells`` of those of a row that are there."""
    at = np.searchsorted(cells, own).clip(max=max(0, len(cells) - 1))
    return at[cells[at] == own] if len(cells) else at[:0]


def calibration(cells: list[np.ndarray], y: np.ndarray, fold: np.ndarray, chosen: list[tuple[np.ndarray, np.ndarray]]) -> tuple[float, float]:
    """Slope and intercept from scores of rows by models without them."""
    scores = np.zeros(len(y))
    for k, (kept, ratio) in enumerate(chosen):
        learn, rest = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if not len(rest) or len(np.unique(y[learn])) < 2:
            return 1.0, 0.0
        w, b = fit_logistic(SparseRows([among(kept, cells[i]) for i in learn], ratio), y[learn], PENALTY)
        scores[rest] = SparseRows([among(kept, cells[i]) for i in rest], ratio).dot(w) + b
    return fit_line(scores, y)


def labelled_sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """text, label and fold of at most SAMPLE_ROWS labelled training documents, written."""
    space = Workspace(spark)
    own = F.col(column)
    known = labels.where(own.isin(0, 1) & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT)).groupBy("doc_id").agg(F.max(own.cast("int")).alias("label"))
    ids = lowest(space.save(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "labels"), ["doc_id"], SAMPLE_ROWS)
    # at most SAMPLE_ROWS small rows, so the broadcast is bounded
    ids = space.save(ids.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(CALIBRATION_FOLDS)).cast("int")), "ids")
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    one = found.groupBy("doc_id", "label", "fold").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return space.save(one, "sample")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str = "toxic") -> tuple[np.ndarray, float]:
    """Weights by cell and the intercept."""
    sample = labelled_sample(spark, docs, labels, column)
    n = {(r.fold, r.label): r.n for r in sample.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = np.array([[n.get((f, k), 0) for k in (0, 1)] for f in range(CALIBRATION_FOLDS)])
    every = rows.sum(0)
    weights = np.zeros(1 << BITS, np.float32)
    if every.min() == 0:
        return weights, float(np.log((every[1] + 1) / (every[0] + 1)))
    counts = class_counts(sample, spark)
    cells, ratio = choose_cells(counts.sum(0), every)
    chosen = [choose_cells(counts.sum(0) - counts[k], every - rows[k]) for k in range(CALIBRATION_FOLDS)]
    wanted = np.zeros(1 << BITS, bool)
    for kept, _ in [(cells, ratio), *chosen]:
        wanted[kept] = True
    shared = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            row, cell = text_cells(batch.column("text").to_pylist(), shared.value)
            parts = np.split(cell.astype(np.int32), np.searchsorted(row, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("fold"), pa.array([squeeze(p) for p in parts], pa.binary())], names=["label", "fold", "cells"])

    # at most SAMPLE_ROWS rows with at most (1 + CALIBRATION_FOLDS) * CELLS numbers each
    got = sample.select("doc_id", "text", "label", "fold").orderBy("doc_id").select("text", "label", "fold").mapInArrow(run, "label int, fold int, cells binary").collect()
    own, y, fold = [expand(r.cells, np.int32)[0] for r in got], np.array([r.label for r in got], float), np.array([r.fold for r in got])
    w, b = fit_logistic(SparseRows([among(cells, x) for x in own], ratio), y, PENALTY)
    slope, shift = calibration(own, y, fold, chosen)
    weights[cells] = slope * w * ratio
    return weights, slope * b + shift


def toxicity_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    weights, intercept = fit(spark, docs, labels)
    shared = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        wanted = weight != 0
        for batch in slices(batches, 128):
            row, cell = text_cells(batch.column("text").to_pylist(), wanted)
            z = intercept + np.bincount(row, weight[cell], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLES: dict[str, str] = {}
