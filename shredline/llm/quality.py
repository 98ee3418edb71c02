"""Quality by regularised quadratic discriminant analysis over document statistics.

A document becomes ``len(STATISTICS)`` statistics of its whole text, each put through a logarithm or square root so
that its classes are nearer to normal. Class means and covariances come from sums over the labelled training documents (at most
``SAMPLE_ROWS``, those whose id hashes lowest), added up on the executors. Each covariance is shrunk towards the pooled one and that towards
its scaled diagonal; its Cholesky factor is computed once. The score is the posterior from the difference of the log densities
(Mahalanobis distance and log determinant) and the class priors.

Defined cases: a null text is empty; an empty text has all statistics zero and is scored like any other; very long texts are read whole,
with their word windows compared as 64-bit hashes; a score that equals the threshold is predicted as 1; repeated rows
are each scored and, where labelled, each counted; a null label is no label, and a label without a document is not used; with no
labelled rows, or one class only, the score is the smoothed prior; no documents give no rows; other columns are ignored; a null
``doc_id`` is scored, never held out and never labelled.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, crc_mod, lowest, shingle_hashes, slices, table, texts, word_hashes

STATISTICS = (
    "log_bytes", "word_length", "upper", "digit", "symbol", "bang", "pipe", "punctuation", "other_ascii", "space", "line_breaks",
    "distinct_words", "top_word", "distinct_lines", "distinct_windows", "byte_entropy", "compressed", "marked_words", "longest_word",
)
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
#: Labelled documents that are learned from; words of a text whose windows are hashed.
SAMPLE_ROWS, LONG_WORDS = 200_000, 200_000
#: Shrinkage of a class covariance towards the pooled one, and of that towards its diagonal.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05

_GROUP = np.full(256, 6, np.uint8)  # byte groups: 0 lower or beyond ASCII, 1 upper, 2 digit, 3 symbol, 4 punctuation, 5 space, 6 other, 7 !, 8 |
_GROUP[97:123] = 0
_GROUP[128:] = 0
_GROUP[65:91] = 1
_GROUP[48:58] = 2
for _c in b"#$%&*@^~<>=+\\_":
    _GROUP[_c] = 3
for _c in b".,;:?'\"()-/[]{}":
    _GROUP[_c] = 4
for _c in b" \t\n\r\x0b\x0c":
    _GROUP[_c] = 5
_GROUP[ord("!")] = 7
_GROUP[ord("|")] = 8
_MARKED = frozenset(b"#$%&*!@^~<>=+\\_|")


def distinct_windows(words: list[bytes]) -> int:
    """Distinct windows of three words, which are compared as hashes in a very long text."""
    if len(words) < LONG_WORDS:
        return len(set(zip(words, words[1:], words[2:])))
    return len(np.unique(shingle_hashes(word_hashes(words), 3)))


def statistics(text: bytes) -> np.ndarray:
    out = np.zeros(len(STATISTICS))
    n = len(text)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    groups = np.bincount(_GROUP, weights=counts, minlength=9) / n
    words = text.split()
    w = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    p = counts[counts > 0] / n
    out[0] = np.log1p(n)
    if w:
        seen = Counter(words)
        out[1] = np.log(sum(map(len, words)) / w)
        out[11] = len(seen) / w ** 0.9
        out[12] = np.sqrt(max(seen.values()) / w)
        out[14] = np.log(0.02 + distinct_windows(words) / max(1, w - 2)) if w > 2 else 0.0
        out[17] = np.sqrt(sum(x[-1] in _MARKED for x in words) / w)
        out[18] = np.log(max(map(len, words)))
    out[2:11] = np.sqrt(groups[[1, 2, 3, 7, 8, 4, 6, 5, 0]])
    out[10] = np.sqrt(counts[10] / n)
    if lines:
        out[13] = np.log(0.02 + len(set(lines)) / len(lines))
    out[15] = float(-(p * np.log2(p)).sum())
    out[16] = np.log(len(zlib.compress(text, 1)) / (n + 12))
    return out


def class_sums(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """For each label of (text, label): rows, sum of the statistics, sum of their outer products. Each task adds up its own rows and 64
    groups add up the tasks' sums, so the driver receives at most 64 small rows."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((2, 1 + d + d * d))
        for batch in slices(batches):
            label = batch.column("label").to_numpy()
            x = np.array([statistics(t) for t in texts(batch)]).reshape(-1, d)
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        bucket = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["bucket", "blob"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b) for b in rows.column("blob").to_pylist())
        return pa.table({"blob": pa.array([np.asarray(total).tobytes()], pa.binary())})

    parts = labelled.select("text", "label").mapInArrow(run, "bucket int, blob binary").groupBy("bucket").applyInArrow(add, "blob binary")
    total = sum((np.frombuffer(r.blob) for r in parts.collect()), np.zeros(2 * (1 + d + d * d))).reshape(2, -1)
    return {k: (total[k][0], total[k][1 : 1 + d], total[k][1 + d :].reshape(d, d)) for k in (0, 1)}


class Discriminant:
    """Two normal classes with shrunk covariances; Cholesky factors are kept."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL):
        n = {k: sums[k][0] for k in (0, 1)}
        self.prior = float(np.log((n[1] + 1) / (n[0] + 1)))
        self.ready = min(n.values()) >= 2
        if not self.ready:
            return
        mean = {k: sums[k][1] / n[k] for k in n}
        cov = {k: sums[k][2] / n[k] - np.outer(mean[k], mean[k]) for k in n}
        pooled = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
        spread = np.diag(np.diag(pooled)) + 1e-4 * np.eye(len(pooled))
        pooled = (1 - to_diagonal) * pooled + to_diagonal * spread
        self.classes = []
        for k in (0, 1):
            own = (1 - to_pooled) * cov[k] + to_pooled * pooled + 1e-6 * np.eye(len(pooled))
            factor = np.linalg.cholesky(own)
            self.classes.append((mean[k], np.linalg.inv(factor), float(np.log(np.diag(factor)).sum())))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1."""
        z = np.full(len(x), self.prior)
        if self.ready:
            for sign, (mean, inverse, half_log_det) in zip((-1, 1), self.classes):
                y = (x - mean) @ inverse.T
                z += sign * (-0.5 * (y * y).sum(1) - half_log_det)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str = "quality") -> Discriminant:
    """The model of the labelled training documents; only their statistics are made."""
    space, own = Workspace(spark), F.col(column)
    known = labels.where(own.isin(0, 1) & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id", own.cast("int").alias("label"))
    known = lowest(space.save(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "every-label"), ["doc_id", "label"], SAMPLE_ROWS)
    # at most SAMPLE_ROWS small rows, so the broadcast is bounded and no text moves
    known = space.save(known, "labels")
    return Discriminant(class_sums(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")))


def good_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that are predicted as good; no shuffle moves them."""
    model = spark.sparkContext.broadcast(fit(spark, docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = np.array([statistics(t) for t in texts(batch)]).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(model.value.scores(rows) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = spark.sparkContext.broadcast(fit(spark, docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = np.array([statistics(t) for t in texts(batch)]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.scores(rows))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op10_quality_classifier": op10_quality_classifier}
ORACLES: dict[str, str] = {}
