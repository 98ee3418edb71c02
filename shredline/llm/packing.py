"""Best-fit packing by exact complements.

One pass tokenises the texts and cuts them into pieces of at most ``capacity`` tokens. Planning needs only how many
pieces each length has, so the driver holds at most ``capacity`` counts whatever the input. ``plan`` takes lengths
from the longest down and looks for a single length, a pair or a triple that exactly fills the gap, from indices of the
sums that the lengths still available can make, and consumes the combination as often as its counts allow. What has no
exact complement is placed best-fit, longest first, into the smallest gap that holds it. A plan is a list of
(length, first rank, how many, first sequence, offset) and is bounded by the number of lengths, not of pieces. Pieces
find their place by their rank within their length, which comes from per-task counters and prefix sums over tasks, so
a length that a third of all pieces have never meets in one task.

Defined cases: a null text is empty and is the end token alone; repeated rows are packed each; a text whose tokens and
end fill ``capacity`` exactly is one piece; very long texts are cut into pieces and lose nothing; pieces of one
length are ranked by task and place, and which of them goes where has no meaning; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Workspace, table

CAPACITY = 2048
END_ID = 0
#: Words, and letter runs or punctuation runs, whose ids a Python worker remembers; beyond this it forgets and goes on.
CACHE_WORDS, CACHE_RUNS = 900_000, 600_000
#: ASCII marks that end a word and start no contraction; the tokenizer's pattern splits them off.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def lowered(text: str) -> str:
    """Lower case where that is what the tokenizer's normaliser makes of it for certain: in Latin-1, and without what
    could become the name of a special token."""
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class WordEncoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    The tokenizer's pattern never spans a space or a line feed and its normaliser changes nothing across them, so a
    text's ids are its words' ids in order, and each word is encoded once and remembered. A word of letters below
    U+0250 and marks at its end is remembered as its lower-cased letters and its marks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def encode_runs(self, letters: list[str], others: list[str]) -> None:
        for at in range(0, len(letters), 4096):
            part = letters[at : at + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1  # a letter run ends in one end-of-word token
            if len(stops) == len(part):
                blob, stops = ids.tobytes(), (4 * stops).tolist()
                for w, a, b in zip(part, [0, *stops], stops):
                    self.runs[w] = blob[a:b]
            else:
                others = others + part
        for at in range(0, len(others), 4096):
            part = others[at : at + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.runs[w] = np.array(e.ids, "<u4").tobytes()

    def learn(self, new: set[str]) -> None:
        if len(self.words) > CACHE_WORDS:
            self.words = {"": b""}
        if len(self.runs) > CACHE_RUNS:
            self.runs = {"": b""}
        split, letters, others = {}, set(), set()
        for w in new:
            run = w.rstrip(MARKS)
            low, marks = run.lower(), w[len(run) :]
            if low.isalpha() and (run.isascii() or max(run) < "\u0250"):
                letters.add(low)
                others.add(marks)
                split[w] = (low, marks)
            else:
                others.add(w)
                split[w] = (w, "")
        known = self.runs
        self.encode_runs([w for w in letters if w not in known], [w for w in others if w not in known])
        self.words.update((w, known[a] + known[b]) for w, (a, b) in split.items())

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        words = [lowered(t or "").replace("\n", " ").split(" ") for t in texts]
        every = set().union(*words)
        if len(self.words) > CACHE_WORDS:
            self.learn(every)
        else:
            self.learn(every.difference(self.words))
        get = self.words.__getitem__
        for ws in words:
            yield b"".join(map(get, ws))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder that this Python worker keeps from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Pieces with their rank ``nth`` among those of the same length that the same task made."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                own = batch.slice(at, 128)
                rows = []
                for doc_id, ids in zip(own.column("doc_id").to_pylist(), encode(own.column("text").to_pylist())):
                    ids += end
                    for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        blob = ids[begin : begin + 4 * capacity]
                        n = len(blob) // 4
                        rows.append((doc_id, piece, begin // 4, n, zlib.crc32(blob), part, seen[n]))
                        seen[n] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


class Sums:
    """Which sums one, two or three of the available lengths make; rebuilt when a length runs out."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.stale = counts, True

    def refresh(self) -> None:
        if self.stale:
            self.one = self.counts > 0
            size = 1 << (2 * len(self.counts) - 1).bit_length()
            f = np.fft.rfft(self.one.astype(float), size)
            self.two = np.fft.irfft(f * f, size)[: len(self.counts)] > 0.5
            self.stale = False

    def enough(self, parts: tuple[int, ...]) -> int:
        """How often the combination can be taken."""
        return min(int(self.counts[p]) // parts.count(p) for p in set(parts))

    def filling(self, first: int, gap: int) -> tuple[int, ...] | None:
        """Lengths that with ``first`` exactly fill: a single, else a pair, else a triple, larger parts first."""
        self.refresh()
        if gap == 0:
            return (first,)
        if self.one[gap] and self.enough((first, gap)):
            return (first, gap)
        if self.two[gap]:
            for b in np.flatnonzero(self.one[: gap] & self.one[gap:0:-1])[::-1]:
                if 2 * b < gap:
                    break
                if self.enough(parts := (first, int(b), int(gap - b))):
                    return parts
        tails = self.one[:gap] & self.two[gap:0:-1]
        for b in np.flatnonzero(tails)[::-1]:
            if 3 * b < gap:
                break
            rest = int(gap - b)
            for c in np.flatnonzero(self.one[:rest] & self.one[rest:0:-1])[::-1]:
                if 2 * c < rest:
                    break
                if self.enough(parts := (first, int(b), int(c), int(rest - c))):
                    return parts
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences have each, over all pieces."""
    have = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        have[n] = c
    left, sums, out = dict[int, int](), Sums(have), []
    for a in range(capacity, 0, -1):
        while have[a]:
            parts = sums.filling(a, capacity - a)
            if parts is None:
                left[a] = int(have[a])
                have[a] = 0
                sums.stale = True
                break
            times = sums.enough(parts)
            for p in parts:
                have[p] -= times
            sums.stale = sums.stale or any(have[p] == 0 for p in parts)
            out.append((parts, times))
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for a, n in left.items():  # longest first
        while n:
            gap = min((g for g in open_ if g >= a), default=None)
            if gap is None:
                times = 1 if 2 * a <= capacity else n  # short ones fill the sequence that they open
                parts, room = (a,), capacity - a
            else:
                (parts, m) = open_[gap].pop()
                times = min(n, m)
                if m > times:
                    open_[gap].append((parts, m - times))
                if not open_[gap]:
                    del open_[gap]
                fit = 1
                if 2 * a <= gap and n >= m:
                    fit = min(gap // a, n // times)
                parts, room = parts + (a,) * fit, gap - a * fit
                n -= times * (fit - 1)
            if gap is None and times == 1:
                fit = capacity // a
                if n >= fit:
                    times = n // fit
                    parts, room = (a,) * fit, capacity - a * fit
                    n -= times * (fit - 1)
            n -= times
            open_.setdefault(room, []).append((parts, times))
    return out + [x for same in open_.values() for x in same]


def placements(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Runs of ranks of a length and where they go: length, rank, sequence, offset; sorted by length and rank."""
    rows, used, sequence = [], {}, 0
    for parts, times in patterns:
        at = 0
        for n in parts:
            rows.append((n, used.get(n, 0), sequence, at))
            used[n] = used.get(n, 0) + times
            at += n
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4)
    return {k: cols[:, i] for i, k in enumerate(("length", "rank", "sequence", "offset"))}


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = Workspace(spark).save(cut_pieces(docs, tokenizer, capacity), "pieces")
    by_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = spark.sparkContext.broadcast(placements(plan(counts, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = runs.value
        key = (to["length"] << 48) + to["rank"]
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(key, (n << 48) + rank, side="right") - 1
            own = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(to["sequence"][at] + rank - to["rank"][at]), pa.array(to["offset"][at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def word_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"), word_tokenizer())


QUERIES = {"op7_best_fit_packing": op7_best_fit_packing}
ORACLES: dict[str, str] = {}
