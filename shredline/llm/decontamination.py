"""Benchmark decontamination by greedy string tiling.

Words are lower-cased and stripped of edge punctuation. A document and a benchmark item first meet where they share a
window of ``MIN_TILE`` words (a seed). Seeds bound the coverage from above: only pairs whose seed windows cover
``COVERAGE`` of the item's words are tiled. Tiling marks the longest common runs of unmarked words first, of equally long ones those that come
first in the item and then in the document. The longest length is found by bisection over running Karp-Rabin hashes (prefix sums, so a search
takes one pass however long it is) and every hash hit is confirmed word by word, so reordered passages count in full. A pair is
reported when the marked words reach ``COVERAGE`` of the item.

The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of text, or one item that is longer, so what is broadcast has a fixed bound
however large the benchmark is. Documents never move. With one block there is one pass over them; with more, a pass with a table of
fixed size that tells which seeds any item may have leaves the few documents that the blocks' passes read.

Defined cases: null and empty texts match nothing; items without words are never found; an item shorter than
``MIN_TILE`` words is one seed and one tile as a whole; a coverage that equals the threshold is reported; very long texts are read whole, and a
seed's places are never multiplied with its items; repeated documents are each reported, repeated items too; other columns are
ignored; an empty benchmark or no documents find nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, shingle_hashes, slices, table, texts, vector_blocks, vector_sum

MIN_TILE = 5
COVERAGE = 0.6
BLOCK_BYTES = 8 << 20
#: Bits of a seed's place in the table of all seeds.
SEED_BITS = 24
HITS = "doc_id long, item_id long, coverage double, tiles int, matched_words int, item_words int"
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’¿¡…–—"


class PlainWords:
    """Hashes of words without case and edge punctuation, remembered up to a number of words."""

    def __init__(self, most: int = 300_000) -> None:
        from xxhash import xxh3_64_intdigest

        self.digest, self.most, self.known = xxh3_64_intdigest, most, {}

    def text(self, text: bytes) -> np.ndarray:
        words, known = text.split(), self.known
        if len(known) > self.most:
            known.clear()
        for w in set(words).difference(known):
            plain = w.decode("utf-8", "replace").lower().strip(_EDGES)
            known[w] = self.digest(plain.encode()) or 1 if plain else 0  # 0: punctuation alone
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        return h[h != 0]


BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Hashes of all windows of a text by prefix sums, and which words are unmarked."""

    def __init__(self, words: np.ndarray, free: np.ndarray):
        n = len(words)
        self.words, self.free = words, free
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(BASE, n), dtype=np.uint64)])
        self.scale = powers(_INVERSE, n)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the unmarked windows of n words and their hashes."""
        if len(self.words) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        marked = np.concatenate([[0], np.cumsum(~self.free)])
        at = np.flatnonzero(marked[n:] == marked[:-n])
        return at, (self.sums[at + n] - self.sums[at]) * self.scale[at]


def tile(item: np.ndarray, doc: np.ndarray, usable: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, doc start, length) of at least ``least`` words, longest first."""
    p, t = Runs(item, np.ones(len(item), bool)), Runs(doc, usable.copy())
    out: list[tuple[int, int, int]] = []
    most = min(len(item), len(doc))
    while most >= least:
        low, high = least - 1, most  # the longest common length is at least low, and at most high
        while low < high:
            middle = (low + high + 1) // 2
            if np.isin(p.windows(middle)[1], t.windows(middle)[1]).any():
                low = middle
            else:
                high = middle - 1
        n, most = low, low - 1
        if n < least:
            break
        (own, mine), (at, theirs) = p.windows(n), t.windows(n)
        order = np.argsort(theirs, kind="stable")
        at, theirs = at[order], theirs[order]
        first = np.searchsorted(theirs, mine, "left")
        hit = np.flatnonzero((first < len(theirs)) & (theirs[first.clip(max=max(0, len(theirs) - 1))] == mine)) if len(theirs) else np.empty(0, np.int64)
        begin: dict[int, int] = {}  # by hash, where its unmarked places begin
        for k in hit.tolist():
            start = int(own[k])
            if not (p.free[start] and p.free[start + n - 1]):
                continue  # marked meanwhile; tiles of one length cover an end of what they overlap
            key = int(mine[k])
            i = begin.get(key, int(first[k]))
            while i < len(at) and theirs[i] == mine[k]:
                to = int(at[i])
                if t.free[to] and t.free[to + n - 1]:
                    if (item[start : start + n] == doc[to : to + n]).all():
                        p.free[start : start + n] = False
                        t.free[to : to + n] = False
                        out.append((start, to, n))
                        i += 1
                        break
                    i += 1  # another text of the same hash; those before it are not looked at again, nor is it
                    continue
                i += 1
            begin[key] = i
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words windows of ``width`` words with these starts cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0


class Matcher:
    """Seeds of a block of the benchmark, and the pairs of a document with its items."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], least: int, coverage: float):
        self.items, self.least, self.coverage = items, least, coverage
        self.sizes = np.array([len(w) for _, w in items])
        by_width: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for i, (_, words) in enumerate(items):
            if len(words):
                by_width[min(least, len(words))].append((shingle_hashes(words, least), i))
        self.index = {}
        for width, parts in by_width.items():
            h = np.concatenate([x for x, _ in parts])
            item = np.concatenate([np.full(len(x), i, np.int32) for x, i in parts])
            at = np.concatenate([np.arange(len(x), dtype=np.int32) for x, _ in parts])
            order = np.argsort(h, kind="stable")
            flags = np.zeros(1 << 22, bool)
            flags[h >> np.uint64(42)] = True
            self.index[width] = (h[order], item[order], at[order], flags)

    def __call__(self, words: np.ndarray) -> list[tuple[int | None, float, int, int, int]]:
        """(item id, coverage, tiles, matched words, item words) of the items that the document holds."""
        found = []
        for width, (seeds, item, at, flags) in self.index.items():
            if len(words) < width:
                continue
            h = shingle_hashes(words, width)
            maybe = np.flatnonzero(flags[h >> np.uint64(42)])
            if not len(maybe):
                continue
            own = np.unique(h[maybe])
            low, high = np.searchsorted(seeds, own, "left"), np.searchsorted(seeds, own, "right")
            n = high - low
            if not n.any():
                continue
            # items and places in them of the document's distinct seeds; its own places are looked up for items that pass
            entry = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            which, where = item[entry], at[entry]
            enough = np.bincount(which, minlength=len(self.sizes)) * width >= self.coverage * self.sizes
            ok = enough[which]
            which, where = which[ok], where[ok]
            order = np.argsort(which, kind="stable")
            which, where = which[order], where[order]
            cuts = np.flatnonzero(np.diff(which)) + 1
            for k, mine in zip(which[np.concatenate([[0], cuts])] if len(which) else (), np.split(where, cuts)):
                item_id, target = self.items[k]
                if covered(mine, width, len(target)).sum() < self.coverage * len(target):
                    continue
                usable = covered(np.flatnonzero(np.isin(h, shingle_hashes(target, width))), width, len(words))
                keep = np.flatnonzero(usable | np.concatenate([[False], usable[:-1]]))  # with one barrier after each run
                tiles = tile(target, words[keep], usable[keep], width)
                matched = sum(x[2] for x in tiles)
                if matched >= self.coverage * len(target):
                    found.append((item_id, matched / len(target), len(tiles), matched, len(target)))
        return found


def blocks_of(spark: SparkSession, benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """item_id, text and block, written, and the blocks' numbers."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches):
            sizes, own = [len(t) for t in texts(batch)], []
            for n in sizes:
                if held and held + n > BLOCK_BYTES:
                    block, held = block + 1, 0
                held += n
                own.append(block)
            yield batch.append_column("block", pa.array(own, pa.int64()))

    cut_up = Workspace(spark).save(items.coalesce(max(1, -(-size // BLOCK_BYTES))).mapInArrow(cut, "item_id long, text string, block long"), "items")
    return cut_up, sorted(r.block for r in cut_up.select("block").distinct().collect())


def matcher(spark: SparkSession, items: DataFrame, block: int, coverage: float) -> Broadcast:
    words = PlainWords()
    rows = items.where(F.col("block") == block).collect()
    return spark.sparkContext.broadcast(Matcher([(r.item_id, words.text(r.text.encode())) for r in rows], MIN_TILE, coverage))


def seed_table(spark: SparkSession, items: DataFrame) -> Broadcast:
    """For each seed width a table of fixed size that tells which seeds an item may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, words = np.zeros((MIN_TILE, 1 << SEED_BITS), bool), PlainWords()
        for batch in slices(batches):
            for t in texts(batch):
                w = words.text(t)
                if len(w):
                    bits[min(MIN_TILE, len(w)) - 1, shingle_hashes(w, MIN_TILE) >> np.uint64(64 - SEED_BITS)] = True
        yield vector_blocks(np.packbits(bits.ravel()))

    packed = vector_sum(items.mapInArrow(run, "block int, blob binary"), spark, "uint8", MIN_TILE << SEED_BITS - 3, np.bitwise_or)
    return spark.sparkContext.broadcast(np.unpackbits(packed).astype(bool).reshape(MIN_TILE, -1))


def seeded(docs: DataFrame, table_: Broadcast, wanted: bool) -> DataFrame:
    """The documents that may have a seed of the benchmark, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = PlainWords()

        def hit(t: bytes) -> bool:
            w = words.text(t)
            return any(bits[shingle_hashes(w, k) >> np.uint64(64 - SEED_BITS)].any() for k, bits in enumerate(table_.value, 1) if len(w) >= k)

        for batch in slices(batches):
            yield batch.filter(pa.array([hit(t) == wanted for t in texts(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def contaminated_pairs(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item that it covers: doc_id, item_id, coverage, tiles, matched_words, item_words."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items, blocks = blocks_of(spark, benchmark)
    if len(blocks) > 1:
        narrow = Workspace(spark).save(seeded(narrow, seed_table(spark, items), True), "seeded")
    out = spark.createDataFrame([], HITS)
    for block in blocks:

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = matcher(spark, items, block, coverage)) -> Iterator[pa.RecordBatch]:
            match, words = shared.value, PlainWords()
            for batch in slices(batches):
                rows = [(i, *hit) for i, t in zip(batch.column("doc_id").to_pylist(), texts(batch)) for hit in match(words.text(t))]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
                names = ["doc_id", "item_id", "coverage", "tiles", "matched_words", "item_words"]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        out = out.unionByName(narrow.mapInArrow(run, HITS))
    return out


def without_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents, with all their columns, that cover no item."""
    items, blocks = blocks_of(spark, benchmark)
    space, clean = Workspace(spark), None
    if len(blocks) > 1:
        table_ = seed_table(spark, items)
        clean, docs = seeded(docs, table_, False), space.save(seeded(docs, table_, True), "seeded")
    for block in blocks:

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = matcher(spark, items, block, coverage)) -> Iterator[pa.RecordBatch]:
            match, words = shared.value, PlainWords()
            for batch in slices(batches):
                yield batch.filter(pa.array([not match(words.text(t)) for t in texts(batch)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if clean is not None:  # each block's rest is written, so no task runs a worker for every block
            docs = space.save(docs, f"left-{block}")
    return docs if clean is None else clean.unionByName(docs)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_benchmark_decontamination": op2_benchmark_decontamination}
ORACLES: dict[str, str] = {}
