"""Exact n-gram Jaccard self-join of shingle sets.

Distance is one minus Jaccard similarity; a link is a distance of at most 0.2. Documents with the same set are one point.

*First level: a prefix filter.* Voronoi regions of sampled documents were the first choice. They hold nearly every text in every region,
because nearly all pairs of texts are at distance 1 (figures in the README), so the first level is what it is called here. All shingles are
ordered, rarer ones first by counts in a table of fixed size, then by hash. The steps of that order are shorter than the counts' chance
deviation, so that a passage that many texts share comes last even where its count is small beside what a cell has by chance. A set within the radius may lack at most a fifth of a
set's shingles, so a set is replicated into the regions of its first ``n - ceil(0.8 n) + 1`` shingles; two linked sets then meet in the region
of their first common shingle. In a region, sizes and positions bound the intersection that two sets can still have, and pairs below
the bound are left out.

*Second level: document pivots.* A region of more than ``SMALL`` sets takes one set as a pivot and measures all others from it; sets
within the radius are linked through it. What remains is joined recursively: sets outside the region's largest component
become pivots in turn, each against the sets of other components, except those that the triangle inequality over the
first pivot's distances, or the bounds below, exclude. A region is done when no such set is left, so no pair of different
components is left unmeasured. Sets that a rare shingle does not separate and that are in no link are compared with each other in the end.

Pairs are measured in two steps. Counts of a set's shingles in 256 hash classes give a lower bound of the symmetric
difference; the pairs that it leaves are intersected exactly. Shingles are read for these pairs only: a set goes into its large regions with
its counts alone. A turn takes few pivots of a region at first, so that large components have joined before all of their sets are pivots,
and few pairs of each pivot, the likeliest links first: one link joins it to a component, whose other sets it then need not meet. A pivot
that has more pairs stays a pivot, with more of them in each turn, until it is in the largest component or all of its pairs are measured.
Components of the links follow by large and small stars.
A shingle in so many sets that its region would outgrow ``HOT`` rows is split into block pairs that still meet all pairs.
Sets are compared as 64-bit hashes of shingles, and a point is a 64-bit hash of its set. A second hash tells whether two different
sets have become one point, which is an error (``PointCollision``; one in two from some 5e9 different texts on).

Defined cases: null, empty and blank texts have no shingles, are linked with nothing and are their own component;
fewer than five words are one shingle; very long texts are read whole; a similarity that equals the threshold is a link; repeated rows are
each returned and are one point; a null ``doc_id`` is never a ``component_id`` unless its whole component is null; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_KEYS, Workspace, shingle_hashes, slices, table, texts, vector_blocks, vector_sum, without_keys, word_hashes
from .graph import components

WIDTH = 5
#: A link: 5 * intersection >= 4 * union.
NUM, DEN = 4, 5
CELL_BITS = 21
CLASSES = 256
BLOOM_BITS = 24
#: Region rows that a shard holds on average; sets in a region that are compared directly; rows of a region before it is split.
SHARD_ROWS, SMALL, HOT = 250_000, 64, 1_000_000
#: Class counts of a region's sets, and of its pivots in a turn, that a task holds: a byte each.
BLOCK_CELLS = 4_000_000
#: Pivots of a region in the first turn, and how many times more in each further one.
PIVOTS, MORE = 16, 16
#: Pairs of a pivot in the first turn that has it, and MORE times as many in each further one.
FEW = 16


def document_sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return [np.unique(shingle_hashes(word_hashes(t.lower().split()), WIDTH)) for t in texts(batch)]


def point(shingles: np.ndarray, seed: int = 0) -> int:
    from xxhash import xxh3_64_intdigest

    h = xxh3_64_intdigest(shingles.tobytes(), seed=seed)
    return h - (1 << 64) if h >> 63 else h


#: The seed of a second hash that tells whether two sets have become one point.
CHECK_SEED = 1


class PointCollision(RuntimeError):
    """Two different sets have one point."""


def cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def read_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, fp and its check for each row, and in other rows the task's counts of shingles by cell (block, blob)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        names = ["doc_id", "n", "fp", "check", "block", "blob"]
        for batch in slices(batches):
            sets = document_sets(batch)
            np.add.at(counts, cells(np.concatenate(sets)), 1)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(point, sets), pa.int64()), pa.array([point(s, CHECK_SEED) for s in sets], pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                names=names,
            )
        sums = vector_blocks(counts)
        n = sums.num_rows
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64())] * 4 + sums.columns, names=names)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, n long, fp long, check long, block int, blob binary")


def order_levels(counts: np.ndarray) -> np.ndarray:
    """Steps of half the deviation that a cell's count has by chance, at any count: the root of a count deviates by a half."""
    return np.minimum(4 * np.sqrt(counts), np.iinfo(np.int16).max).astype(np.int16)


def parts_of(counts: np.ndarray) -> np.ndarray:
    """Parts of each cell's regions: one for each HOT rows beyond what a cell has by chance, so that parts do not grow with the documents."""
    return np.maximum(1, -(-(counts - int(2 * counts.mean())) // HOT)).astype(np.int32)


def window_length(n: int) -> int:
    return n - (NUM * n + DEN - 1) // DEN + 1


def region_rows(shingles: np.ndarray, fp: int, levels: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """(region, fp, n << 32 | position) for the regions that the set is replicated into."""
    n = len(shingles)
    k = window_length(n)
    cell = cells(shingles)
    first = np.lexsort((shingles, levels[cell]))[:k]
    key, at = shingles[first], np.arange(k, dtype=np.uint64)
    parts = splits[cell[first]]
    if parts.max() > 1:  # blocks a <= b of a split region: a set is in those with its own block
        own = np.uint64(fp & (1 << 64) - 1) % parts.astype(np.uint64)
        again = np.repeat(np.arange(k), parts)
        other = np.concatenate([np.arange(m) for m in parts]).astype(np.uint64)
        low, high = np.minimum(own[again], other), np.maximum(own[again], other)
        salt = np.where(parts[again] > 1, (low * np.uint64(1 << 20) + high + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 0).astype(np.uint64)
        key, at = key[again] ^ salt, at[again]
    out = np.empty((len(key), 3), np.uint64)
    out[:, 0], out[:, 1], out[:, 2] = key, np.uint64(fp & (1 << 64) - 1), np.uint64(n << 32) | at
    return out


def scatter(docs: DataFrame, levels, splits, shards: int) -> DataFrame:
    """shard, blob: the region rows of a batch of documents, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in slices(batches, 2048):
            rows = []
            for part in slices(iter([batch])):
                for s in document_sets(part):
                    if len(s) and (fp := point(s)) not in seen:
                        seen.add(fp)
                        rows.append(region_rows(s, fp, levels.value, splits.value))
            if len(seen) > 100_000:  # only saves repeats
                seen.clear()
            if rows:
                every = np.concatenate(rows)
                shard = (every[:, 0] % np.uint64(shards)).astype(np.int64)
                every = every[np.argsort(shard, kind="stable")]
                cuts = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])
                full = np.flatnonzero(np.diff(cuts))
                blobs = pa.array([every[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), blobs], names=["shard", "blob"])

    return docs.select("text").mapInArrow(run, "shard int, blob binary")


def possible(n: np.ndarray, at: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sets that first meet at these positions can be within the radius; n[i] <= n[j]."""
    need = -(-NUM * (n[i] + n[j]) // (NUM + DEN))
    return (DEN * n[i] >= NUM * n[j]) & (np.minimum(n[i] - at[i], n[j] - at[j]) >= need)


CANDIDATES = "a long, b long, region long, pivot long, n long, at long"


def join_shard(rows: pa.Table) -> pa.Table:
    """Candidate pairs (a, b) of small regions and of pivots in large ones; members (a, region, pivot, n, at) of these."""
    data = np.concatenate([np.frombuffer(b, np.uint64) for b in rows.column("blob").to_pylist()]).reshape(-1, 3)
    data = data[np.lexsort((data[:, 1], data[:, 2] >> np.uint64(32), data[:, 0]))]
    same = (data[1:, 0] == data[:-1, 0]) & (data[1:, 1] == data[:-1, 1])
    data = data[np.concatenate([[True], ~same])]
    region = data[:, 0]
    fp = np.ascontiguousarray(data[:, 1]).view(np.int64)
    n, at = (data[:, 2] >> np.uint64(32)).astype(np.int64), (data[:, 2] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
    size = np.diff(np.concatenate([start, [len(region)]]))
    own = np.repeat(size, size)
    pairs = []
    small = np.flatnonzero((own > 1) & (own <= SMALL))
    step = 1
    while len(small) and step < SMALL:
        small = small[small + step < len(region)]
        i, j = small, small + step
        near = (region[i] == region[j]) & (DEN * n[i] >= NUM * n[j])
        small = small[near]
        i, j = small, small + step
        ok = possible(n, at, i, j)
        pairs.append(np.stack([fp[i[ok]], fp[j[ok]]], 1))
        step += 1
    members = []
    for s, g in zip(start[size > SMALL], size[size > SMALL]):
        every = np.arange(s, s + g)
        p = s + g // 2  # the set of median size
        i, j = np.minimum(every, p), np.maximum(every, p)
        ok = possible(n, at, i, j) & (every != p)
        pairs.append(np.stack([fp[i[ok]], fp[j[ok]]], 1))
        members.append((fp[every], np.full(g, region[s], np.uint64).view(np.int64), np.full(g, fp[p]), n[every], at[every]))
    both = np.concatenate([*pairs, np.empty((0, 2), np.int64)])
    both = np.unique(np.stack([both.min(1), both.max(1)], 1), axis=0) if len(both) else both
    k, m = len(both), sum(len(x[0]) for x in members)
    five = [np.concatenate([x[c] for x in members]) if members else np.empty(0, np.int64) for c in range(5)]
    longs = lambda x: pa.array(np.ascontiguousarray(x), pa.int64())
    filled = lambda x: pa.concat_arrays([pa.nulls(k, pa.int64()), longs(x)])
    return pa.table(
        {
            "a": pa.concat_arrays([longs(both[:, 0]), longs(five[0])]),
            "b": pa.concat_arrays([longs(both[:, 1]), pa.nulls(m, pa.int64())]),
            "region": filled(five[1]), "pivot": filled(five[2]), "n": filled(five[3]), "at": filled(five[4]),
        }
    )


def bitmap(points: DataFrame, spark: SparkSession) -> np.ndarray:
    """A table of fixed size that tells which points may be among these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BLOOM_BITS, bool)
        for batch in batches:
            bits[batch.column("fp").to_numpy().view(np.uint64) >> np.uint64(64 - BLOOM_BITS)] = True
        yield vector_blocks(np.packbits(bits))

    packed = vector_sum(points.mapInArrow(run, "block int, blob binary"), spark, "uint8", 1 << BLOOM_BITS - 3, np.bitwise_or)
    return np.unpackbits(packed).astype(bool)


def fetch_points(docs: DataFrame, wanted, columns: list[str]) -> DataFrame:
    """fp, n and ``classes`` or ``shingles`` of the points that may be wanted, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bits = set(), wanted.value
        for batch in slices(batches):
            out: dict[str, list] = {c: [] for c in ("fp", "n", *columns)}
            for s in document_sets(batch):
                if len(s) and (fp := point(s)) not in seen and bits[(fp & (1 << 64) - 1) >> 64 - BLOOM_BITS]:
                    seen.add(fp)
                    out["fp"].append(fp)
                    out["n"].append(len(s))
                    if "classes" in out:
                        classes = np.minimum(np.bincount((s % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES), 255)
                        out["classes"].append(classes.astype(np.uint8).tobytes())
                    if "shingles" in out:
                        out["shingles"].append(s.tobytes())
            if len(seen) > 100_000:
                seen.clear()
            if out["fp"]:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if c in ("fp", "n") else pa.binary()) for c, v in out.items()], names=list(out))

    found = docs.select("text").mapInArrow(run, "fp long, n long, " + ", ".join(f"{c} binary" for c in columns))
    return found.groupBy("fp").agg(*(F.first(c).alias(c) for c in ("n", *columns)))


def both_sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    own = lambda side: sets.select(F.col("fp").alias(side), F.col("n").alias(f"n{side}"), F.col(column).alias(f"x{side}"))
    return pairs.join(own("b"), "b").join(own("a"), "a")


def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose class counts allow a link."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, CLASSES) for c in ("xa", "xb"))
        ok = within(least_difference(x, y), batch.column("na").to_numpy() + batch.column("nb").to_numpy())
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, whether they are linked and their distance."""
    for batch in slices(batches):
        common = [
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist())
        ]
        i = np.array(common, np.int64)
        union = batch.column("na").to_numpy() + batch.column("nb").to_numpy() - i
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(DEN * i >= NUM * union), pa.array(1 - i / np.maximum(union, 1))], names=["a", "b", "linked", "distance"]
        )


def least_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The shingles in one of two sets alone, at least, by their class counts."""
    return np.abs(x.astype(np.int16) - y.astype(np.int16)).sum(1, dtype=np.int64)


def within(least: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether sets of ``n`` shingles together that differ in at least ``least`` can be linked."""
    # |x| + |y| - 2 i <= (|x| + |y|) (DEN - NUM) / (DEN + NUM) for a link
    return (DEN + NUM) * least <= (DEN - NUM) * n


def near_pivots(rows: pa.Table) -> pa.Table:
    """Pairs (a, b) of pivots with sets of other components that sizes, positions, distances and class counts do not exclude: for each pivot
    the first ``most`` in the order of the share that differs by class counts. A pivot that has more is a row (a, null, region)."""
    column = {c: rows.column(c).to_numpy() for c in ("fp", "root", "n", "at", "pivot", "most")}
    distance = rows.column("distance").to_numpy().astype(float)
    classes = np.frombuffer(b"".join(rows.column("classes").to_pylist()), np.uint8).reshape(-1, CLASSES)
    fp, n, at, root, most = (column[c] for c in ("fp", "n", "at", "root", "most"))
    sets, pairs, more = np.flatnonzero(~column["pivot"]), [np.empty((0, 2), np.int64)], []
    for q in np.flatnonzero(column["pivot"]):
        i, j = np.where(n[sets] <= n[q], sets, q), np.where(n[sets] <= n[q], q, sets)
        far = np.abs(distance[sets] - distance[q]) > (DEN - NUM) / DEN + 1e-9  # false where a distance is not known
        own = sets[(root[sets] != root[q]) & possible(n, at, i, j) & ~far]
        least, both = least_difference(classes[own], classes[q]), n[own] + n[q]
        ok = within(least, both)
        own, share = own[ok], least[ok] / both[ok]
        if len(own) > most[q]:
            own = own[np.lexsort((fp[own], share))[: most[q]]]
            more.append(fp[q])
        pairs.append(np.stack([np.minimum(fp[own], fp[q]), np.maximum(fp[own], fp[q])], 1))
    both, k = np.unique(np.concatenate(pairs), axis=0), len(more)
    longs = lambda x: pa.array(np.ascontiguousarray(x, np.int64), pa.int64())
    region = pa.concat_arrays([pa.nulls(len(both), pa.int64()), longs(np.full(k, rows.column("region")[0].as_py()))])
    return pa.table({"a": pa.concat_arrays([longs(both[:, 0]), longs(more)]), "b": pa.concat_arrays([longs(both[:, 1]), pa.nulls(k, pa.int64())]), "region": region})


def met_blocks() -> Column:
    """Blocks of its region that a pivot meets in this turn."""
    return (F.col("most") / FEW).cast("int")


class Join:
    """The state of one join: written tables by name."""

    def __init__(self, spark: SparkSession, docs: DataFrame):
        self.spark, self.docs, self.space, self.sets = spark, docs, Workspace(spark), None

    def points(self) -> DataFrame:
        """Every row's doc_id, n and fp; leaves the candidates written."""
        spark, space = self.spark, self.space
        read = space.save(read_sets(self.docs), "sets")
        counts = vector_sum(read.where(F.col("blob").isNotNull()).select("block", "blob"), spark, "int64", 1 << CELL_BITS)
        rows = read.where(F.col("blob").isNull()).select("doc_id", "n", "fp", "check")
        windows = rows.agg(F.sum(F.when(F.col("n") > 0, F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1)).alias("k")).first().k or 0
        shards = max(spark.sparkContext.defaultParallelism, -(-int(windows) // SHARD_ROWS))
        levels = spark.sparkContext.broadcast(order_levels(counts))
        splits = spark.sparkContext.broadcast(parts_of(counts))
        scattered = scatter(self.docs, levels, splits, shards)
        self.candidates = space.save(scattered.groupBy("shard").applyInArrow(lambda t: join_shard(t), CANDIDATES), "candidates")
        return rows

    def against_pivots(self, now: DataFrame) -> DataFrame:
        """Pairs of chosen pivots and sets of their regions that may be linked, and the pivots (a, null, region) that have more of them. A task
        holds a block of a region's sets and the region's pivots of this turn, each of about BLOCK_CELLS class counts. A pivot meets one block
        in its first turn, from its own hash on, and MORE times as many in each further one."""
        now = now.join(self.classes.select("fp", "classes"), "fp")
        own = [F.col(c) for c in ("region", "fp", "root", "n", "at", "distance", "classes", "most")]
        block = lambda step: F.pmod(F.pmod(F.xxhash64("fp"), F.col("blocks")) + step, F.col("blocks")).cast("int").alias("block")
        sets = now.select(*own, block(F.lit(0)), F.lit(False).alias("pivot"))
        met = now.where("chosen").withColumn("step", F.explode(F.sequence(F.lit(0), F.least("blocks", met_blocks()) - 1)))
        pivots = met.select(*own, block(F.col("step")), F.lit(True).alias("pivot"))
        return sets.unionByName(pivots).groupBy("region", "block").applyInArrow(lambda t: near_pivots(t), "a long, b long, region long").distinct()

    def measure(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs with whether they are linked and their distance; reads the shingles of sets that no earlier pair had."""
        points = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
        new = points if self.sets is None else self.space.save(points.join(self.sets.select("fp"), "fp", "left_anti"), f"new-{name}")
        if self.sets is None or not new.isEmpty():
            more = self.fetch(new, ["shingles"], f"sets-{name}")
            # what the table of points let pass besides may be there already
            self.sets = more if self.sets is None else self.sets.unionByName(more.join(new, "fp", "left_semi"))
        return self.space.save(both_sides(pairs, self.sets, "shingles").mapInArrow(measured, "a long, b long, linked boolean, distance double"), f"measured-{name}")

    def fetch(self, points: DataFrame, columns: list[str], name: str) -> DataFrame:
        shared = self.spark.sparkContext.broadcast(bitmap(points, self.spark))
        return self.space.save(fetch_points(self.docs, shared, columns), name)

    def links(self) -> DataFrame:
        """root of every point with a link."""
        space = self.space
        pairs = space.save(self.candidates.where(F.col("b").isNotNull()).select("a", "b").distinct(), "pairs")
        members = self.candidates.where(F.col("region").isNotNull()).select(F.col("a").alias("fp"), "region", "pivot", "n", "at")
        ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("fp"))
        self.classes = self.fetch(ends(pairs).unionByName(members.select("fp")).distinct(), ["classes"], "classes")
        kept = space.save(both_sides(pairs, self.classes, "classes").mapInArrow(bounded, "a long, b long"), "bounded")
        found = self.measure(kept, "0")
        edges = found.where("linked").select("a", "b")
        roots = components(edges, space, "roots-0")
        if members.isEmpty():
            return roots
        star = found.select("a", "b", "distance").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
        members = space.save(
            members.join(star.select(F.col("a").alias("pivot"), F.col("b").alias("fp"), "distance"), ["pivot", "fp"], "left").withColumns({"done": F.col("fp") == F.col("pivot"), "most": F.lit(FEW)}),
            "members-0",
        )
        turn = 0
        while True:
            turn += 1
            now = members.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
            parts = now.groupBy("region", "root").agg(
                F.count(F.lit(1)).alias("k"), F.count(F.when(~F.col("done"), 1)).alias("open")
            )
            main = parts.groupBy("region").agg(
                F.max_by(F.struct("root", "open"), F.struct("k", "root")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("open").alias("all_open"), F.sum("k").alias("sets")
            )
            rest = F.col("all_open") - F.col("main.open")
            left = main.where((F.col("parts") > 1) & (rest > 0)).select(
                "region",
                F.col("main.root").alias("main"),
                F.ceil(F.col("sets") * CLASSES / BLOCK_CELLS).cast("int").alias("blocks"),
                (F.lit(min(PIVOTS * MORE ** (turn - 1), max(1, BLOCK_CELLS // CLASSES))) / rest).alias("share"),
            )
            now = space.save(now.join(left, "region"), f"open-{turn}")  # regions that are done go
            if now.isEmpty():
                return roots
            chosen = ~F.col("done") & (F.col("root") != F.col("main")) & (F.pmod(F.xxhash64("fp", F.lit(turn)), F.lit(1 << 30)) < F.col("share") * (1 << 30))
            now = now.withColumn("chosen", chosen)
            near = space.save(self.against_pivots(now), f"near-{turn}")
            pairs = near.where(F.col("b").isNotNull()).select("a", "b")
            if not pairs.isEmpty():
                edges = edges.unionByName(self.measure(pairs, str(turn)).where("linked").select("a", "b"))
                roots = components(edges, space, f"roots-{turn}")
            more = near.where(F.col("b").isNull()).select("region", F.col("a").alias("fp"), F.lit(True).alias("more"))
            again = F.col("chosen") & (F.col("more").isNotNull() | (met_blocks() < F.col("blocks")))
            after = now.join(more, ["region", "fp"], "left").select(
                "region", "fp", "pivot", "n", "at", "distance",
                (F.col("done") | F.col("chosen") & ~again).alias("done"),
                F.when(again, F.least(F.col("most") * MORE, F.lit(1 << 26))).otherwise(F.col("most")).alias("most"),
            )
            members = space.save(after, f"members-{turn}")


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    join = Join(spark, docs)
    rows = join.points()
    alike = rows.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("k"), F.min("check").alias("low"), F.max("check").alias("high"))
    points = join.space.save(alike, "points")
    if found := points.where("low <> high").head():
        raise PointCollision(f"different sets have the point {found.fp}")
    roots = join.links()
    # a point that stands for one row without links is its own component, and so are rows without shingles
    linked = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").where("k > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "fp"))
    linked = join.space.save(linked.select("fp", "root", "k", "least"), "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("k"))
    by_point = join.space.save(joined_evenly(linked, join.space.save(least, "components"), "root", ["component_id"]), "by-point")
    by_point = by_point.select("fp", "k", F.struct("component_id").alias("found"))
    full = joined_evenly(rows, by_point, "fp", ["found"], "left")
    component = F.when(F.col("found").isNull(), F.col("doc_id")).otherwise(F.col("found.component_id"))
    return full.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def joined_evenly(rows: DataFrame, table_: DataFrame, key: str, columns: list[str], how: str = "inner") -> DataFrame:
    """Rows joined with a table that has each key once and, as k, its number of rows. Keys with more than a thousandth of the rows are at
    most a thousand and are broadcast, so that no task gets all rows of one; where there are few keys, all are."""
    own = [F.col(f"rows.{c}") for c in rows.columns]
    got = [F.col(f"found.{c}") for c in columns]
    met = F.col(f"rows.{key}") == F.col(f"found.{key}")
    few = table_.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    if few:
        return rows.alias("rows").join(F.broadcast(table_).alias("found"), met, how).select(*own, *got)
    most = rows.count()
    hot, rest = table_.where(F.col("k") * 1000 > most), table_.where(F.col("k") * 1000 <= most)
    first = rows.alias("rows").join(F.broadcast(hot).alias("found"), met).select(*own, *got)
    others = rows.alias("rows").join(F.broadcast(hot).alias("found"), met, "left_anti").select(*own)
    return first.unionByName(others.alias("rows").join(rest.alias("found"), met, how).select(*own, *got))


def without_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, of each component the one with the smallest id. A row whose id another row of a different
    text shares is dropped only if all rows of the id are to go; one without an id never."""
    ids = jaccard_components(spark, docs).where(F.col("doc_id").isNotNull())
    dropped = ids.groupBy("doc_id").agg(F.min((F.col("doc_id") != F.col("component_id")).cast("int")).alias("all")).where("all = 1").select("doc_id")
    return without_keys(docs, dropped, ["doc_id"])


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op6_jaccard_join": op6_jaccard_join}
ORACLES: dict[str, str] = {}
