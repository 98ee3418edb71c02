"""Helpers shared by the training-data operators: shared-folder materialisation, fixed-size sums, tokens."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import shared_folder

#: Keys that are broadcast to leave rows out; more of them meet the rows in a join.
BROADCAST_KEYS = 500_000
FILTER_BITS = 27
KEY_HASH = "_shredline_key_hash"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch between the JVM and Python. Both sides hold several copies of each task's batch.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_BYTES, so that tasks' memory doesn't depend on the texts' lengths."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", spark.conf.get(key, "67108864"))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


class Workspace:
    """Written intermediate tables in the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        small_batches(spark)
        self.root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z; null to the empty string."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, LOWER)


def without_keys(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose key is not among the distinct ``keys``; null keys are equal. Few keys are broadcast, so that rows do not move. Of many,
    a filter of fixed size lets the rows pass that have none, and only the others are shuffled."""
    spark = rows.sparkSession
    keys = Workspace(spark).save(keys.withColumn(KEY_HASH, F.xxhash64(*columns)), "keys")
    n = keys.count()
    if n == 0:
        return rows
    if n <= BROADCAST_KEYS:
        keys, met = F.broadcast(keys), rows.withColumn(KEY_HASH, F.xxhash64(*columns))
        return leave_out(met, keys, columns).select(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[batch.column(KEY_HASH).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
        yield vector_blocks(np.packbits(bits))

    packed = vector_sum(keys.select(KEY_HASH).mapInArrow(run, "block int, blob binary"), spark, "uint8", 1 << FILTER_BITS - 3, np.bitwise_or)
    shared = spark.sparkContext.broadcast(np.unpackbits(packed).astype(bool))
    met = rows.withColumn(KEY_HASH, F.xxhash64(*columns))

    def among(wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = shared.value[batch.column(KEY_HASH).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)]
                yield batch.filter(pa.array(hit == wanted))

        return met.mapInArrow(run, met.schema)

    return among(False).unionByName(leave_out(among(True), keys, columns)).select(rows.columns)


def leave_out(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    met = F.col(f"l.{KEY_HASH}") == F.col(f"r.{KEY_HASH}")
    for c in columns:
        met = met & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return rows.alias("l").join(keys.alias("r"), met, "left_anti")


def crc_mod(doc_id: Column, m: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(m))


def lowest(rows: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The n rows whose key hashes lowest. Of many more rows only those below a hash that about 2 n rows have are sorted, so no task or
    driver gets a share of every partition."""
    total = rows.count()
    place = F.pmod(F.xxhash64(*columns), F.lit(1 << 48))
    if total > 4 * n:
        rows = rows.where(place < F.lit(2 * n * (1 << 48) // total))
    return rows.orderBy(place, *columns).limit(n)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null becomes empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that a Python worker's memory stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def even_keys(spark: SparkSession, n: int) -> np.ndarray:
    """``n`` int keys that Spark's hash partitioning deals evenly to ``spark.sql.shuffle.partitions``, so that no task gets several large groups
    where another has none. Beyond 2**18 keys the numbers themselves, whose partitions are even by their number."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if n > 1 << 18:
        return np.arange(n)
    each = -(-n // parts)
    ids = np.arange(parts * (2 * each + 24), dtype=np.uint32)
    turn = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    h = turn(ids * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)  # Murmur3 of an int with seed 42, as Spark partitions
    h = turn(h ^ np.uint32(42), 13) * np.uint32(5) + np.uint32(0xE6546B64) ^ np.uint32(4)
    for r, m in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ (h >> np.uint32(r))) * np.uint32(m)
    part = h.view(np.int32).astype(np.int64) % parts
    order = np.argsort(part, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids)) - np.searchsorted(part[order], part[order])
    return ids[np.lexsort((part, rank))][:n].astype(np.int64)


MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 (murmur-style)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; none is 0."""
    from xxhash import xxh3_64_intdigest

    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    h[h == 0] = 1
    return h


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width``-word windows, in order; a shorter text is one window; no words, none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(width, n)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ words[i : n - k + 1 + i]) * MIX
        out ^= out >> np.uint64(29)
    return mix64(out)


def closed(vector: np.ndarray) -> bytes:
    """Compressed bytes of a vector, byte planes apart."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(vector.view(np.uint8).reshape(len(vector), -1).T.tobytes())


def opened(blob: bytes, dtype: str) -> np.ndarray:
    import zstandard

    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(body.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def squeeze(*columns: np.ndarray) -> bytes:
    """Columns of one length as compressed bytes, byte planes apart."""
    import zstandard

    body = np.concatenate([np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.ravel() for c in columns])
    return zstandard.ZstdCompressor(level=1).compress(body.tobytes())


def expand(blob: bytes, *kinds: type) -> list[np.ndarray]:
    import zstandard

    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(body) // sum(sizes), 0, []
    for k, s in zip(kinds, sizes):
        out.append(np.ascontiguousarray(body[at : at + n * s].reshape(s, n).T).view(k).ravel())
        at += n * s
    return out


def vector_sum(partials: DataFrame, spark: SparkSession, dtype: str, length: int, combine=np.add) -> np.ndarray:
    """Sum of rows (block int, blob binary) into one vector of ``length``: blocks are summed on the executors,
    and the driver receives one vector of that fixed size."""

    def add(rows: pa.Table) -> pa.Table:
        total = None
        for blob in rows.column("blob").to_pylist():
            part = opened(blob, dtype)
            total = part.copy() if total is None else combine(total, part)
        return pa.table({"block": rows.column("block").slice(0, 1), "blob": pa.array([closed(total)], pa.binary())})

    # two levels: no task sums more than a share of the partial vectors
    salted = partials.select("block", "blob", F.pmod(F.xxhash64("blob"), F.lit(16)).alias("salt"))

    halves = salted.groupBy("block", "salt").applyInArrow(lambda t: add(t), "block int, blob binary")
    done = halves.groupBy("block").applyInArrow(add, "block int, blob binary").collect()
    if not done:
        return np.zeros(length, dtype)
    return np.concatenate([opened(r.blob, dtype) for r in sorted(done, key=lambda r: r.block)])


def vector_blocks(vector: np.ndarray, blocks: int = 16) -> pa.RecordBatch:
    parts = np.array_split(vector, blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(blocks), pa.int32()), pa.array([closed(p) for p in parts], pa.binary())], names=["block", "blob"]
    )
