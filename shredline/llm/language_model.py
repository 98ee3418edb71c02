"""Language-model scoring by an Elias-Fano trie of 3-grams.

Tokens are the words of the lower-cased text (A-Z only) and one end token. A text is preceded by two start marks, which
are contexts only. Probabilities are Witten-Bell interpolated: a context seen c times with t different followers gives
``(count + t * shorter) / (c + t)``, where ``shorter`` is the probability in the shorter context and the shortest is
``(count + 1) / (N + V + 1)``.

*Vocabulary.* Training texts are counted in batches that aggregate before they shuffle. Vocabulary shards hold ranges of
word hashes, as many as the size of the texts asks for: an Elias-Fano sequence of the hashes, whose ranks are the word ids, and counts.

*Trie.* Its shards hold ranges of middle words, cut so that each has about ``SHARD_TOKENS`` tokens; a middle word with more is cut by
ranges of the word before it. In a shard a word has its followers (keys word * W + follower), its predecessors (word * (W + 1) +
predecessor), and for each predecessor the followers seen after both, not as words but as ranks among the word's own followers, so that
the last level is small. The followers of a word that is cut are counted first, in shards of their own. All are Elias-Fano sequences with
monotone pointers; log probabilities and back-off weights are quantised to 16 bits.

*Scoring.* Texts are read once more, for all of this: each batch deals its distinct 3-grams, their training counts and the documents that
have them to the shards' tasks. A task builds its shard, writes and maps it, looks up each distinct 3-gram once by successor search, and
returns sums by document, which are added up. So a shard is read by one task, and a task holds one shard. Files are written
under a temporary name and moved, so a repeated task is harmless. Batches are known by partition and place, so the input has to
read the same again where a task is repeated, as files do; other inputs are to be written first.

Defined cases: null, empty and blank texts are the end token alone; repeated rows count and are scored each; a very long text is one batch;
equal words are one whatever their number; a null ``doc_id`` is trained on; with no training rows every probability is
``1 / (0 + 0 + 1)``; no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, crc_mod, even_keys, expand, slices, squeeze, table, texts, word_hashes
from .elias_fano import EliasFano, pack, unpack

FOLDS, HELD_OUT = 7, 2
#: Bytes of text for each vocabulary shard, of which there are a power of two and 16 at least.
VOCABULARY_BYTES = 64 << 20
SHARD_TOKENS = 1_500_000
BATCH_TOKENS = 1_500_000
END = np.uint64(0)  # hash of the end token
U64 = np.uint64


class SharedFolder:
    """Files in the shared folder, mapped where it is mounted and read where it is not."""

    def __init__(self, root: str):
        self.root = root if "://" in root or root.startswith("file:") else f"file://{root}"

    def _open(self):
        from pyarrow import fs

        root = "file://" + self.root[5:] if self.root.startswith("file:/") and not self.root.startswith("file://") else self.root
        return fs.FileSystem.from_uri(root)

    def write(self, name: str, block: bytes) -> None:
        system, path = self._open()
        system.create_dir(path, recursive=True)
        part = f"{path}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(part) as out:
            out.write(block)
        system.move(part, f"{path}/{name}")

    def remove(self, name: str) -> None:
        system, path = self._open()
        system.delete_file(f"{path}/{name}")

    def read(self, name: str) -> dict[str, np.ndarray]:
        from pyarrow import fs

        system, path = self._open()
        if isinstance(system, fs.LocalFileSystem):
            return unpack(np.memmap(f"{path}/{name}", np.uint8, "r"))
        with system.open_input_file(f"{path}/{name}") as f:
            return unpack(np.frombuffer(f.read(), np.uint8))


def token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, np.ndarray, np.ndarray]]:
    """doc_ids, whether they are held out, token hashes with the end tokens, and tokens by document, for batches of about BATCH_TOKENS."""
    ids, held, parts, sizes, total = [], [], [], [], 0
    for batch in slices(batches, 256):
        for i, h, t in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts(batch)):
            words = word_hashes(t.lower().split())
            ids.append(i)
            held.append(h)
            parts += [words, np.array([END])]
            sizes.append(len(words) + 1)
            total += len(words) + 1
            if total >= BATCH_TOKENS:
                yield ids, held, np.concatenate(parts), np.array(sizes)
                ids, held, parts, sizes, total = [], [], [], [], 0
    if ids:
        yield ids, held, np.concatenate(parts), np.array(sizes)


def count_words(train: DataFrame, bits: int) -> DataFrame:
    """shard, blob: distinct word hashes and their counts in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, tokens, _ in token_batches(batches):
            words, counts = np.unique(tokens, return_counts=True)
            cuts = np.searchsorted(words >> U64(64 - bits), np.arange((1 << bits) + 1).astype(U64))
            full = np.flatnonzero(np.diff(cuts))
            blobs = [squeeze(words[cuts[k] : cuts[k + 1]], counts[cuts[k] : cuts[k + 1]].astype(np.uint32)) for k in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])

    return train.mapInArrow(run, "shard int, blob binary")


def merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def build_vocabulary(blobs: DataFrame, folder: SharedFolder, bits: int) -> DataFrame:
    """Writes a file for each shard; returns shard, words, tokens, cuts: where ranges of SHARD_TOKENS tokens begin, and the words with
    more tokens than that, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, parts, held = np.empty(0, U64), np.empty(0, np.int64), [], 0
        for batch in batches:
            for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("blob").to_pylist()):
                parts.append(expand(blob, U64, np.uint32))
                held += len(parts[-1][0])
                if held > 2_000_000:
                    words, counts = merge(np.concatenate([words, *(w for w, _ in parts)]), np.concatenate([counts, *(c for _, c in parts)]))
                    parts, held = [], 0
        words, counts = merge(np.concatenate([words, *(w for w, _ in parts)]), np.concatenate([counts, *(c for _, c in parts)]).astype(np.int64))
        folder.write(f"words-{shard}", pack({**EliasFano.build(words - U64(shard << (64 - bits)), 1 << (64 - bits), "hash"), "count": counts}))
        run_ = (np.cumsum(counts) - counts) // SHARD_TOKENS
        hot = np.flatnonzero((counts > SHARD_TOKENS) & (words != END))
        cuts = np.unique(np.concatenate([np.flatnonzero(np.concatenate([[True], run_[1:] != run_[:-1]])), hot, hot + 1]))
        row = {"shard": shard, "words": len(words), "tokens": int(counts.sum()), "cuts": cuts.tolist(), "hot": hot.tolist(), "hot_counts": counts[hot].tolist()}
        yield pa.RecordBatch.from_pylist([row], VOCABULARY)

    return blobs.groupBy("shard").applyInArrow(run, "shard int, words long, tokens long, cuts array<long>, hot array<long>, hot_counts array<long>")


VOCABULARY = pa.schema([("shard", pa.int32()), ("words", pa.int64()), ("tokens", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("cuts", "hot", "hot_counts"))])


class Vocabulary:
    """Word ids and counts from the mapped shards."""

    def __init__(self, folder: SharedFolder, sizes: list[int], tokens: int, bits: int):
        self.bits = bits
        self.folder, self.bases = folder, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.size, self.tokens = int(self.bases[-1]), tokens

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(hashes >> U64(64 - self.bits), np.arange((1 << self.bits) + 1).astype(U64))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b and self.bases[k] < self.bases[k + 1]:
                shard = self.folder.read(f"words-{k}")
                at, known = EliasFano(shard, "hash").successor(hashes[a:b] - U64(k << (64 - self.bits)))
                ids[a:b][known] = at[known] + self.bases[k]
                counts[a:b][known] = shard["count"][at[known]]
        return ids, counts

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of sorted ids."""
        out = np.empty(len(ids), np.int64)
        cuts = np.searchsorted(ids, self.bases)
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                out[a:b] = self.folder.read(f"words-{k}")["count"][ids[a:b] - self.bases[k]]
        return out

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.size + 1))


def grams(ids: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token and the one before that; ``start`` before a text."""
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    one = np.concatenate([[start], ids[:-1]])
    two = np.concatenate([[start, start], ids[:-2]])[: len(ids)]
    one[first] = start
    two[first] = start
    second = first[sizes > 1] + 1
    two[second] = start
    return one, two


class Ranges:
    """How 3-grams are dealt to shards: by ranges of the middle word, and those of a hot one by ranges of the word before."""

    def __init__(self, bounds: np.ndarray, hot: dict[int, int]):
        self.bounds = bounds  # first middle word of each range, and the end
        self.hot = hot  # middle words that are cut, with their counts
        parts = np.ones(max(0, len(bounds) - 1), np.int64)
        self.inner: dict[int, np.ndarray] = {}  # by range, where its parts begin
        for v, n in hot.items():
            r = int(np.searchsorted(bounds, v, "right")) - 1
            k = min(-(-n // SHARD_TOKENS), len(bounds) - 1)
            self.inner[r] = np.unique(bounds[:-1][np.arange(k) * (len(bounds) - 1) // k])
            self.inner[r][0] = -1
            parts[r] = len(self.inner[r])
        self.first = np.concatenate([[0], np.cumsum(parts)])
        self.shards = int(self.first[-1])

    def of(self, v: np.ndarray, inner: np.ndarray) -> np.ndarray:
        """The shards of middle words with the words before them, -1 for unknown middle words."""
        r = np.searchsorted(self.bounds, v, "right") - 1
        out = np.where((v >= 0) & (r < len(self.first) - 1), self.first[np.clip(r, 0, len(self.first) - 1)], -1)
        for k, begin in self.inner.items():
            own = np.flatnonzero(r == k)
            out[own] += np.searchsorted(begin, inner[own], "right") - 1
        return out

    def range_of(self, shard: int) -> int:
        return int(np.searchsorted(self.first, shard, "right")) - 1


def distinct_followers(docs: DataFrame, vocabulary: Vocabulary, ranges: Ranges) -> DataFrame:
    """shard, blob: followers of the hot words in the training texts of a batch, and their counts, dealt by ranges of the follower."""
    hot = np.array(sorted(ranges.hot), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, tokens, sizes in token_batches(batches):
            words, back = np.unique(tokens, return_inverse=True)
            w = vocabulary.find(words)[0][back]
            v = grams(w, sizes, vocabulary.size)[0]
            own = np.flatnonzero(np.isin(v, hot))
            keys, counts = np.unique(np.searchsorted(hot, v[own]) * (vocabulary.size + 1) + w[own], return_counts=True)
            v, w = hot[keys // (vocabulary.size + 1)], keys % (vocabulary.size + 1)
            shard = ranges.of(v, w)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else np.zeros(1, np.int64)
            blobs = [squeeze(w[a:b], counts[a:b].astype(np.uint32)) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(shard[cuts[:-1]], pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])

    return docs.where("NOT held_out").mapInArrow(run, "shard int, blob binary")


class Followers:
    """The followers of a hot word: a file for each range of them."""

    def __init__(self, folder: SharedFolder, ranges: Ranges, shard: int, stats: dict[int, tuple[int, int]]):
        r = ranges.range_of(shard)
        self.folder, self.begin, self.first = folder, ranges.inner[r], int(ranges.first[r])
        self.count, self.kinds = stats[r]

    def log_probability(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 p of sorted followers, and which of them are known; the others' is not set."""
        out, known = np.zeros(len(w)), np.zeros(len(w), bool)
        part = np.searchsorted(self.begin, w, "right") - 1
        for k in np.unique(part[w >= 0]):
            own = np.flatnonzero((part == k) & (w >= 0))
            arrays = self.folder.read(f"followers-{self.first + k}")
            at, same = EliasFano(arrays, "follower").successor(w[own].astype(U64))
            known[own] = same
            out[own[same]] = arrays["p2"][at[same]] * -float(arrays["p2.step"][0])
        return out, known

    @property
    def back_off(self) -> float:
        return float(np.log10(self.kinds / (self.count + self.kinds))) if self.kinds else 0.0


def build_followers(spark: SparkSession, blobs: DataFrame, vocabulary: Vocabulary, ranges: Ranges, folder: SharedFolder, space: Workspace) -> dict[int, tuple[int, int]]:
    """Writes the followers of the hot words; for each range its tokens and its different followers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, parts, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0
        for batch in batches:
            for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("blob").to_pylist()):
                parts.append(expand(blob, np.int64, np.uint32))
                held += len(parts[-1][0])
                if held > 2_000_000:
                    words, counts = merge(np.concatenate([words, *(w for w, _ in parts)]), np.concatenate([counts, *(c for _, c in parts)]))
                    parts, held = [], 0
        words, counts = merge(np.concatenate([words, *(w for w, _ in parts)]), np.concatenate([counts, *(c for _, c in parts)]).astype(np.int64))
        folder.write(f"counted-{shard}", pack({"word": words, "count": counts}))
        yield pa.RecordBatch.from_pylist([{"shard": shard, "kinds": len(words), "tokens": int(counts.sum())}], pa.schema([("shard", pa.int32()), ("kinds", pa.int64()), ("tokens", pa.int64())]))

    done = space.save(blobs.groupBy("shard").applyInArrow(run, "shard int, kinds long, tokens long"), "counted").collect()  # a small row for each SHARD_TOKENS tokens
    stats = {r: (0, 0) for r in ranges.inner}
    for row in done:
        c, t = stats[ranges.range_of(row.shard)]
        stats[ranges.range_of(row.shard)] = c + row.tokens, t + row.kinds

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                arrays = folder.read(f"counted-{shard}")
                c, t = stats[ranges.range_of(shard)]
                base = 10 ** vocabulary.log_base(vocabulary.counts(arrays["word"]))
                levels = {**EliasFano.build(arrays["word"].astype(U64), vocabulary.size + 1, "follower"), **quantised(np.log10((arrays["count"] + t * base) / (c + t)), "p2")}
                folder.write(f"followers-{shard}", pack(levels))
            yield batch

    shards = [r.shard for r in done]
    rest = sorted(set(k for r in ranges.inner for k in range(int(ranges.first[r]), int(ranges.first[r + 1]))) - set(shards))
    for shard in rest:  # ranges without followers
        folder.write(f"counted-{shard}", pack({"word": np.empty(0, np.int64), "count": np.empty(0, np.int64)}))
    every = spark.createDataFrame([(k,) for k in [*shards, *rest]], "shard int").repartition(max(1, len(shards)), "shard")
    space.save(every.mapInArrow(finish, "shard int"), "followers")
    return stats


def deal(docs: DataFrame, vocabulary: Vocabulary, ranges: Ranges) -> DataFrame:
    """For each batch and shard, the batch's distinct 3-grams with training counts, and the documents that have them; and for
    each batch what is known of its documents without the trie."""
    start, shards = vocabulary.size, ranges.shards
    tasks = even_keys(docs.sparkSession, 2 * max(1, shards))
    kind = np.uint32 if start < 2**32 - 2 else np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, (ids, held, tokens, sizes) in enumerate(token_batches(batches)):
            words, back = np.unique(tokens, return_inverse=True)
            word_id, counts = vocabulary.find(words)
            w, base, known = word_id[back], vocabulary.log_base(counts)[back], (counts > 0)[back]
            v, u = grams(w, sizes, start)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            train = ~np.repeat(np.array(held, bool), sizes)
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            info = {
                "doc_id": [i or 0 for i in ids], "no_id": [i is None for i in ids], "n_tokens": sizes, "n_known": np.add.reduceat(known.astype(np.int64), first),
                "base": np.add.reduceat(base, first), "sum": np.bincount(doc, np.where(v < 0, base, 0.0), len(sizes)),
            }
            uid = task << 32 | number
            blob = pack({k: np.asarray(x) for k, x in info.items()})
            rows = [{"group": shards + uid % max(1, shards), "batch": uid, "info": blob}]
            order = sorting(v, u, start, w)
            order = order[v[order] >= 0]
            u, v, w, doc, train = u[order], v[order], w[order], doc[order], train[order]
            new = np.concatenate([[True], (w[1:] != w[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])])[: len(w)]
            gram = np.flatnonzero(new)
            pair = np.flatnonzero(new | np.concatenate([[True], doc[1:] != doc[:-1]])[: len(w)])  # a 3-gram and a document
            times = np.diff(np.concatenate([pair, [len(w)]])).astype(np.uint32)
            n = np.add.reduceat(train.astype(np.int64), gram).astype(np.uint32) if len(gram) else np.empty(0, np.uint32)
            docs_of = np.diff(np.concatenate([np.searchsorted(pair, gram), [len(pair)]])).astype(np.uint32)
            shard = ranges.of(v[gram], u[gram])
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else np.zeros(1, np.int64)
            ends = np.concatenate([[0], np.cumsum(docs_of, dtype=np.int64)])
            gu, gv, gw = ((x[gram] + 1).astype(kind) for x in (u, v, w))
            doc = doc[pair].astype(np.uint32)
            for a, b in zip(cuts, cuts[1:]):
                own = slice(ends[a], ends[b])
                rows.append({"group": int(shard[a]), "batch": uid, "grams": squeeze(gv[a:b], gu[a:b], gw[a:b], n[a:b], docs_of[a:b]), "docs": squeeze(doc[own], times[own])})
            for row in rows:
                yield pa.RecordBatch.from_pylist([{**row, "task": int(tasks[row["group"]])}], DEALT)

    return docs.mapInArrow(run, "task int, group int, batch long, info binary, grams binary, docs binary")


DEALT = pa.schema([("task", pa.int32()), ("group", pa.int32()), ("batch", pa.int64()), ("info", pa.binary()), ("grams", pa.binary()), ("docs", pa.binary())])
SUMS = pa.schema([("batch", pa.int64()), ("info", pa.binary()), ("sums", pa.binary())])


def quantised(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """16-bit codes of values at or below zero."""
    most = max(1e-9, float(-values.min()) if len(values) else 0.0)
    return {name: np.rint(-values * (65535 / most)).astype(np.uint16), f"{name}.step": np.array([most / 65535])}


def sorting(v: np.ndarray, u: np.ndarray, wide: int, w: np.ndarray | None = None) -> np.ndarray:
    """The order by v, u and w; ids are -1 to ``wide``."""
    keys = (v * (wide + 2) + u,) if wide < 1 << 31 else (u, v)
    if w is None and len(keys) == 1:
        return np.argsort(keys[0])
    return np.lexsort(keys if w is None else (w, *keys))


def merge_grams(parts: list[tuple[np.ndarray, ...]], wide: int) -> tuple[np.ndarray, ...]:
    """Distinct 3-grams sorted by v, u and w, the sums of their counts, and where each of the parts' is."""
    v, u, w, n = (np.concatenate([p[i] for p in parts]) for i in range(4))
    order = sorting(v, u, wide, w)
    v, u, w, n = v[order], u[order], w[order], n[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (u[1:] != u[:-1]) | (w[1:] != w[:-1])])
    first = np.flatnonzero(new)
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return v[first], u[first], w[first], np.add.reduceat(n, first), at


def build_shard(v: np.ndarray, u: np.ndarray, w: np.ndarray, n: np.ndarray, low: int, high: int, vocabulary: Vocabulary, followers: Followers | None = None) -> dict[str, np.ndarray]:
    """Arrays of the trie of the middle words ``low`` to ``high`` from distinct 3-grams sorted by (v, u, w). ``followers`` are those of
    a hot word, of which the 3-grams are only a part."""
    wide, start = vocabulary.size, vocabulary.size
    v = v - low
    context = np.concatenate([[True], (v[1:] != v[:-1]) | (u[1:] != u[:-1])])
    node = np.cumsum(context) - 1
    c_uv, t_uv = np.bincount(node, n), np.bincount(node)
    as_keys = lambda x: x.astype(U64)
    if followers is None:
        key2, back = np.unique(v * wide + w, return_inverse=True)
        c2 = np.bincount(back, n).astype(np.int64)
        parent = key2 // wide
        pointers = np.searchsorted(parent, np.arange(high - low + 1))
        t = np.diff(pointers)
        c1 = np.bincount(parent, c2, high - low)
        distinct, which = np.unique(key2 % wide, return_inverse=True)
        base = 10 ** vocabulary.log_base(vocabulary.counts(distinct))[which]
        p2 = (c2 + t[parent] * base) / (c1 + t)[parent]
        with np.errstate(divide="ignore", invalid="ignore"):
            back1 = np.where(t > 0, np.log10(t / (c1 + t)), 0.0)
        shorter, rank = p2[back], back - pointers[v]
        own = {
            **EliasFano.build(as_keys(pointers), len(key2) + 1, "pointers"),
            **EliasFano.build(as_keys(key2), (high - low) * wide + 1, "followers"),
            **quantised(np.log10(p2), "p2"),
            **quantised(back1, "b1"),
        }
    else:
        distinct, which = np.unique(w, return_inverse=True)
        shorter, rank, own = (10 ** followers.log_probability(distinct)[0])[which], w, {}
    ranks = int(rank.max()) + 1
    p3 = (n + t_uv[node] * shorter) / (c_uv + t_uv)[node]
    return {
        "shape": np.array([low, high, wide, ranks], np.int64),
        **own,
        **EliasFano.build(as_keys(v[context] * (start + 1) + u[context]), (high - low) * (start + 1) + 1, "predecessors"),
        **EliasFano.build(as_keys(node * ranks + rank), len(c_uv) * ranks + 1, "third"),
        **quantised(np.log10(p3), "p3"),
        **quantised(np.log10(t_uv / (c_uv + t_uv)), "b2"),
    }


def add_up(blobs: list[bytes], n: int) -> np.ndarray:
    out = np.zeros(n)
    for blob in blobs:
        at, sums = expand(blob, np.uint32, np.float64)
        out[at] += sums
    return out


def score_shards(dealt: DataFrame, vocabulary: Vocabulary, ranges: Ranges, stats: dict[int, tuple[int, int]], folder: SharedFolder, keep: bool) -> DataFrame:
    """batch, info, sums: builds each shard, and sums the log probabilities of its 3-grams by batch and document. Files that are
    not kept have a name of the attempt's own and go when it has read them."""
    kind = np.uint32 if vocabulary.size < 2**32 - 2 else np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        shard = rows[0]["group"]
        if shard >= ranges.shards:
            for r in rows:
                yield pa.RecordBatch.from_pylist([{"batch": r["batch"], "info": r["info"]}], SUMS)
            return
        parts = [expand(r["grams"], kind, kind, kind, np.uint32, np.uint32) for r in rows]
        v, u, w, n, at = merge_grams([(*(x.astype(np.int64) - 1 for x in p[:3]), p[3].astype(np.int64)) for p in parts], vocabulary.size)
        sizes, docs_of = [len(p[0]) for p in parts], [p[4] for p in parts]
        del parts
        r = ranges.range_of(shard)
        low, high = int(ranges.bounds[r]), int(ranges.bounds[r + 1])
        followers = Followers(folder, ranges, shard, stats) if r in ranges.inner else None
        seen = n > 0
        words, back = np.unique(w, return_inverse=True)
        counts = np.zeros(len(words), np.int64)
        counts[words >= 0] = vocabulary.counts(words[words >= 0])
        score = vocabulary.log_base(counts)[back]
        if seen.any():
            name = f"trie-{shard}" if keep else f"trie-{shard}-{uuid.uuid4().hex}"
            folder.write(name, pack(build_shard(v[seen], u[seen], w[seen], n[seen], low, high, vocabulary, followers)))
            score = Trie(folder.read(name), followers).log_probability(u, v, w, score)
            if not keep:
                folder.remove(name)
        elif followers is not None:
            score = after_hot_word(followers, w, score)
        del u, v, w, n, seen, back
        begin = 0
        for row, size, d in zip(rows, sizes, docs_of):
            doc, times = expand(row["docs"], np.uint32, np.uint32)
            sums = np.bincount(doc, np.repeat(score[at[begin : begin + size]], d) * times)
            begin += size
            some = np.flatnonzero(np.bincount(doc))
            yield pa.RecordBatch.from_pylist([{"batch": row["batch"], "sums": squeeze(some.astype(np.uint32), sums[some])}], SUMS)

    return dealt.groupBy("task").applyInArrow(run, "batch long, info binary, sums binary")


def after_hot_word(followers: Followers, w: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Log probabilities after a hot word in contexts that no training text has."""
    words, back = np.unique(w, return_inverse=True)
    p, known = followers.log_probability(words)
    return np.where(known[back], p[back], followers.back_off + base)


class Trie:
    """A mapped shard."""

    def __init__(self, arrays: dict[str, np.ndarray], hot: Followers | None = None):
        self.arrays, self.hot = arrays, hot
        self.low, self.high, self.wide, self.ranks = (int(x) for x in arrays["shape"])
        self.predecessors, self.third = (EliasFano(arrays, k) for k in ("predecessors", "third"))
        if hot is None:
            self.pointers, self.followers = (EliasFano(arrays, k) for k in ("pointers", "followers"))

    def value(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.arrays[name][at] * -float(self.arrays[f"{name}.step"][0])

    def shorter(self, v: np.ndarray, w: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 p(w | v), whether w was seen after v, and its rank."""
        if self.hot is not None:
            words, back = np.unique(w, return_inverse=True)
            known = self.hot.log_probability(words)[1][back]
            return after_hot_word(self.hot, w, base), known, np.maximum(w, 0)
        pairs, first, back = np.unique(v * (self.wide + 2) + w + 1, return_index=True, return_inverse=True)
        pv, pw = v[first], w[first]
        at, seen = self.followers.successor((pv * self.wide + np.maximum(pw, 0)).astype(U64))
        seen &= pw >= 0
        rank, out = np.zeros(len(pairs), np.int64), np.empty(len(pairs))
        rank[seen] = at[seen] - self.pointers.access(pv[seen]).astype(np.int64)
        out[seen] = self.value("p2", at[seen])
        out[~seen] = self.value("b1", pv[~seen]) + base[first][~seen]
        return out[back], seen[back], rank[back]

    def log_probability(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, base: np.ndarray) -> np.ndarray:
        """log10 p(w | u v) of n-grams whose v is known and in the shard's range; -1 for unknown u or w. Sorted by v and u."""
        v = v - self.low
        out, hit, rank = self.shorter(v, w, base)
        context = v * (self.wide + 2) + u + 1
        new = np.concatenate([[True], context[1:] != context[:-1]])
        which = np.cumsum(new) - 1
        cu = u[new]
        node, known = self.predecessors.successor((v[new] * (self.wide + 1) + np.maximum(cu, 0)).astype(U64))
        known &= cu >= 0
        node, known = node[which], known[which]
        third = np.flatnonzero(known & hit & (rank < self.ranks))
        at, found = self.third.successor((node[third] * self.ranks + rank[third]).astype(U64))
        full = third[found]
        known[full] = False
        out[full] = self.value("p3", at[found])
        rest = np.flatnonzero(known)
        out[rest] += self.value("b2", node[rest])
        return out


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def language_model_scores(spark: SparkSession, docs: DataFrame, keep_model: bool = True) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. The model's files stay in the shared
    folder if they are to be kept; else a shard's go with the task that has read them."""
    space = Workspace(spark)
    folder = SharedFolder(f"{space.root}/model")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out)
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    bits = max(4, (size // VOCABULARY_BYTES).bit_length())
    # one small row for each shard, and a cut for each SHARD_TOKENS tokens
    shards = {r.shard: r for r in space.save(build_vocabulary(count_words(docs.where("NOT held_out"), bits), folder, bits), "words").collect()}
    vocabulary = Vocabulary(folder, [shards[k].words if k in shards else 0 for k in range(1 << bits)], sum(r.tokens for r in shards.values()), bits)
    base = {k: int(vocabulary.bases[k]) for k in shards}
    cuts = [base[k] + c for k, r in shards.items() for c in r.cuts]
    hot = {base[k] + v: n for k, r in shards.items() for v, n in zip(r.hot, r.hot_counts)}
    bounds = np.array(sorted({0, *cuts, vocabulary.size, vocabulary.size + 1}), np.int64) if vocabulary.size else np.zeros(1, np.int64)
    ranges = Ranges(bounds, hot)
    stats = build_followers(spark, distinct_followers(docs, vocabulary, ranges), vocabulary, ranges, folder, space) if hot else {}
    scored = score_shards(deal(docs, vocabulary, ranges), vocabulary, ranges, stats, folder, keep_model)
    tokens = vocabulary.tokens

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info, sums = None, []
        for batch in batches:
            for i, x in zip(batch.column("info").to_pylist(), batch.column("sums").to_pylist()):
                info = i or info
                sums += [x] if x else []
        info = unpack(np.frombuffer(info, np.uint8))
        n = len(info["n_tokens"])
        ids = pa.array(info["doc_id"].astype(np.int64), mask=info["no_id"].astype(bool))
        columns = [ids, info["n_tokens"], info["n_known"], np.full(n, tokens, np.int64), info["base"], info["sum"] + add_up(sums, n)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in SCORES.split(", ")])

    out = scored.groupBy("batch").applyInArrow(finish, SCORES)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(spark, table(spark, sf_dir, "documents"), keep_model=False)


QUERIES = {"op8_language_model": op8_language_model}
ORACLES: dict[str, str] = {}
