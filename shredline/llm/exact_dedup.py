"""Exact deduplication by content-defined chunk recipes, with DataFrame functions only.

Each normalised text (A-Z lower-cased, null as empty) is cut after the first sentence end or line break that
follows ``MIN_CHUNK`` characters (``MAX_CHUNK`` at most), so a cut depends on the content near it alone. A chunk
becomes a 64-bit weak hash and its SHA-256. The chunk dictionary pre-aggregates by weak hash and verifies it: a weak
hash seen with one SHA-256 only is an identifier; one seen with more is not, and its chunks are then told apart by
their SHA-256. Documents are equal when their ordered identifier lists are. Texts never move: a shuffle carries
40 bytes a chunk for the dictionary and 8 bytes a chunk for the lists.

Defined cases: null and empty texts are equal (the empty list); of equal texts the largest ``doc_id`` stays; rows
that repeat a ``doc_id`` are each returned and counted, and all of them are kept if their id is the largest; a null
``doc_id`` never is a ``keep_id`` unless the whole group is null; very long texts are cut and hashed whole; no rows give no rows; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, lower_ascii, table, without_keys

MIN_CHUNK, MAX_CHUNK = 512, 8192


def chunk_recipes(docs: DataFrame, weak_bits: int = 64) -> DataFrame:
    """doc_id, text_sha256, weak array<long>, strong array<binary>: the ordered chunks of each text."""
    cut = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?[.!?\\n]|.{{1,{MAX_CHUNK}}}"
    hashed = lambda c: F.xxhash64(c) if weak_bits == 64 else F.pmod(F.xxhash64(c), F.lit(1 << weak_bits))
    return (
        docs.select("doc_id", lower_ascii(F.col("text")).alias("norm"))
        .select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.regexp_extract_all("norm", F.lit(cut), F.lit(0)).alias("chunks"))
        .select(
            "doc_id",
            "text_sha256",
            F.transform("chunks", hashed).alias("weak"),
            F.transform("chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("strong"),
        )
    )


def unverified_ids(recipes: DataFrame) -> DataFrame:
    """Weak hashes that stand for more than one chunk (a 64-bit collision; normally none)."""
    chunks = recipes.select(F.explode(F.arrays_zip("weak", "strong")).alias("c")).select("c.weak", "c.strong")
    dictionary = chunks.groupBy("weak").agg(F.min("strong").alias("low"), F.max("strong").alias("high"))
    return dictionary.where(F.col("low") != F.col("high")).select("weak")


def exact_duplicates(spark: SparkSession, docs: DataFrame, weak_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    space = Workspace(spark)
    recipes = space.save(chunk_recipes(docs, weak_bits), "recipes")
    bad = space.save(unverified_ids(recipes), "unverified")
    if bad.isEmpty():
        keyed = recipes.select("doc_id", "text_sha256", F.col("weak").alias("ids"), F.lit(None).cast("array<binary>").alias("more"))
    else:
        doubtful = (
            recipes.select("weak", F.explode("weak").alias("w"))
            .join(bad.withColumnRenamed("weak", "w"), "w", "left_semi")
            .select("weak")
            .distinct()
            .withColumn("doubt", F.lit(True))
        )
        keyed = recipes.join(doubtful, "weak", "left").select(
            "doc_id", "text_sha256", F.col("weak").alias("ids"), F.when(F.col("doubt"), F.col("strong")).alias("more")
        )
    keyed = keyed.withColumn("more", F.coalesce("more", F.array().cast("array<binary>")))
    key = ["ids", "more"]
    groups = space.save(keyed.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    total = recipes.count()
    # groups of more than a thousandth of the rows are at most a thousand; they are broadcast, so that no task gets all rows of one
    hot = F.broadcast(groups.where(F.col("group_size") * 1000 > total))
    found = keyed.join(hot, key).unionByName(keyed.join(hot, key, "left_anti").join(groups.where(F.col("group_size") * 1000 <= total), key))
    return found.select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256"
    )


def without_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, without copies: of equal texts one row with the largest ``doc_id`` stays, and no text goes
    that has no copy, also where ids repeat. A row is known by its id and its text's digest; what goes is met as ids and digests."""
    key = ["doc_id", "_shredline_text_sha256"]
    found = Workspace(spark).save(exact_duplicates(spark, docs).withColumnRenamed("text_sha256", key[1]), "copies")
    by_row = found.groupBy(*key).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"), F.max("group_size").alias("size"), F.max("keep_id").alias("keep_id"))
    # a group without any id keeps a row too
    by_row = by_row.withColumn("kept", F.col("kept") | F.col("keep_id").isNull())
    named = docs.withColumn(key[1], F.sha2(lower_ascii(F.col("text")), 256))
    left = without_keys(named, by_row.where(~F.col("kept")).select(*key), key)
    again = by_row.where(F.col("kept") & (F.col("n") > 1)).select(*key)
    if again.isEmpty():
        return left.select(docs.columns)
    same = reduce(and_, (F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key))
    repeated = left.alias("l").join(again.alias("r"), same, "left_semi").dropDuplicates(key)
    return without_keys(left, again, key).unionByName(repeated).select(docs.columns)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark, table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
"""
QUERIES = {"op9_exact_dedup": op9_exact_dedup}
ORACLES = {"op9_exact_dedup": ORACLE}
