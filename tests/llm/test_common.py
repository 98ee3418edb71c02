import numpy as np
import pytest
from pyspark.sql import functions as F

from shredline.llm import common


@pytest.mark.parametrize("n", [1, 5, 8, 40, 1000])
def test_even_keys(spark, n):
    keys = common.even_keys(spark, n)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spark.createDataFrame([(int(k),) for k in keys], "k int").select(F.expr(f"pmod(hash(k), {parts})").alias("p")).groupBy("p").count().collect()
    assert len(set(keys.tolist())) == n and max(r["count"] for r in found) == -(-n // parts)


def test_columns_round_trip():
    rng = np.random.default_rng(0)
    columns = [rng.integers(0, 2**62, 50).astype(np.uint64), rng.random(50), rng.integers(0, 9, 50).astype(np.uint8)]
    assert all((a == b).all() for a, b in zip(columns, common.expand(common.squeeze(*columns), np.uint64, np.float64, np.uint8)))
    assert [len(x) for x in common.expand(common.squeeze(*(c[:0] for c in columns)), np.uint64, np.float64, np.uint8)] == [0, 0, 0]


@pytest.mark.parametrize("few", [500_000, 0])
def test_without_keys(spark, monkeypatch, few):
    monkeypatch.setattr(common, "BROADCAST_KEYS", few)
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, None), (3, "c"), (3, "c")], "k long, t string")
    keys = spark.createDataFrame([(1, "a"), (None, "a"), (2, None), (9, "z")], "k long, t string")
    left = common.without_keys(rows, keys, ["k", "t"])
    assert left.columns == ["k", "t"] and sorted(map(tuple, left.collect())) == [(1, "b"), (3, "c"), (3, "c")]
    assert common.without_keys(rows, keys.where("false"), ["k", "t"]).count() == 6
