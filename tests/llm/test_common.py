"""Shared helpers."""

import zlib

from pyspark.sql import functions as F

from quire.llm import common


def test_lookup_with_and_without_hot_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)] + [(-1, None)], "i long, k string")
    small = rows.filter("k is not null and k != 'k5'").groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top"))
    assert common.heavy_keys(small, "k", "n", 3) == ["hot"]
    want = sorted(map(repr, (tuple(r) for r in rows.join(small, "k", "left").select("i", "k", "n", "top").collect())))
    for share in (3, 500):
        assert sorted(map(repr, (tuple(r) for r in common.lookup(rows, small, "k", "n", share).select("i", "k", "n", "top").collect()))) == want
    assert common.lookup(rows.limit(0), small.limit(0), "k", "n").count() == 0


def test_buckets_and_slices(spark):
    got = spark.createDataFrame([(0,), (12345,), (None,)], "doc_id long").select(common.crc_bucket("doc_id", 5).alias("b")).collect()
    assert [r.b for r in got] == [zlib.crc32(s.encode()) % 5 for s in ("0", "12345", "null")]
    values = [b"a" * 5, None, b"b" * 20, b"", b"c"]
    parts = list(common.slices(values, 8))
    assert [x for a, b in parts for x in values[a:b]] == values and list(common.slices([], 8)) == []


def test_cut_keeps_rows_and_ends_lineage(spark):
    df = common.cut(spark.range(10).withColumn("x", F.rand(1)))
    assert df.collect() == df.collect() and "Range" not in df._jdf.queryExecution().toString()
