from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from linewarden.llm.queries import QUERIES
from linewarden.llm.sharding import shard_by_bytes


def check_shards(rows, shards=16, slack=0):
    """Gapless slots and sizes near equal; returns the bytes per shard."""
    slots, sizes = defaultdict(list), defaultdict(int)
    for shard, slot, size in rows:
        slots[shard].append(slot)
        sizes[shard] += size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    total = sum(sizes.values())
    largest = max(size for *_, size in rows)
    assert all(abs(b - total / shards) <= 2 * largest + slack for b in sizes.values())
    return sizes


def test_documents(spark, sf_dir, texts):
    rows = QUERIES["op5_sampled_splitters"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()
    }
    assert len(rows) == len(texts)
    total = sum(r["size"] for r in rows)
    check_shards([(r["shard"], r["slot"], r["size"]) for r in rows], slack=total / 16 / 16)
    homes = defaultdict(set)
    for r in rows:
        homes[texts[r["doc_id"]]].add(r["shard"])
    assert max(map(len, homes.values())) == 1


def test_one_key_with_a_third_of_all_rows_is_cut(spark):
    rows = spark.range(30_000).selectExpr(
        "id", "IF(id % 3 = 0, 5, xxhash64(id)) AS k", "10 + id % 7 AS size", "'x' AS shard"
    )
    placed = shard_by_bytes(rows, F.col("k"), F.col("size"), ranges=64)
    assert placed.columns == ["id", "k", "size", "shard", "slot"]
    found = [(r["shard"], r["slot"], r["size"]) for r in placed.collect()]
    assert len(found) == 30_000
    check_shards(found)


def test_all_rows_alike(spark):
    rows = spark.range(1000).selectExpr("1L AS id", "7L AS k", "3 AS size")
    found = [
        (r["shard"], r["slot"], r["size"])
        for r in shard_by_bytes(rows, F.col("k"), F.col("size"), ranges=32).collect()
    ]
    assert len(found) == 1000
    check_shards(found)


def test_odd_rows(odd, make):
    size = F.octet_length("text")
    placed = shard_by_bytes(odd, F.xxhash64("text"), size, shards=4)
    assert placed.count() == odd.count()
    assert shard_by_bytes(make([]), F.xxhash64("text"), size).count() == 0
    nothing = shard_by_bytes(make([(1, None), (2, None)]), F.lit(None).cast("long"), size)
    assert {(r["shard"], r["slot"]) for r in nothing.collect()} == {(0, 0), (0, 1)}


def test_no_key_below_the_limit_is_cut(spark):
    pairs = spark.range(300).selectExpr("id", "xxhash64(id % 150, 'pair') AS k", "1923L AS size")
    small = spark.range(300, 5300).selectExpr("id", "xxhash64(id) AS k", "84L AS size")
    rows = pairs.unionByName(small)
    for ranges in (512, 64):
        placed = shard_by_bytes(rows, F.col("k"), F.col("size"), ranges=ranges).collect()
        homes = defaultdict(set)
        for r in placed:
            homes[r["k"]].add(r["shard"])
        assert max(map(len, homes.values())) == 1
        total = 300 * 1923 + 5000 * 84
        check_shards([(r["shard"], r["slot"], r["size"]) for r in placed], slack=total / 256)
