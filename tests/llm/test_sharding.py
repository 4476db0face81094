import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hallowgrid.llm.sharding import shard_records


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_are_those_of_the_published_loop(spark):
    df = spark.range(3000).select(F.col("id").alias("row_ord"), F.concat(F.lit("grave é "), F.col("id")).alias("desc"))
    keys = {r.row_ord: r.h for r in df.select("row_ord", F.xxhash64("row_ord").alias("h")).collect()}
    rows = shard_records(df, 24).collect()
    assert len(rows) == 3000
    slots = defaultdict(list)
    for r in rows:
        assert (r.shard, r.grown_shard) == (jump(keys[r.row_ord], 24), jump(keys[r.row_ord], 25))
        text = f"grave é {r.row_ord}".encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 8, zlib.crc32(text), "key")
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert moved and all(r.grown_shard == 24 for r in moved) and len(moved) < 3000 * 2 / 25


def test_awkward_rows(awkward):
    rows = shard_records(awkward, 3).collect()
    assert len(rows) == 10
    assert Counter(r.row_ord for r in rows)[7] == 2
    assert [(r.size, r.text_crc32) for r in rows if r.row_ord == 3] == [(8, 0)]
    assert len({r.shard for r in rows if r.row_ord is None}) == 1
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shard_records(awkward.limit(0), 3).count() == 0


def test_single_shard_and_other_keys(awkward):
    assert {(r.shard, r.grown_shard in (0, 1)) for r in shard_records(awkward, 1).collect()} == {(0, True)}
    assert shard_records(awkward, 5, key="source").select("row_ord").distinct().count() == 4


def test_rows_of_one_key_and_text_are_no_large_group(spark):
    """Equal rows reach the numbering as one counted row, and become rows again in runs."""
    df = spark.range(200_000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("row_ord"), F.when(F.col("id") % 4 == 0, F.lit("x")).alias("desc"))
    out = shard_records(df, 24)
    hot = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert hot < 120_000
    by = out.groupBy("shard").agg(F.count("slot").alias("n"), F.countDistinct("slot").alias("d"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()
    assert sum(r.n for r in by) == 200_000 and all(r.n == r.d == r.high + 1 and r.low == 0 for r in by)
    assert out.filter("row_ord IS NULL").count() == 150_000
