"""Shards of published records by jump consistent hashing, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Multiplier of the published jump hash (a 64-bit linear congruential step).
STEP = 2862933555777941757
LOW = 0xFFFFFFFF
#: Sub-ranges of one shard; slots are counted in each and laid end to end.
SLOT_RANGES = 1024
#: Rows of equal key and text that one task numbers at most in one go.
RUN = 16384


def _times32(x: Column, c: int) -> Column:
    """``x * c`` modulo 2**32 for values below 2**32, never leaving a signed long."""
    high = (F.shiftright(x, 16) * F.lit(c)).bitwiseAND(F.lit(0xFFFF))
    return (x.bitwiseAND(F.lit(0xFFFF)) * F.lit(c) + F.shiftleft(high, 16)).bitwiseAND(F.lit(LOW))


def _advance(s: Column) -> Column:
    """One jump.  The 64-bit state is kept as two halves, so that wrapping around never overflows."""
    hi, lo, j = s["hi"], s["lo"], s["j"]
    part = F.shiftright(lo, 16) * F.lit(STEP & LOW)
    low = lo.bitwiseAND(F.lit(0xFFFF)) * F.lit(STEP & LOW) + F.shiftleft(part.bitwiseAND(F.lit(0xFFFF)), 16) + 1
    carry = F.shiftright(low, 32) + F.shiftright(part, 16)
    nxt = (carry + _times32(hi, STEP & LOW) + _times32(lo, STEP >> 32)).bitwiseAND(F.lit(LOW))
    return F.struct(nxt.alias("hi"), low.bitwiseAND(F.lit(LOW)).alias("lo"), j.alias("b"), j.alias("j"))


def _land(s: Column) -> Column:
    jump = (s["b"] + 1).cast("double") * (F.lit(2.0**31) / (F.shiftright(s["hi"], 1) + 1).cast("double"))
    return F.struct(s["hi"].alias("hi"), s["lo"].alias("lo"), s["b"].alias("b"), F.floor(jump).alias("j"))


def jump(key: Column, n: int) -> Column:
    """``struct<shard, next>`` of a 64-bit hash: its shard among ``n``, and where its next jump lands (``n`` or more).

    A jump always lands further on, so ``n`` steps are enough.
    """
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(LOW)).alias("lo"),
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
    )

    def step(s: Column, _i: Column) -> Column:
        moved = F.transform(F.array(_advance(s)), _land)[0]
        return F.when(s["j"] < n, moved).otherwise(s)

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(n)),
        start,
        step,
        lambda s: F.struct(s["b"].cast("int").alias("shard"), s["j"].alias("next")),
    )


def shard_records(records: DataFrame, n_shards: int = 24, key: str = "row_ord", body: str = "desc") -> DataFrame:
    """Put every record into one of ``n_shards`` by jump consistent hashing of its stable key.

    ``records`` are decision records (``row_ord``, ``desc``); any other key, such as ``url``, may be named.
    The law is ``key``: only the key and the number of shards decide, no ring table is kept, and with one more
    shard a record either stays or moves into the new one (``grown_shard``).

    Returns ``row_ord, size, text_crc32, law, shard, slot, grown_shard``.  ``size`` is 8 plus the UTF-8 bytes of
    the text, ``text_crc32`` its unsigned checksum; ``slot`` counts from 0 without gaps in each shard.

    A null key is a key of its own (all such rows share a shard); a null text counts as empty; repeated rows each
    get a slot (they are counted first, so that a key with most rows is no large group); an empty table gives no rows; other columns are ignored.  Slots are counted in 1,024 sub-ranges of a
    shard and laid end to end, so no task orders a whole shard.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    text = F.coalesce(F.col(body), F.lit("")).cast("binary")
    base = records.select(
        F.col(key).alias("row_ord"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.col(key)).alias("_hash"),
    )
    base = base.withColumn("_at", jump(F.col("_hash"), n_shards)).select(
        "row_ord",
        "size",
        "text_crc32",
        F.col("_at.shard").alias("shard"),
        F.when(F.col("_at.next") == n_shards, F.lit(n_shards)).otherwise(F.col("_at.shard")).alias("grown_shard"),
        F.pmod(F.xxhash64("_hash", "text_crc32", F.lit("slot")), F.lit(SLOT_RANGES)).cast("int").alias("_range"),
    )
    # Rows of equal key and text look the same, so they are counted, and get consecutive slots.
    same = ["shard", "_range", "row_ord", "text_crc32", "size", "grown_shard"]
    base = base.groupBy(*same).agg(F.count(F.lit(1)).alias("_n"))
    ahead = W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counts = base.groupBy("shard", "_range").agg(F.sum("_n").alias("_n"))
    offsets = counts.select("shard", "_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    order = W.partitionBy("shard", "_range").orderBy("row_ord", "text_crc32", "size")
    nth = F.coalesce(F.sum("_n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = base.withColumn("_nth", nth).join(offsets, ["shard", "_range"]).withColumn("_first", F.col("_before") + F.col("_nth"))
    # A group with a large share of all rows is cut into runs of slots, which are dealt out before they become rows.
    runs = placed.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(RUN).cast("long"))))
    # A stated number keeps adaptive execution from merging runs by their small size before they become rows.
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.repartition(parts, "shard", "_range", "_run")
    last = F.least(F.col("_run") + RUN, F.col("_n")) - 1
    return dealt.withColumn("_at", F.explode(F.sequence("_run", last))).select(
        "row_ord",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_first") + F.col("_at")).cast("long").alias("slot"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )
