"""Near copies of record texts: SimHash fingerprints joined on deletion variants, then components of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Rows of one variant that are compared in place; a larger bucket is cut by further variants first.
IN_PLACE = 4096
LEVELS = 3
LOW61 = np.uint64((1 << 61) - 1)


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of a text's three-word shingles (repeats counted), as a signed long; zero without words."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])]
    votes, step = np.zeros(64, np.int64), 1 << 16
    for k in range(0, len(hashes), step):
        part = np.array(hashes[k : k + step], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (votes * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(records: DataFrame, body: str = "desc", key: str = "row_ord") -> DataFrame:
    """``row_ord, fingerprint long`` of every record; no data moves between tasks."""

    def run(batches):
        for b in batches:
            marks = [fingerprint(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks, pa.int64())], ["row_ord", "fingerprint"])

    texts = records.select(F.col(key).cast("long").alias("row_ord"), F.col(body).alias("desc"))
    return texts.mapInArrow(run, "row_ord long, fingerprint long")


def variants(marks: DataFrame) -> DataFrame:
    """``bucket, fingerprint``: both 32-bit segments with each bit wildcarded in turn.

    Of three differing bits, one of the two segments holds at most one, so linked fingerprints share a variant.
    """
    fp = F.col("fingerprint")
    halves = [F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))]
    keys = [
        half.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << p))).bitwiseOR(F.lit(s << 61 | p << 32))
        for s, half in enumerate(halves)
        for p in range(32)
    ]
    return marks.select(F.explode(F.array(*keys)).alias("bucket"), "fingerprint")


def _mix(key: np.ndarray, sub: np.ndarray) -> np.ndarray:
    x = (key ^ (sub + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(32))) & LOW61


def cut(keys: np.ndarray, marks: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the next level: the part not yet fixed is halved again, one bit of a half wildcarded.

    The top bits of a key say which parts are fixed: the segment, then also the half of the other segment.  Keys are
    mixed into 61 bits; a collision only adds pairs to verify.
    """
    path = keys >> np.uint64(61)
    out_k, out_m = [], []
    width = 16 if level == 1 else 8
    segment = path if level == 1 else path >> np.uint64(1)
    rest = np.where(segment == 0, marks & np.uint64(0xFFFFFFFF), marks >> np.uint64(32))
    if level > 1:
        half = path & np.uint64(1)
        rest = np.where(half == 0, rest & np.uint64(0xFFFF), rest >> np.uint64(16))
    for h in range(2):
        part = (rest >> np.uint64(width * (1 - h))) & np.uint64((1 << width) - 1)
        for p in range(width):
            sub = (part & ~np.uint64(1 << p)) | np.uint64((h << 8 | p) << 20)
            path_on = (path << np.uint64(1) | np.uint64(h)) & np.uint64(3)
            out_k.append(_mix(keys, sub) | (path_on << np.uint64(61)))
            out_m.append(marks)
    return np.concatenate(out_k), np.concatenate(out_m)


def span(marks: np.ndarray) -> tuple[list, list]:
    """Links that join the linked ones of one bucket, each new fingerprint once."""
    left, right, rest = [], [], marks
    while rest.size:
        open_, rest = [rest[0]], rest[1:]
        while open_ and rest.size:
            one = open_.pop()
            near = np.bitwise_count(rest ^ one) <= DISTANCE
            if near.any():
                got = rest[near]
                rest = rest[~near]
                left.append(np.full(got.size, one, np.uint64))
                right.append(got)
                open_.extend(got)
    return left, right


def links_in(keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within whole buckets, sorted by bucket: short ones by shifted comparison, others by spanning."""
    left, right = [], []
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, keys.size])
    short = np.repeat(sizes <= 16, sizes)
    k, m = keys[short], marks[short]
    for shift in range(1, 16):
        if k.size <= shift:
            break
        near = (k[shift:] == k[:-shift]) & (np.bitwise_count(m[shift:] ^ m[:-shift]) <= DISTANCE)
        if not (k[shift:] == k[:-shift]).any():
            break
        left.append(m[:-shift][near])
        right.append(m[shift:][near])
    for s, n in zip(starts[sizes > 16], sizes[sizes > 16]):
        a, b = span(marks[s : s + n])
        left += a
        right += b
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def _batch(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
    cols = [a.view(np.int64), *[None if x is None else x.view(np.int64) for x in (b, key)]]
    arrays = [pa.nulls(a.size, pa.int64()) if x is None else pa.array(x, pa.int64()) for x in cols]
    return pa.RecordBatch.from_arrays(arrays, ["a", "b", "bucket"])


def _within(level: int, in_place: int):
    """Task over rows sorted by bucket: links of each bucket, or the next level's rows of one too large for its task."""

    def out(keys, marks):
        a, b = links_in(keys, marks)
        if a.size:
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            yield _batch(np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]), None)

    def larger(keys, marks):
        for i in range(0, keys.size, 1 << 14):
            k, m = cut(keys[i : i + (1 << 14)], marks[i : i + (1 << 14)], level)
            yield _batch(m, None, k)

    def run(batches):
        keys, marks, hot = np.empty(0, np.uint64), np.empty(0, np.uint64), None
        for b in batches:
            k, m = (np.asarray(c).astype(np.int64).view(np.uint64) for c in (b.column(0), b.column(1)))
            if not k.size:
                continue
            keys, marks = np.concatenate([keys, k]), np.concatenate([marks, m])
            if hot is not None:
                same = int(np.searchsorted(keys != hot, True)) if keys[0] == hot else 0
                yield from larger(keys[:same], marks[:same])
                keys, marks = keys[same:], marks[same:]
                if keys.size:
                    hot = None
                else:
                    continue
            last = keys.size - int(np.argmin((keys == keys[-1])[::-1])) if (keys != keys[-1]).any() else 0
            yield from whole(keys[:last], marks[:last])
            keys, marks = keys[last:], marks[last:]
            if level < LEVELS and keys.size > in_place:
                hot = keys[0]
                yield from larger(keys, marks)
                keys, marks = keys[:0], marks[:0]
        yield from whole(keys, marks)

    def whole(keys, marks):
        if not keys.size:
            return
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, keys.size])
        large = np.repeat(sizes > in_place, sizes) if level < LEVELS else np.zeros(keys.size, bool)
        if large.any():
            yield from larger(keys[large], marks[large])
        if (~large).any():
            yield from out(keys[~large], marks[~large])

    return run


def links(marks: DataFrame, in_place: int = IN_PLACE) -> DataFrame:
    """``a, b``: links between distinct fingerprints that join all those within three bits, chain by chain.

    Every bucket of a variant is worked off by one task in pieces.  One that outgrows ``in_place`` rows is cut again
    by variants of the bits it leaves open; after the third cut 11 bits are open, so a bucket has 2,048 fingerprints
    at most.
    """
    spark, rows, found = marks.sparkSession, variants(marks), []
    for level in range(1, LEVELS + 1):
        sorted_rows = rows.repartition("bucket").sortWithinPartitions("bucket", "fingerprint")
        done = reliable_checkpoint(spark, sorted_rows.mapInArrow(_within(level, in_place), "a long, b long, bucket long"))
        found.append(done.filter("bucket is null").select("a", "b"))
        rows = done.filter("bucket is not null").selectExpr("bucket", "a AS fingerprint").distinct()
        if level == LEVELS or done.filter("bucket is not null").isEmpty():
            break
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.distinct()


def _lowest(edges: DataFrame) -> DataFrame:
    """Lowest neighbour (or itself) of each node, written out so that the join to it may split hot nodes."""
    low = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return reliable_checkpoint(edges.sparkSession, low)


def components(pairs: DataFrame) -> DataFrame:
    """``u, root`` for every linked node: stars are contracted in turns until no edge changes.

    Each turn is two equi joins over edges; what is collected is one row of totals.
    """
    spark = pairs.sparkSession
    edges = reliable_checkpoint(spark, pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"))
    totals = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = reliable_checkpoint(spark, large.filter("u <> v").distinct())
        near = large.join(_lowest(large), "u")
        small = near.filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(near.select("u", F.col("low").alias("v"))).distinct()
        edges = reliable_checkpoint(spark, small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == totals:
            return edges.select("u", F.col("v").alias("root"))
        totals = tuple(now)


def near_copies(records: DataFrame, body: str = "desc", key: str = "row_ord", in_place: int = IN_PLACE) -> DataFrame:
    """Group decision records whose texts are near copies of one another.

    ``records`` has ``row_ord`` and ``desc``.  Words are split at ASCII blanks after lower-casing A-Z; three-word
    shingles (repeats counted) vote on a 64-bit SimHash; fingerprints within three bits are linked.  Segments are
    indexed with one bit wildcarded, joined by equality and verified.

    Returns ``row_ord, fingerprint`` (16 hex digits) and ``component_id``, the smallest ``row_ord`` that links reach.

    Texts without words (null, empty, blank) share the fingerprint zero and so one component; repeated rows stay
    repeated; null keys are carried and never become an id unless a component has no other (then null); an empty
    table gives no rows; other columns are ignored.
    """
    spark = records.sparkSession
    marks = reliable_checkpoint(spark, fingerprints(records, body, key))
    nodes = marks.groupBy("fingerprint").agg(F.min("row_ord").alias("first"))
    roots = components(links(nodes.select("fingerprint"), in_place)).withColumnRenamed("u", "fingerprint")
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    first = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = reliable_checkpoint(spark, rooted.join(first, "root").select("fingerprint", "component_id"))
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return marks.join(named, "fingerprint").select("row_ord", hexed.alias("fingerprint"), "component_id")
