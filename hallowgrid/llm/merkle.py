"""Merkle manifest of news items: hash trees by language, and proofs found by pointer jumping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from ..session import reliable_checkpoint

#: Nodes that share a parent.
ARITY = 8
FIELDS = ("row_ord", "name", "lang", "sig", "snippet")
_STEP = "array<struct<left string, right string>>"
_OUT = f"row_ord long, leaf string, subroot string, root string, path {_STEP}, proof_sha256 string, folded_root string, verified boolean"


def leaf(values: list[Column]) -> Column:
    """Digest of a row: ``-`` for a null field, else its length in UTF-8 bytes, a colon and the field."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def _together(hashes: Column) -> Column:
    return F.sha2(F.array_join(hashes, ""), 256)


def _beside(kids: Column, i: Column) -> Column:
    """Digests before and after the i-th (from 0) of a run."""
    return F.struct(
        F.array_join(F.slice(kids, F.lit(1), i), "").alias("left"), F.array_join(F.slice(kids, i + 2, F.lit(ARITY)), "").alias("right")
    )


def _climb(nodes: DataFrame, biggest: int, name: str) -> tuple[list[DataFrame], list[DataFrame], int]:
    """Parents of ``nodes`` (``id, tree, pos, size, hash``) level by level, until each tree has one node left.

    ``size`` is the number of nodes in the tree at that level, ``biggest`` its maximum.  Returns pointers to parents
    (``id, up, path, hash``), the last nodes of the trees by level, and the number of levels.
    """
    spark, pointers, tops, level = nodes.sparkSession, [], [], 0
    while biggest > 1:
        tops.append(nodes.filter("size = 1"))
        level += 1
        kid = F.struct("pos", "id", "hash")
        run = nodes.filter("size > 1").groupBy("tree", F.expr(f"pos div {ARITY}").alias("of")).agg(F.sort_array(F.collect_list(kid)).alias("kids"), F.max("size").alias("n"))
        up = F.concat_ws("/", F.lit(name), F.lit(str(level)), F.col("of").cast("string"), "tree").alias("id")
        parents = run.select(up, "tree", F.col("of").alias("pos"), F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("size"), _together(F.col("kids.hash")).alias("hash"), "kids")
        parents = reliable_checkpoint(spark, parents)
        each = F.transform(F.col("kids"), lambda k, i: F.struct(k["id"].alias("id"), F.array(_beside(F.col("kids.hash"), i)).alias("path"), k["hash"].alias("hash")))
        pointers.append(parents.select(F.col("id").alias("up"), F.inline(each)))
        nodes, biggest = parents.drop("kids"), -(-biggest // ARITY)
    return pointers, [*tops, nodes], level


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _jumped(pointers: DataFrame, depth: int) -> DataFrame:
    """Every node's path to the root: each round joins the table with itself and doubles the distance.

    Nodes that have arrived leave the join.  Either the nodes pointed at are few, and the join is broadcast by their
    measured size, or they are many and none is pointed at by a large share.
    """
    spark, reached = pointers.sparkSession, 1
    while reached <= depth:  # the root itself is met last, for its digest
        far = pointers.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("path").alias("rest"), F.col("subroot").alias("s2"), F.col("root").alias("r2"))
        moved = pointers.filter("up IS NOT NULL").join(far, "up")
        moved = moved.select("id", F.col("up2").alias("up"), F.concat("path", "rest").alias("path"), F.coalesce("subroot", "s2").alias("subroot"), F.coalesce("root", "r2").alias("root"))
        pointers = reliable_checkpoint(spark, moved.unionByName(pointers.filter("up IS NULL")))
        reached *= 2
    return pointers


def news_manifest(
    news: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    shelf: str = "lang",
    order: str = "row_ord",
    received: dict[str, Column] | None = None,
) -> DataFrame:
    """Digest of every news item, of its language's tree and of the whole set, with the proof that ties them together.

    ``news`` are news items; ``fields`` make up an item's leaf (see :func:`leaf`).  Per ``shelf`` leaves ascend by
    ``order``; while a tree has several nodes, every eight consecutive ones (the last run may have fewer, even one)
    become the digest of their concatenated digests.  What remains is the subroot; subroots, ordered by shelf, lead to
    the root likewise.  ``received`` has, by field, what a receiver holds instead; its leaf is folded with the
    publisher's siblings.

    Returns ``row_ord`` (the order field), ``leaf, subroot, root, path`` (siblings to the left and right, level by
    level), ``proof_sha256`` (digest of all siblings, left to right), ``folded_root`` and ``verified`` (equals root),
    one row per item.

    Null fields count as ``-``; a null shelf is a shelf of its own and comes first, null orders come first in their
    shelf.  Items that tie in ``order`` follow their leaf; equal items are interchangeable and each keeps a leaf.
    Texts of any length are hashed whole, in one pass; an empty table gives no rows; other columns are ignored.

    Leaves travel in their run of eight, one row of the node table: nodes hold the siblings on the way to an ancestor,
    and self-joins of that table double the way until every run, and with it every leaf, reaches the root.
    """
    spark, received = news.sparkSession, received or {}
    own = leaf([F.col(f) for f in fields])
    told = leaf([received.get(f, F.col(f)) for f in fields]) if received else own
    tree = F.coalesce(F.concat(F.lit("="), F.col(shelf).cast("string")), F.lit(""))
    # The number only tells equal items apart; it is written, so that it stays.
    leaves = news.select(tree.alias("tree"), F.col(order).cast("long").alias("row_ord"), own.alias("leaf"), told.alias("told"), F.monotonically_increasing_id().alias("nth"))
    leaves = numbered(reliable_checkpoint(spark, leaves), ["tree", "row_ord", "leaf", "nth"], "at")
    trees = reliable_checkpoint(spark, leaves.groupBy("tree").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n")))
    sizes = trees.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("trees")).first()
    if not sizes["trees"]:
        return spark.createDataFrame([], _OUT)

    placed = leaves.join(trees, "tree").withColumn("at", F.col("at") - F.col("start"))
    run = placed.groupBy("tree", F.expr(f"at div {ARITY}").alias("pos")).agg(
        F.sort_array(F.collect_list(F.struct("at", "row_ord", "leaf", "told"))).alias("items"), F.max("n").alias("n")
    )
    hash_ = F.when(F.col("n") == 1, F.col("items.leaf")[0]).otherwise(_together(F.col("items.leaf")))
    size = F.expr(f"(n + {ARITY - 1}) div {ARITY}")
    runs = reliable_checkpoint(spark, run.select(F.concat_ws("/", F.lit("run"), F.col("pos").cast("string"), "tree").alias("id"), "tree", "pos", size.alias("size"), hash_.alias("hash"), "items", (F.col("n") == 1).alias("lone")))

    inner, tops, high = _climb(runs.drop("items", "lone"), -(-sizes["most"] // ARITY), "node")
    subroots = numbered(_union(tops).select("id", "tree", "hash"), ["tree"], "pos")
    shelves = subroots.select("id", F.lit("").alias("tree"), (F.col("pos") - 1).alias("pos"), F.lit(sizes["trees"]).cast("long").alias("size"), "hash")
    outer, (*_, last), above = _climb(shelves, sizes["trees"], "shelf")

    none, text = F.lit(None).cast("string"), F.col("hash")
    top = last.select("id", none.alias("up"), F.array().cast(_STEP).alias("path"), (text if not outer else none).alias("subroot"), text.alias("root"))
    steps = [p.select("id", "up", "path", none.alias("subroot"), none.alias("root")) for p in inner]
    steps += [p.select("id", "up", "path", (text if k == 0 else none).alias("subroot"), none.alias("root")) for k, p in enumerate(outer)]
    paths = _jumped(reliable_checkpoint(spark, _union([top, *steps])), high + above)

    mine = F.when(F.col("lone"), F.array().cast(_STEP)).otherwise(F.array(_beside(F.col("items.leaf"), F.col("i"))))
    each = runs.join(paths.select("id", "path", "subroot", "root"), "id").select("*", F.posexplode("items").alias("i", "item"))
    each = each.select("item.*", "subroot", "root", F.concat(mine, "path").alias("path"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    folded = F.aggregate("path", F.col("told"), lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))
    out = each.select("row_ord", "leaf", "subroot", "root", "path", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
