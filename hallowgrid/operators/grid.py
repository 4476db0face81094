"""World grid, adaptive tiling, incremental refresh, viewport reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, scalar

LAT_MIN, LAT_MAX, LNG_MIN, LNG_MAX = -60.0, 84.0, -180.0, 180.0


def tile_key(s: Column, w: Column) -> Column:
    return F.format_string("%.3f,%.3f", s, w)


def world_tiles(spark: SparkSession, step: float = 2.5) -> DataFrame:
    """Boxes ``s, w, n, e`` covering the inhabited latitudes, in sweep order (``ord``)."""
    rows = int(-(-(LAT_MAX - LAT_MIN) // step))
    cols = int(-(-(LNG_MAX - LNG_MIN) // step))
    i, j = (F.col("ord") / cols).cast("int"), (F.col("ord") % cols).cast("int")
    south, west = F.lit(LAT_MIN) + i * step, F.lit(LNG_MIN) + j * step
    return spark.range(rows * cols).withColumnRenamed("id", "ord").select(
        "ord",
        F.round(south, 3).alias("s"),
        F.round(west, 3).alias("w"),
        F.round(F.least(south + step, F.lit(LAT_MAX)), 3).alias("n"),
        F.round(F.least(west + step, F.lit(LNG_MAX)), 3).alias("e"),
    )


def quarters(df: DataFrame) -> DataFrame:
    """Each box split into four: south-west, south-east, north-west, north-east."""
    s, w, n, e = (F.col(c) for c in "swne")
    ms, mw = (s + n) / 2.0, (w + e) / 2.0

    def box(q, a, b, c, d):
        return F.struct(
            F.lit(q).alias("q"), a.alias("s"), b.alias("w"), c.alias("n"), d.alias("e")
        )

    parts = F.array(box(0, s, w, ms, mw), box(1, s, mw, ms, e), box(2, ms, w, n, mw), box(3, ms, mw, n, e))
    keep = [c for c in df.columns if c not in "swne"]
    return df.select(*keep, F.inline(parts))


def adaptive_tiles(points: DataFrame, threshold: int, top_deg: float = 10.0, levels: int = 5) -> DataFrame:
    """Coarsest tiles that hold at most ``threshold`` points, down to a floor.

    Points are counted once at the finest level; every coarser level is a roll-up of
    those counts, so the data is shuffled once whatever the number of levels.
    Returns ``level, ti, tj, n_rows`` (level 0 = ``top_deg``).
    """
    fine = top_deg / (1 << (levels - 1))
    base = points.groupBy(
        geo.cell_index(F.col("lat"), fine).alias("i"), geo.cell_index(F.col("lng"), fine).alias("j")
    ).agg(F.count(F.lit(1)).alias("n"))
    ladder = base.select(
        "i",
        "j",
        "n",
        F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"),
    ).withColumns(
        {
            "ti": F.floor(F.col("i") / F.pow(F.lit(2.0), F.lit(levels - 1) - F.col("level"))).cast("bigint"),
            "tj": F.floor(F.col("j") / F.pow(F.lit(2.0), F.lit(levels - 1) - F.col("level"))).cast("bigint"),
        }
    )
    sums = ladder.groupBy("level", "ti", "tj").agg(F.sum("n").alias("n_rows"))
    fits = (F.col("n_rows") <= threshold) | (F.col("level") == levels - 1)
    chosen = (
        ladder.join(sums.filter(fits), ["level", "ti", "tj"])
        .groupBy("i", "j")
        .agg(F.min(F.struct("level", "ti", "tj", "n_rows")).alias("t"))
    )
    return chosen.select("t.*").distinct()


def with_layer_cell(df: DataFrame, deg: int = 10) -> DataFrame:
    """Layer cell as text key and as numbers; the numbers prune partitions by range."""
    lat, lng = F.col("lat"), F.col("lng")
    return df.withColumns(
        {
            "cell": geo.layer_cell_key(lat, lng, deg),
            "cell_lat": geo.layer_cell(lat, deg),
            "cell_lng": geo.layer_cell(lng, deg),
        }
    )


def viewport(df: DataFrame, s: float, w: float, n: float, e: float, deg: int = 10) -> DataFrame:
    """Rows inside a box; only cells the box touches are read from a partitioned layer."""

    def down(x: float) -> int:
        return int(x // deg) * deg

    lat_cells = F.col("cell_lat").between(down(s), down(n))
    if w <= e:
        lng_cells = F.col("cell_lng").between(down(w), down(e))
        lng_rows = F.col("lng").between(w, e)
    else:
        lng_cells = (F.col("cell_lng") >= down(w)) | (F.col("cell_lng") <= down(e))
        lng_rows = (F.col("lng") >= w) | (F.col("lng") <= e)
    return df.filter(lat_cells & lng_cells).filter(F.col("lat").between(s, n) & lng_rows)


# --- incremental refresh ----------------------------------------------------------------
def cells_to_refresh(
    tiles: DataFrame,
    state: DataFrame,
    rotation: int,
    now: Column | None = None,
    max_age_days: int = 14,
    recheck_all: bool = False,
    slot: Column | None = None,
    slots: int = 8,
) -> DataFrame:
    """Tiles that need work.

    ``state`` has ``tile_key, state ('empty'|'done'), ts``.  Done tiles are skipped
    unless their marker is older than ``max_age_days``; known-empty tiles are skipped
    except for the one slot in ``slots`` whose turn it is.
    """
    if recheck_all:
        return tiles
    now = F.current_timestamp() if now is None else now
    slot = F.pmod(F.crc32("tile_key"), F.lit(slots)) if slot is None else slot
    young = F.col("ts").isNull() | (F.col("ts") >= now - F.expr(f"INTERVAL {max_age_days} DAYS"))
    skip = state.filter(((F.col("state") == "done") & young) | ((F.col("state") == "empty") & (slot != rotation)))
    return tiles.join(skip.select("tile_key"), "tile_key", "left_anti")


def next_state(state: DataFrame, results: DataFrame, complete: bool, now: Column | None = None) -> DataFrame:
    """Refresh state after a run.

    ``results`` has ``tile_key, n_rows, ok`` for the tiles swept now.  A tile that
    answered joins or leaves ``empty`` by whether it had rows; a failed one keeps its
    mark.  Swept tiles become ``done``; a completed sweep leaves no ``done``.
    """
    now = F.current_timestamp() if now is None else now
    answered = results.filter("ok").groupBy("tile_key").agg(F.sum("n_rows").alias("n_rows"))
    old_empty = state.filter(F.col("state") == "empty").select("tile_key", "state", "ts")
    kept = old_empty.join(answered, "tile_key", "left_anti")
    new_empty = answered.filter(F.col("n_rows") == 0).select("tile_key", F.lit("empty").alias("state"), now.alias("ts"))
    out = kept.unionByName(new_empty)
    if complete:
        return out
    # A tile keeps the time it was first banked, so a stuck sweep shows its age.
    done = (
        state.filter(F.col("state") == "done")
        .select("tile_key", "ts")
        .unionByName(results.select("tile_key", now.alias("ts")))
        .groupBy("tile_key")
        .agg(F.min("ts").alias("ts"))
    )
    return out.unionByName(done.select("tile_key", F.lit("done").alias("state"), "ts"))
