"""Guarded publishing.

A dataset is a folder of immutable versions plus a small table of committed versions.
A version becomes visible only when its row is appended to that table, after its rows
were written and counted; a refused or failed write leaves readers where they were.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import scalar
from ..operators import aggregates
from ..operators.counters import Counters
from ..operators.grid import with_layer_cell
from ..operators.joins import not_in

_COMMITS = "version long, n_rows long, data string, stream string, upto long"
_COUNTS = "name string, n long"


@dataclass(frozen=True)
class Outcome:
    written: bool
    reason: str
    n_rows: int
    prior_rows: int
    path: str | None
    counts: dict[str, int] = field(default_factory=dict)


def current_version(spark: SparkSession, path: str):
    """(n_rows, data path) of the committed version, or None."""
    try:
        commits = spark.read.schema(_COMMITS).json(f"{path}/_versions")
        row = commits.orderBy(F.desc("version")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if row is None else (row["n_rows"], row["data"])


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    now = current_version(spark, path)
    return None if now is None else spark.read.parquet(f"{path}/{now[1]}")


def guarded_publish(
    df: DataFrame,
    path: str,
    min_rows: int = 1,
    min_ratio: float = 0.0,
    partition_by=(),
    name: str = "publish",
    describe: Callable[[DataFrame, str], None] | None = None,
    counters: Counters | None = None,
    origin: tuple[str, int] | None = None,
) -> Outcome:
    """Publish unless the result is empty or suspiciously thin.

    Refused: no rows at all; fewer than ``min_rows`` while more were published before;
    fewer than ``min_ratio`` of what was published before.  Rows are counted by the
    write itself.  ``describe`` gets the rows written and the version's name before the
    version becomes visible, so that readers never see one without its description.
    Observed ``counters`` are stored with the version and returned.  ``origin`` (a stream
    and the last of its batches that is in ``df``) is part of the commit, see
    :func:`committed_upto`.
    """
    spark = df.sparkSession
    prior = current_version(spark, path)
    prior_rows = prior[0] if prior else 0
    version = time.time_ns()
    data = f"data/v={version}"
    seen = Observation(f"{name}-{version}")
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path}/{data}")
    n, counts = seen.get["n"], counters.values() if counters else {}
    if n == 0:
        return Outcome(False, "no rows", 0, prior_rows, None, counts)
    if (n < min_rows and prior_rows > n) or n < prior_rows * min_ratio:
        return Outcome(False, "thin", n, prior_rows, None, counts)
    if counts:
        spark.createDataFrame(list(counts.items()), _COUNTS).coalesce(1).write.mode("overwrite").json(f"{path}/_counts/v={version}")
    if describe:
        describe(spark.read.parquet(f"{path}/{data}"), f"v={version}")
    spark.createDataFrame([(version, n, data, *(origin or (None, None)))], _COMMITS).coalesce(1).write.mode("append").json(f"{path}/_versions")
    return Outcome(True, "ok", n, prior_rows, f"{path}/{data}", counts)


def committed_upto(spark: SparkSession, path: str, stream: str) -> int:
    """Last batch of a stream that is part of a committed version; -1 if none is."""
    try:
        commits = spark.read.schema(_COMMITS).json(f"{path}/_versions")
        last = commits.filter(F.col("stream") == stream).agg(F.max("upto")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    return -1 if last is None else last


# --- FN24, K1: the record file -------------------------------------------------------------
def slim(df: DataFrame, desc_chars: int | None = None) -> DataFrame:
    """Publish form: empties to NULL, four decimals, day dates; prose in full, or cut to ``desc_chars`` for display."""
    out = {}
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if f.name in ("lat", "lng"):
            out[f.name] = scalar.exact_round(c, 4)
        elif f.name in ("date", "deadline"):
            out[f.name] = scalar.blank_to_null(F.left(c, F.lit(10)))
        elif f.name == "desc":
            out[f.name] = scalar.blank_to_null(F.left(c, F.lit(desc_chars)) if desc_chars else c)
        elif f.dataType.typeName() == "string":
            out[f.name] = scalar.blank_to_null(c)
    return df.withColumns(out)


def publish_records(df: DataFrame, path: str, min_rows: int = 4, counters: Counters | None = None) -> Outcome:
    """Records behind the guards, and a one-row metadata table for the same version."""

    def describe(written: DataFrame, version: str) -> None:
        aggregates.meta_row(written).write.mode("overwrite").parquet(f"{path}/_meta/{version}")

    return guarded_publish(slim(df), path, min_rows=min_rows, name="records", describe=describe, counters=counters)


def export_json_lines(df: DataFrame, path: str) -> None:
    """Compressed JSON lines, empty fields left out; splittable across files."""
    df.drop("source_ord", "row_ord").write.mode("errorifexists").option("compression", "gzip").json(path)


# --- G4, K4: the facility layer ---------------------------------------------------------------
def publish_layer(df: DataFrame, path: str, min_ratio: float = 0.6, threshold: int = 40_000, deg: int = 10, counters: Counters | None = None) -> Outcome:
    """Facilities partitioned by type and cell, and their manifest.

    Rows are rebalanced by type and cell before the write: adaptive execution splits a
    cell that holds a tenth of the world over several tasks and packs small cells
    together, so neither one task nor the file count grows with the skew.
    """
    d = df if {"cell", "cell_lat", "cell_lng"} <= set(df.columns) else with_layer_cell(df, deg)
    spread = d.hint("rebalance", "ftype", "cell_lat", "cell_lng")
    parts = ("ftype", "cell_lat", "cell_lng")

    def describe(written: DataFrame, version: str) -> None:
        aggregates.layer_manifest(written, threshold).write.mode("overwrite").parquet(f"{path}/_manifest/{version}")

    return guarded_publish(spread, path, min_ratio=min_ratio, partition_by=parts, name="layer", describe=describe, counters=counters)


def prune_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the data of all but the last ``keep`` committed versions, and of versions never committed.

    A version is what this engine writes and replaces as a whole, so stale tiles go with
    it.  The list is bounded by the number of versions; files are deleted by folder.
    """
    commits = spark.read.schema(_COMMITS).json(f"{path}/_versions").orderBy(F.desc("version"))
    rows = commits.select("version", "data").collect()
    kept, last = {r["data"] for r in rows[:keep]}, rows[0]["version"] if rows else 0
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        # what is newer than the last commit may still be in the making
        if f"data/{name}" not in kept and name.startswith("v=") and int(name[2:]) < last:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return gone


# --- K5: stale tiles ---------------------------------------------------------------------------
def tile_listing(files: DataFrame, name: Column, prefix: str = "layer") -> DataFrame:
    """File names to ``file, ftype, cell``; names outside the scheme keep NULLs."""
    pat = rf"^{prefix}_([a-z]+)(?:_(-?\d+_-?\d+))?\.json\.gz$"
    return files.select(
        name.alias("file"),
        scalar.blank_to_null(F.regexp_extract(name, pat, 1)).alias("ftype"),
        scalar.blank_to_null(F.regexp_extract(name, pat, 2)).alias("cell"),
    )


def stale_tiles(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed tiles the manifest does not know.

    A cell of a tiled type that is not in the manifest is stale; so is any cell file of
    a type now published whole, and the whole file of a type now tiled.  Files outside
    the naming scheme are left alone.
    """
    known = listing.filter(F.col("ftype").isNotNull())
    tiled = manifest.filter(F.col("mode") == "tiled")
    cells = not_in(known.filter(F.col("cell").isNotNull()), tiled.select("ftype", "cell"), ["ftype", "cell"])
    whole = known.filter(F.col("cell").isNull()).join(tiled.select("ftype").distinct(), "ftype", "left_semi")
    cols = ["file", "ftype", "cell"]
    return cells.select(*cols).unionByName(whole.select(*cols))


def delete_files(spark: SparkSession, files: DataFrame, base: str) -> int:
    """Delete the listed tiles (at most one per cell and type, so a bounded list)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    n = 0
    for r in files.select("file").toLocalIterator():
        n += bool(fs.delete(jvm.org.apache.hadoop.fs.Path(root, r["file"]), True))
    return n


# --- K6: link status -------------------------------------------------------------------------------
def link_status(probes: DataFrame, states: DataFrame, order: str = "row_ord") -> tuple[DataFrame, DataFrame]:
    """(entries, tally): last probe of a name wins in entries, every probe counts in the tally."""
    from ..functions import text
    from ..operators.dedup import last_wins

    state = text.link_state(F.col("url"), F.col("code"), F.col("final_url"), F.col("error"))
    d = probes.withColumn("state", state)
    moved = F.rtrim("final_url", F.lit("/")) != F.rtrim("url", F.lit("/"))
    entries = last_wins(d, ["name"], [order]).select(
        "name", "state", "url", "code", F.when(moved, F.col("final_url")).alias("final")
    )
    return entries, aggregates.state_tally(d, states)


