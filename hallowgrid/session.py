"""Session helpers: settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # HotSpot does not compile methods above 8,000 bytes.  Past that size split
    # projections beat one fused method that would be interpreted (measured: 6x).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "hallowgrid", **extra: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint location the cluster names.

    Only where ``spark.checkpoint.dir`` is unset on a local master (tests) does this
    fall back to a folder on this machine.
    """
    key = "spark.checkpoint.dir"
    base = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="hallowgrid-")
        spark.conf.set(key, base)
    return f"{base.rstrip('/')}/hallowgrid/{uuid.uuid4().hex}"


def reliable_checkpoint(spark: SparkSession, df):
    """Cut lineage by writing a table to the shared folder and reading it back."""
    path = shared_dir(spark)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def small_table(spark: SparkSession, rows, ddl: str):
    """A constant table as a local relation.

    Its size is known to the optimizer, so joins to it are broadcast below the usual
    threshold; a table built from Python rows counts as unboundedly large.
    """
    fields = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrow = pa.Table.from_arrays(
        [pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, fields)], names=fields.fieldNames()
    )
    return spark.createDataFrame(arrow, schema=fields)


def spread(df, *keys: str):
    """Spread an input that arrives in fewer splits than there are cores.

    A gzipped document or a one-row-group file is read by one task, and the text work
    behind it would stay there.  Inputs with enough splits, the normal case on a
    cluster, are returned unchanged.  Keys make the spread repeatable.  Call it on
    scans, before any shuffle: it only looks at the number of input splits.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def dealt(df, *keys: str):
    """Deal narrow rows out before dear text work, however the input is split.

    Splits of a file with one row group are counted, yet one of them holds all rows, so the number of splits tells
    nothing.  The stated number of partitions is not coalesced.
    """
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)
