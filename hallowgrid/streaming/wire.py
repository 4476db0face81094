"""Incremental paths on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.counters import Counters
from ..operators.merge import preserve_silent
from ..session import shared_dir
from ..sources import normalise, sinks


def file_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet", name_filter: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if name_filter:
        r = r.option("pathGlobFilter", name_filter)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.load(folder)


def event_time(date: Column, ingest_ts: Column) -> Column:
    """Event time of an item: its date, but never after its arrival; undated items use their arrival."""
    return F.least(F.coalesce(F.try_to_date(date, "yyyy-MM-dd").cast("timestamp"), ingest_ts), ingest_ts)


# --- ST1 --------------------------------------------------------------------------------
def distinct_links(items: DataFrame, ts: str = "arrived_ts", key: str = "link_key", horizon: str = "90 days") -> DataFrame:
    """First arrival per link.  The watermark follows arrival, which no date written in an
    item can move, so a wrongly dated item never makes others late.  State is dropped once a
    link arrived longer ago than the age cut, so it grows with the links of that window and
    not with the stream."""
    return items.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def news_stream(entries: DataFrame, ingest_ts: Column, horizon_days: int = 90, **options) -> DataFrame:
    """Feed entries to distinct news candidates; geo-tag them per batch."""
    d = normalise.news_candidates(entries, max_age_days=horizon_days, **options)
    d = d.withColumns({"arrived_ts": ingest_ts, "event_ts": event_time(F.col("date"), ingest_ts)})
    return distinct_links(d, horizon=f"{horizon_days} days")


# --- ST2 --------------------------------------------------------------------------------
def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what has arrived since the last run, then stop; resumes after a crash."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def append_available(items: DataFrame, target: str, checkpoint: str) -> None:
    run_available(items.writeStream.format("parquet").outputMode("append").option("path", target), checkpoint)


# --- ST3 --------------------------------------------------------------------------------
def daily_counts(items: DataFrame, *dims: str, ts: str = "event_ts") -> DataFrame:
    """Items per day and dimension values."""
    return items.groupBy(F.to_date(ts).alias("day"), *dims).agg(F.count(F.lit(1)).alias("n"))


def store_counts(items: DataFrame, target: str, checkpoint: str, *dims: str, ts: str = "event_ts") -> None:
    """Add each batch's counts to a table of increments.

    No state and no watermark: an item counts on its day however late it arrives.  Each
    batch is a folder of its own, so a replayed batch overwrites itself.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        daily_counts(batch, *dims, ts=ts).write.mode("overwrite").parquet(f"{target}/b={batch_id}")

    run_available(items.writeStream.foreachBatch(put), checkpoint)


def latest_counts(spark: SparkSession, target: str, *dims: str) -> DataFrame:
    return spark.read.parquet(target).groupBy("day", *dims).agg(F.sum("n").alias("n"))


# --- ST4 --------------------------------------------------------------------------------
_MARKS = "upto long, n_rows long"


def _staged(spark: SparkSession, folder: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _handled_upto(spark: SparkSession, staging: str) -> int:
    """Last batch that a refresh has ended with, published or refused."""
    try:
        last = spark.read.schema(_MARKS).json(f"{staging}/handled").agg(F.max("upto")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    return -1 if last is None else last


def _mark(spark: SparkSession, staging: str, upto: int, n_rows: int) -> None:
    spark.createDataFrame([(upto, n_rows)], _MARKS).coalesce(1).write.mode("append").json(f"{staging}/handled")


def _drop_staged(spark: SparkSession, staging: str, upto: int) -> None:
    """Delete the staged batches that a refresh has ended with; each is one folder."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{staging}/rows")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root) if fs.exists(root) else ():
        name = status.getPath().getName()
        if name.startswith("b=") and int(name[2:]) <= upto:
            fs.delete(status.getPath(), True)


def stage_available(rows: DataFrame, staging: str, checkpoint: str) -> None:
    """Append what has arrived to the staging table; a replayed batch overwrites itself."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{staging}/rows/b={batch_id}")

    run_available(rows.writeStream.foreachBatch(put), checkpoint)


def refresh_available(
    rows: DataFrame, path: str, checkpoint: str, min_rows: int = 4, preserve_min: int = 10
) -> sinks.Outcome | None:
    """Refresh the published records with all that arrived since the last refresh, exactly once.

    Batches are only staged; the refresh is published once, when the run has ended, so the
    guards and the silent sources are judged on the whole run and not batch by batch.  What
    a crashed run staged is part of the next one.  Nothing new publishes nothing.

    The commit of a version names the stream and the last batch in it, in the same row that
    makes it visible.  A run that crashes after that row leaves nothing to do: the next one
    finds the batches committed and does not publish them again.  A refusal is noted apart.
    Batches that a refresh has ended with are deleted from staging.  The counts of the
    outcome are the fresh rows and those kept from silent sources.
    """
    spark, stream = rows.sparkSession, checkpoint.rstrip("/")
    staging = f"{stream}-staging"
    stage_available(rows, staging, checkpoint)
    done = max(_handled_upto(spark, staging), sinks.committed_upto(spark, path, stream))
    _drop_staged(spark, staging, done)
    staged = _staged(spark, f"{staging}/rows", StructType([*rows.schema.fields, StructField("b", LongType())]))
    last = None if staged is None else staged.filter(F.col("b") > done).agg(F.max("b")).first()[0]
    if last is None:
        return None
    counters = Counters()
    fresh = staged.filter((F.col("b") > done) & (F.col("b") <= last)).drop("b")
    prior = sinks.read_published(spark, path)
    merged = fresh.withColumn("__fresh", F.lit(True))
    if prior is not None:
        merged = preserve_silent(merged, prior.withColumn("__fresh", F.lit(False)), preserve_min)
    merged = counters.count(merged, fresh=F.col("__fresh"), kept=~F.col("__fresh")).drop("__fresh")
    out = sinks.guarded_publish(merged, path, min_rows=min_rows, name=f"refresh-{last}", counters=counters, origin=(stream, int(last)))
    _mark(spark, staging, int(last), out.n_rows)
    _drop_staged(spark, staging, int(last))
    return out


def scratch(spark: SparkSession) -> tuple[str, str]:
    """Fresh (target, checkpoint) folders under the shared location."""
    base = shared_dir(spark)
    return f"{base}/out", f"{base}/checkpoint"
