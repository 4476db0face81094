"""Queries that run a stream over the event table to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import sinks
from ...session import shared_dir
from ...streaming import wire
from .base import pick, query, table

lit = F.lit


def _events(spark, sf, files: int = 4):
    """The event table as a stream of several files, one per batch, oldest keys not first."""
    folder = shared_dir(spark)
    events = table(spark, sf, "events")
    events.repartition(files, "event_id").write.parquet(folder)
    landed = wire.file_stream(spark, folder, events.schema, files_per_batch=1)
    return landed.withColumn("event_ts", F.col("ts").cast("timestamp"))


_HEAD = ["Mass graves found", "Zombie graveyard", "Market news"]


@query(
    "ST1, ST2, W3, P6, P7, FN21",
    "SELECT DISTINCT 'https://n.example/' || user_id AS link_key FROM events WHERE event_id % 3 = 0",
)
def stream_distinct_links(spark, sf):
    e = F.col("event_id")
    entries = _events(spark, sf).select(
        lit("n").alias("name"), pick(_HEAD, e).alias("title"), F.concat(lit("https://n.example/"), F.col("user_id").cast("string"), lit("/?e="), e.cast("string")).alias("link"),
        lit("").alias("summary"), F.when(e % 997 == 0, "2030-01-01").when(e % 4 > 0, F.date_format("event_ts", "yyyy-MM-dd")).otherwise("").alias("published"), e.alias("row_ord"), "event_ts",
    )
    items = wire.news_stream(entries.withColumnRenamed("event_ts", "arrived"), F.col("arrived"), horizon_days=90, today=lit("2024-02-01").cast("date"))
    target, checkpoint = wire.scratch(spark)
    wire.append_available(items.select("link_key", "date", "topic"), target, checkpoint)
    # A second run finds nothing new: it resumes where the first one stopped.
    wire.append_available(items.select("link_key", "date", "topic"), target, checkpoint)
    return spark.read.schema("link_key string").parquet(target)


@query(
    "ST3, A3",
    "SELECT CASE WHEN event_id % 997 = 0 THEN DATE '2030-01-01' ELSE CAST(ts AS DATE) END AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
)
def stream_daily_counts(spark, sf):
    target, checkpoint = wire.scratch(spark)
    # a clock that runs ahead must not make later events late
    ahead = F.when(F.col("event_id") % 997 == 0, lit("2030-01-01").cast("timestamp")).otherwise(F.col("event_ts"))
    wire.store_counts(_events(spark, sf).withColumn("event_ts", ahead), target, checkpoint, "event_type")
    return wire.latest_counts(spark, target, "event_type")


@query(
    "ST4, U3, K3",
    """SELECT o_orderpriority AS source, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1
       UNION ALL SELECT event_type, count(*) FROM events GROUP BY 1""",
)
def stream_refresh(spark, sf):
    o = table(spark, sf, "orders")
    old = o.filter((F.col("o_orderdate") < lit("1998-01-01").cast("timestamp_ntz")) & F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    path = shared_dir(spark)
    sinks.guarded_publish(old.select(F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("k")), path)
    rows = _events(spark, sf).select(F.col("event_type").alias("source"), F.col("event_id").alias("k"))
    _, checkpoint = wire.scratch(spark)
    wire.refresh_available(rows, path, checkpoint)
    return sinks.read_published(spark, path).groupBy("source").agg(F.count(lit(1)).alias("n"))
