"""Row shapes and tunables shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("posture", T.StringType()),
        T.StructField("trigger", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("geo", T.StringType()),
        T.StructField("count", T.IntegerType()),
        T.StructField("held_by", T.StringType()),
        T.StructField("actor", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("deadline", T.StringType()),
        T.StructField("desc", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("impact", T.IntegerType()),
        # Order columns: "the first one wins" needs an explicit order in Spark.
        T.StructField("source_ord", T.IntegerType()),
        T.StructField("row_ord", T.LongType()),
    ]
)

FACILITY = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("name", T.StringType()),
        T.StructField("website", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("ftype", T.StringType()),
        T.StructField("cell", T.StringType()),
        T.StructField("cell_lat", T.IntegerType()),
        T.StructField("cell_lng", T.IntegerType()),
        T.StructField("row_ord", T.LongType()),
    ]
)

NEWS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("sig", T.IntegerType()),
        T.StructField("snippet", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("iso", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("link_key", T.StringType()),
        T.StructField("row_ord", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Config:
    """Tunables; the defaults are the values results are compared with."""

    coarse_deg: float = 0.05
    radius_m: float = 250.0
    layer_tile_deg: int = 10
    tile_threshold: int = 40_000
    grid_step_deg: float = 2.5
    done_max_age_days: int = 14
    news_max_age_days: int = 90
    per_query: int | None = None
    preserve_min_rows: int = 10
    records_thin: int = 4
    news_thin: int = 5
    facility_ratio: float = 0.6
    exclude_individual_cases: bool = False


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order, adding typed NULLs for missing ones."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def ensure_row_ord(df: DataFrame) -> DataFrame:
    """Keep a landed ``row_ord``; otherwise derive a repeatable one from the row itself.

    Unlike ``monotonically_increasing_id`` the derived order does not depend on how
    the files were split, so a retried or re-partitioned run picks the same winner.
    """
    if "row_ord" in df.columns:
        return df
    return df.withColumn("row_ord", F.xxhash64(F.to_json(F.struct(*df.columns))))


def int_or_null(c: Column) -> Column:
    return c.try_cast("int")
