"""Sorts, top-k and optional limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def impact_order() -> list:
    """Highest impact first; equal impacts keep source and row order."""
    return [F.coalesce("impact", F.lit(0)).desc(), F.col("source_ord"), F.col("row_ord")]


def newest_order(order: str = "row_ord") -> list:
    """Newest first, significant before ordinary within a day, undated last."""
    return [F.col("date").desc_nulls_last(), F.coalesce("sig", F.lit(0)).desc(), F.col(order)]


def by_impact(df: DataFrame) -> DataFrame:
    return df.orderBy(*impact_order())


def newest_first(df: DataFrame, order: str = "row_ord") -> DataFrame:
    return df.orderBy(*newest_order(order))


def numbered(df: DataFrame, order: list, name: str = "pos") -> DataFrame:
    """Position of every row in a total order, from 1.

    Rows are dealt out by ranges of the order and written to the shared folder, counted
    per range, and numbered within it; no task sees more than its range.
    """
    dealt = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    dealt = reliable_checkpoint(df.sparkSession, dealt)
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))  # one row per range
    before = sizes.select("__range", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    nth = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    out = dealt.withColumn("__nth", nth).join(F.broadcast(before), "__range")
    return out.withColumn(name, F.col("__before") + F.col("__nth")).drop("__range", "__nth", "__before")


def top_groups(df: DataFrame, by, n: int = 12, count_name: str = "n") -> DataFrame:
    """The ``n`` largest groups; equal sizes by name."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_name)).orderBy(F.desc(count_name), *by).limit(n)


def capped(df: DataFrame, n: int = 0) -> DataFrame:
    """Optional debugging cap; 0 means every row, the default."""
    return df.limit(n) if n else df
