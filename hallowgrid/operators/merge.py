"""Unions of sources and runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import silent_source_rows


def union_in_order(frames) -> DataFrame:
    """Union of sources, each stamped with its place in the roster."""
    stamped = [df.withColumn("source_ord", F.lit(i).cast("int")) for i, df in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stamped)


#: Carried rows rank behind all fresh ones, whatever place their source had.
CARRIED = 1_000_000


def behind(prior: DataFrame) -> DataFrame:
    """Prior rows with their place in the roster moved behind all fresh rows; their own order stays."""
    if "source_ord" not in prior.columns:
        return prior
    return prior.withColumn("source_ord", (F.pmod(F.coalesce("source_ord", F.lit(0)), F.lit(CARRIED)) + CARRIED).cast("int"))


def carry_forward(fresh: DataFrame, prior: DataFrame, keep: Column) -> DataFrame:
    """Fresh rows plus the prior rows that ``keep`` selects; a deduplication picks fresh rows first."""
    return fresh.unionByName(behind(prior.filter(F.coalesce(keep, F.lit(False)))), allowMissingColumns=True)


def preserve_silent(fresh: DataFrame, prior: DataFrame, min_rows: int = 10, by: str = "source") -> DataFrame:
    """A source that returned nothing keeps its prior rows, if it had enough of them."""
    return fresh.unionByName(silent_source_rows(prior, fresh, min_rows, by), allowMissingColumns=True)


def merge_parts(parts: DataFrame, prior: DataFrame, federation) -> DataFrame:
    """Shard parts plus prior rows of other sources; with no parts at all the prior
    federation rows stay.  Decided inside the plan, without counting first."""
    prior = behind(prior)
    fed = F.coalesce(F.col("source").isin(*federation), F.lit(False))
    return parts.unionByName(prior.filter(~fed | ~parts.limit(1).exists()), allowMissingColumns=True)


def union_states(frames) -> DataFrame:
    """Distinct union of refresh-state tables."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def shard_of(ord_col: Column, n: int) -> Column:
    """Shard of a row in a deterministic n-way split by its order column."""
    return F.pmod(ord_col, F.lit(n))


def shard(df: DataFrame, ord_col: Column, k: int, n: int) -> DataFrame:
    """One shard of that split."""
    return df.filter(shard_of(ord_col, n) == k)
