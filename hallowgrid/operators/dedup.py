"""First-wins and last-wins deduplication, and per-group limits.

Winners are picked by ``min_by``/``max_by`` aggregation: every map task sends at most
one row per key, so a key that holds a third of all rows is reduced before the
shuffle.  A ``row_number`` window would send the whole hot group to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar

RECORD_ORDER = ("source_ord", "row_ord")


def _tiebreak(df: DataFrame, order) -> Column:
    """Given order first; then the row's hash, so equal ranks still pick repeatably."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    hashable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.struct(*cols, F.xxhash64(*[F.col(f"`{h}`") for h in hashable]))


def _pick(df: DataFrame, keys, order, chooser) -> DataFrame:
    named = {f"__k{i}": (F.col(k) if isinstance(k, str) else k) for i, k in enumerate(keys)}
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    picked = (
        df.select(row.alias("__row"), _tiebreak(df, order).alias("__ord"), *[v.alias(k) for k, v in named.items()])
        .groupBy(*named)
        .agg(chooser("__row", "__ord").alias("__row"))
    )
    return picked.select("__row.*")


def first_wins(df: DataFrame, keys, order=RECORD_ORDER) -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys, order) -> DataFrame:
    return _pick(df, keys, order, F.max_by)


def dedup_records(df: DataFrame, extra_keys=(), order=RECORD_ORDER, name_chars: int | None = None) -> DataFrame:
    """One record per 3-decimal point and name; ``name_chars`` compares so many leading characters only."""
    name = F.lower(scalar.strip(F.coalesce("name", F.lit(""))))
    name = F.left(name, F.lit(name_chars)) if name_chars else name
    keys = [scalar.decimal_key(F.col("lat"), 3), scalar.decimal_key(F.col("lng"), 3), name]
    return first_wins(df, keys + list(extra_keys), order)


def dedup_facilities(df: DataFrame, order=("row_ord",), by=()) -> DataFrame:
    """One facility per 4-decimal point (per ``by``, e.g. the facility type)."""
    keys = [scalar.decimal_key(F.col("lat"), 4), scalar.decimal_key(F.col("lng"), 4)]
    return first_wins(df, list(by) + keys, order)


def dedup_news(df: DataFrame, order=("row_ord",)) -> DataFrame:
    """One item per link; items without a link are dropped."""
    linked = df.filter(scalar.blank_to_null(F.col("link")).isNotNull())
    return first_wins(linked.withColumn("link_key", scalar.link_key(F.col("link"))), ["link_key"], order)


def first_n(df: DataFrame, by, order, n: int) -> DataFrame:
    """First ``n`` rows per group.

    Spark pushes the rank limit below the exchange (window group limit), so a hot
    group is cut to ``n`` rows per map task before it is shuffled.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
