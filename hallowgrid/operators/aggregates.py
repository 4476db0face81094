"""Run summaries and breakdowns."""

from __future__ import annotations

from pyspark.sql import Window, Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_table
from .. import vocab
from ..functions import scalar
from .ordering import top_groups


def with_roster(counts: DataFrame, roster: DataFrame, by: str, n: str = "n") -> DataFrame:
    """Counts completed with a zero row for every roster entry that has none."""
    return roster.select(by).distinct().join(counts, by, "left").withColumn(n, F.coalesce(n, F.lit(0)))


def source_yields(df: DataFrame, roster: DataFrame) -> DataFrame:
    """Rows per source, zero included."""
    counts = df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return with_roster(counts, roster, "source")


def yield_totals(yields: DataFrame) -> DataFrame:
    """(total, active, listed) of a yields table."""
    return yields.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count_if(F.col("n") > 0).alias("active"),
        F.count(F.lit(1)).alias("listed"),
    )


def breakdown(df: DataFrame, *dims: str) -> DataFrame:
    """Counts per value of each dimension and in total, in one pass: ``dim, value, n``."""
    sets = [[d] for d in dims] + [[]]
    g = df.groupingSets(sets, *dims).agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*dims).alias("__g"))
    all_ones = (1 << len(dims)) - 1
    dim = F.when(F.col("__g") == all_ones, F.lit("total"))
    value = F.when(F.col("__g") == all_ones, F.lit("total"))
    for i, d in enumerate(dims):
        bit = all_ones ^ (1 << (len(dims) - 1 - i))
        dim = dim.when(F.col("__g") == bit, F.lit(d))
        value = value.when(F.col("__g") == bit, F.coalesce(F.col(d), F.lit("?")))
    # A NULL and a literal "?" fall into the same group, as they do in the record file.
    return g.select(dim.alias("dim"), value.alias("value"), "n").groupBy("dim", "value").agg(F.sum("n").alias("n"))


def meta_row(df: DataFrame, generated: Column | None = None, kinds: dict | None = None) -> DataFrame:
    """One-row metadata of a record set: count, breakdowns, rating scale, label maps."""
    b = breakdown(df, "geo", "posture")

    def as_map(dim: str) -> Column:
        pairs = F.collect_list(F.when(F.col("dim") == dim, F.struct("value", "n")))
        return F.map_from_entries(F.array_sort(pairs))

    kinds = kinds or vocab.KINDS
    return b.agg(
        F.coalesce(F.max(F.when(F.col("dim") == "total", F.col("n"))), F.lit(0)).alias("count"),
        as_map("geo").alias("geo_breakdown"),
        as_map("posture").alias("posture_breakdown"),
    ).select(
        (generated if generated is not None else F.current_timestamp()).alias("generated"),
        "*",
        F.lit(vocab.RATING_SCALE).alias("rating_scale"),
        scalar.literal_map({k: v[0] for k, v in kinds.items()}).alias("kinds"),
        scalar.literal_map(vocab.POSTURES).alias("postures"),
    )


def news_summary(df: DataFrame) -> DataFrame:
    """Items, geo-tagged items and countries."""
    iso = scalar.blank_to_null(F.col("iso"))
    return df.agg(
        F.count(F.lit(1)).alias("items"),
        F.count(iso).alias("tagged"),
        F.count_distinct(iso).alias("countries"),
    )


def busiest_countries(df: DataFrame, n: int = 12) -> DataFrame:
    return top_groups(df.filter(scalar.blank_to_null(F.col("iso")).isNotNull()), "iso", n)


def countries_with_totals(df: DataFrame, n: int = 12) -> DataFrame:
    """The busiest countries next to the totals of :func:`news_summary`; the items are read and shuffled once."""
    counts = df.groupBy(scalar.blank_to_null(F.col("iso")).alias("iso")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(0))  # one row per country
    tagged = F.sum(F.when(F.col("iso").isNotNull(), F.col("n"))).over(whole)
    out = counts.withColumns({"items": F.sum("n").over(whole), "tagged": F.coalesce(tagged, F.lit(0)), "countries": F.count("iso").over(whole)})
    return out.filter(F.col("iso").isNotNull()).orderBy(F.desc("n"), "iso").limit(n)


def state_tally(df: DataFrame, roster: DataFrame) -> DataFrame:
    counts = df.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    return with_roster(counts, roster, "state")


def layer_manifest(df: DataFrame, threshold: int = 40_000) -> DataFrame:
    """Rows per facility type and cell, with the publish mode of the type.

    The type totals are summed from the per-cell counts, so the facilities are read
    and shuffled once.
    """
    cells = df.groupBy("ftype", "cell", "cell_lat", "cell_lng").agg(F.count(F.lit(1)).alias("n_rows"))
    totals = cells.groupBy("ftype").agg(F.sum("n_rows").alias("type_rows"), F.max("n_rows").alias("largest"))
    mode = F.when(F.col("type_rows") < threshold, "single").otherwise("tiled")
    return cells.join(totals.withColumn("mode", mode), "ftype")


def family_counts(df: DataFrame, families=vocab.NOTICE_FAMILIES) -> DataFrame:
    """Kept rows per phrase, families with none included; ``df`` has ``phrase``."""
    roster = small_table(df.sparkSession, [(i, p) for i, (p, _) in enumerate(families)], "phrase_ord int, phrase string")
    counts = df.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    return roster.join(counts, "phrase", "left").select("phrase_ord", "phrase", F.coalesce("n", F.lit(0)).alias("n"))


def unmapped_tally(df: DataFrame, key: Column, known: Column, n: int = 12) -> DataFrame:
    """Most frequent keys without a mapping; a missing key counts as ``?``."""
    lost = df.filter(~F.coalesce(known, F.lit(False)))
    return top_groups(lost.select(F.coalesce(scalar.blank_to_null(key), F.lit("?")).alias("key")), "key", n)


def holdings_rollup(df: DataFrame) -> DataFrame:
    """Returned / not returned per state and institution with sub-totals."""
    return (
        df.rollup("state", "institution")
        .agg(
            F.sum("not_available").alias("not_available"),
            F.sum("made_available").alias("made_available"),
            F.grouping_id("state", "institution").alias("level"),
        )
        .withColumn("total", F.col("not_available") + F.col("made_available"))
        .withColumn("shown", F.concat_ws(" of ", F.col("made_available").cast("string"), F.col("total").cast("string")))
    )
