"""Location gate: records that are themselves burial locations never leave precise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo, scalar, text


def must_coarsen(kind: Column, kinds: dict | None = None) -> Column:
    """True for burial-location kinds and for every unknown or missing kind."""
    kinds = kinds or vocab.KINDS
    harmless = [k for k, v in kinds.items() if not v[2]]
    return ~F.coalesce(kind.isin(*harmless), F.lit(False))


def place(
    df: DataFrame,
    lat: Column,
    lng: Column,
    geo_level: Column,
    kinds: dict | None = None,
    step: float = 0.05,
) -> DataFrame:
    """Write ``lat``, ``lng`` and ``geo``; coarsen exact/area points of guarded kinds."""
    lat, lng = lat.cast("double"), lng.cast("double")
    placed = lat.isNotNull() & lng.isNotNull()
    blur = must_coarsen(F.col("kind"), kinds) & F.coalesce(geo_level.isin("exact", "area"), F.lit(False))

    def axis(x: Column) -> Column:
        return F.when(placed & blur, geo.snap(x, step)).when(placed, scalar.exact_round(x, 4))

    return df.withColumns(
        {"lat": axis(lat), "lng": axis(lng), "geo": F.when(placed, F.when(blur, "coarsened").otherwise(geo_level))}
    )


def audit(df: DataFrame, kinds: dict | None = None, step: float = 0.05, metric: str | Observation | None = None) -> DataFrame:
    """Re-apply the gate to finished records; idempotent.

    With ``metric`` (a name or an observation) the number of repairs is observed in the same pass.
    """
    slipped = must_coarsen(F.col("kind"), kinds) & F.coalesce(F.col("geo").isin("exact", "area"), F.lit(False))
    if metric:
        df = df.observe(metric, F.count_if(slipped).alias("coarsened"))
    return df.withColumns(
        {
            "lat": F.when(slipped, geo.snap(F.col("lat"), step)).otherwise(F.col("lat")),
            "lng": F.when(slipped, geo.snap(F.col("lng"), step)).otherwise(F.col("lng")),
            "geo": F.when(slipped, "coarsened").otherwise(F.col("geo")),
        }
    )


def label_individual_cases(
    df: DataFrame,
    exclude: bool = False,
    kinds: dict | None = None,
    single=vocab.SINGLE_CASE,
    group=vocab.GROUP_HINT,
    metric: str | Observation | None = None,
) -> DataFrame:
    """Give single-person cases their own kind; optionally drop them."""
    kinds = kinds or vocab.KINDS
    words = F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("desc", F.lit("")))
    # a column of its own: the texts are searched once, also where the cases are counted
    df = df.withColumn("__case", text.individual_case(words, single, group))
    case, kind = F.col("__case"), F.col("kind")
    relabel = case & (kind.isin("mass-grave", "discovery") | scalar.blank_to_null(kind).isNull())
    if metric:
        df = df.observe(metric, F.count_if(case).alias("tagged"))
    out = df.withColumns(
        {
            "kind": F.when(relabel, "forensic-case").otherwise(kind),
            "posture": F.when(relabel, kinds["forensic-case"][1]).otherwise(F.col("posture")),
        }
    ).drop("__case")
    return out.filter(~F.coalesce(F.col("kind") == "forensic-case", F.lit(False))) if exclude else out


def rate(df: DataFrame, floors: dict | None = None) -> DataFrame:
    return df.withColumn("impact", scalar.impact(F.col("kind"), F.col("count"), floors).cast("int"))


def only_placed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
