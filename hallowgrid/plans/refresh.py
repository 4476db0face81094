"""End-to-end jobs: daily refresh, facility layer, news wire, link check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, small_table
from .. import vocab
from ..operators.counters import Counters
from ..operators import dedup, gate, grid, joins, merge, ordering, spatial
from ..schema import NEWS, Config, conform
from ..sources import normalise, sinks


def finish(records: DataFrame, cfg: Config = Config(), extra_keys=(), counters: Counters | None = None) -> DataFrame:
    """Placed rows -> labelled -> audited -> deduplicated.

    One shuffle in all (the deduplication); everything before it is row-local.  ``counters`` get the rows ``read``,
    the ``unplaced`` ones refused, and those ``tagged`` as single cases and ``coarsened`` by the audit.
    """
    part = counters.part if counters else (lambda: None)
    if counters:
        records = counters.count(records, read=F.lit(True), unplaced=F.col("lat").isNull() | F.col("lng").isNull())
    d = gate.only_placed(records)
    d = gate.label_individual_cases(d, cfg.exclude_individual_cases, metric=part())
    d = gate.audit(d, step=cfg.coarse_deg, metric=part())
    return dedup.dedup_records(d, extra_keys)


def daily(
    records: DataFrame,
    prior: DataFrame | None,
    cfg: Config = Config(),
    carry: Column | None = None,
    stage: bool = False,
    counters: Counters | None = None,
) -> DataFrame:
    """Fresh records plus carried and preserved prior rows, ready to publish.

    The fresh records are read twice, once only for the names of their sources.  With
    ``stage`` they are written to the shared folder first, so that neither reading nor
    a lost executor runs the source plans again.
    """
    keep = F.col("source").isin(*vocab.FEDERATION_SOURCES) if carry is None else carry
    fresh = finish(records if prior is None else merge.carry_forward(records, prior, keep), cfg, counters=counters)
    if prior is None:
        return fresh
    if stage:
        fresh = reliable_checkpoint(records.sparkSession, fresh)
    return merge.preserve_silent(fresh, prior, cfg.preserve_min_rows)


def publish_daily(spark: SparkSession, records: DataFrame, path: str, cfg: Config = Config()) -> sinks.Outcome:
    prior = sinks.read_published(spark, path)
    counters = Counters()
    rows = ordering.by_impact(daily(records, prior, cfg, stage=True, counters=counters))
    return sinks.publish_records(rows, path, cfg.records_thin, counters)


def federation_merge(spark: SparkSession, parts: DataFrame, path: str, cfg: Config = Config()) -> sinks.Outcome:
    prior = sinks.read_published(spark, path)
    items = parts if prior is None else merge.merge_parts(parts, prior, vocab.FEDERATION_SOURCES)
    counters = Counters()
    return sinks.publish_records(finish(items, cfg, counters=counters), path, cfg.records_thin, counters)


def facility_layer(elements: DataFrame, path: str, cfg: Config = Config()) -> sinks.Outcome:
    counters = Counters()
    rows = normalise.facilities(counters.count(elements, read=F.lit(True)), counters.part(), cfg.layer_tile_deg)
    unique = dedup.dedup_facilities(rows, by=("ftype",))
    return sinks.publish_layer(unique, path, cfg.facility_ratio, cfg.tile_threshold, cfg.layer_tile_deg, counters)


def projects_on_grounds(projects: DataFrame, layer: DataFrame, cfg: Config = Config(), feed: str = "the projects feed") -> DataFrame:
    """Projects within the radius of a cemetery of the (tiled) layer."""
    grounds = layer.filter(F.col("ftype") == "cemetery").select("lat", "lng", F.coalesce("name", F.lit("")).alias("name"))
    return normalise.projects_near_grounds(spatial.nearest_within(projects, grounds, cfg.radius_m), feed)


def news_wire(entries: DataFrame, gazetteer: DataFrame, cfg: Config = Config(), today: Column | None = None) -> DataFrame:
    """Feed entries to the ordered wire; with ``per_query`` at most so many per query, in feed order."""
    if cfg.per_query and "query" in entries.columns:
        entries = dedup.first_n(entries, ["query"], ["row_ord"], cfg.per_query)
    items = normalise.news(entries, gazetteer, today=today, max_age_days=cfg.news_max_age_days)
    return ordering.newest_first(conform(dedup.dedup_news(items), NEWS))


def publish_wire(items: DataFrame, path: str, cfg: Config = Config()) -> sinks.Outcome:
    return sinks.guarded_publish(items, path, min_rows=cfg.news_thin, name="wire")


def refresh_plan(spark: SparkSession, state: DataFrame, rotation: int, cfg: Config = Config(), k: int = 0, n: int = 1) -> DataFrame:
    """Tiles one shard has to recompute now."""
    tiles = merge.shard(grid.world_tiles(spark, cfg.grid_step_deg), F.col("ord"), k, n)
    keyed = tiles.withColumn("tile_key", grid.tile_key(F.col("s"), F.col("w")))
    return grid.cells_to_refresh(keyed, state, rotation, max_age_days=cfg.done_max_age_days)


def link_report(probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    states = small_table(probes.sparkSession, [(s,) for s in vocab.LINK_STATES], "state string")
    return sinks.link_status(probes, states)


def triage(spark: SparkSession, yields: DataFrame, keys_set: DataFrame | None = None) -> DataFrame:
    roster = small_table(spark, list(vocab.ROSTER), "source string, reason string")
    return joins.zero_triage(roster, yields, keys_set)
