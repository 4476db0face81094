"""Registration of queries, and the stand-in columns they share.

The supplied tables hold no coordinates and invented text, so coordinates, kinds and
phrases are derived from keys by integer arithmetic, the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ... import vocab
from ...session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(covers: str, sql: str | None = None):
    """Register a query under its function name."""

    def add(fn):
        name = fn.__name__
        QUERIES[name] = fn
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


# --- the same expression for Spark and for DuckDB ----------------------------------------
def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pick(options, key: Column) -> Column:
    opts = F.array(*[F.lit(o) for o in options])
    return F.element_at(opts, (F.pmod(key, F.lit(len(options))) + 1).cast("int"))


def q_pick(options, key: str) -> str:
    items = ", ".join(quoted(o) if isinstance(o, str) else repr(o) for o in options)
    return f"list_extract([{items}], CAST((({key}) % {len(options)}) + 1 AS BIGINT))"


def lat(key: Column) -> Column:
    return F.pmod(key * 7919, F.lit(14400)).cast("double") / 100 - 60


def lng(key: Column) -> Column:
    return F.pmod(key * 104729, F.lit(36000)).cast("double") / 100 - 180


def q_lat(key: str) -> str:
    return f"(CAST((({key}) * 7919) % 14400 AS DOUBLE) / 100 - 60)"


def q_lng(key: str) -> str:
    return f"(CAST((({key}) * 104729) % 36000 AS DOUBLE) / 100 - 180)"


def q_num(x: float) -> str:
    return f"({x!r}::DOUBLE)"


def q_snap(x: str, g: str = "0.05::DOUBLE") -> str:
    m = f"(({x}) % ({g}))"
    return f"round((round(({x} - {m}) / ({g})) - CASE WHEN {m} < 0 THEN 1 ELSE 0 END) * ({g}) + ({g}) / 2, 4)"


KIND_NAMES = [*vocab.KINDS, "unlisted"]
GEO_LEVELS = ["exact", "area", "admin"]
COARSE_KINDS = [k for k, v in vocab.KINDS.items() if v[2]] + ["unlisted"]
STATE_NAMES = [s[1] for s in vocab.STATES]
STATE_CODES = [s[0] for s in vocab.STATES]
CITIES = ["Akron", "Boise", "Camden", "Dover", "Elko", "Fargo", "Galena", "Hilo"]


def q_in(names) -> str:
    return "(" + ", ".join(quoted(n) for n in names) + ")"


def q_case(mapping: dict, key: str, other: str = "NULL") -> str:
    def lit(v):
        return quoted(v) if isinstance(v, str) else repr(v)

    whens = " ".join(f"WHEN {quoted(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {key} {whens} ELSE {other} END"


Q_STATES = (
    "(VALUES "
    + ", ".join(f"({quoted(a)}, {quoted(n)}, {q_num(y)}, {q_num(x)})" for a, n, y, x in vocab.STATES)
    + ") AS st(abbr, state, slat, slng)"
)
Q_IMPACT = (
    "CAST(greatest(1, least(5, greatest({floor}, CASE WHEN {n} IS NULL OR {n} = 0 THEN 0 "
    "WHEN {n} >= 500 THEN 5 WHEN {n} >= 100 THEN 4 WHEN {n} >= 20 THEN 3 WHEN {n} >= 5 THEN 2 ELSE 1 END))) AS INTEGER)"
)


def q_impact(kind: str, n: str) -> str:
    floor = q_case(vocab.KIND_FLOOR, kind, "2")
    return Q_IMPACT.format(floor=floor, n=n)


# --- orders as raw records ------------------------------------------------------------------
def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    kind = pick(KIND_NAMES, cust + F.pmod(key, F.lit(2)))
    return o.select(
        F.concat(F.lit("Decision "), F.pmod(key, F.lit(4)).cast("string")).alias("name"),
        kind.alias("kind"),
        F.element_at(F.create_map(*[F.lit(x) for k in KIND_NAMES for x in (k, vocab.KINDS.get(k, ("", "watch"))[1])]), kind).alias("posture"),
        lat(cust).alias("raw_lat"),
        F.when(F.pmod(key, F.lit(50)) != 7, lng(cust)).alias("raw_lng"),
        pick(GEO_LEVELS, key).alias("geo_level"),
        F.nullif(F.pmod(key * 31, F.lit(700)), F.lit(0)).cast("int").alias("count"),
        F.col("o_orderpriority").alias("source"),
        F.lit(None).cast("string").alias("desc"),
        F.lit(0).alias("source_ord"),
        key.alias("row_ord"),
    )


Q_RAW = f"""raw AS (
  SELECT 'Decision ' || (o_orderkey % 4) AS name,
         {q_pick(KIND_NAMES, "o_custkey + o_orderkey % 2")} AS kind,
         {q_lat("o_custkey")} AS y,
         CASE WHEN o_orderkey % 50 <> 7 THEN {q_lng("o_custkey")} END AS x,
         {q_pick(GEO_LEVELS, "o_orderkey")} AS geo_level,
         CAST(nullif((o_orderkey * 31) % 700, 0) AS INTEGER) AS cnt,
         o_orderpriority AS source, o_orderkey AS row_ord
  FROM orders)"""
Q_PLACED = f"""{Q_RAW}, placed AS (
  SELECT name, kind, source, cnt, row_ord,
         {q_case({k: vocab.KINDS.get(k, ("", "watch"))[1] for k in KIND_NAMES}, "kind")} AS posture,
         CASE WHEN y IS NULL OR x IS NULL THEN NULL WHEN kind IN {q_in(COARSE_KINDS)} AND geo_level IN ('exact', 'area')
              THEN {q_snap("y")} ELSE round(y, 4) END AS lat,
         CASE WHEN y IS NULL OR x IS NULL THEN NULL WHEN kind IN {q_in(COARSE_KINDS)} AND geo_level IN ('exact', 'area')
              THEN {q_snap("x")} ELSE round(x, 4) END AS lng,
         CASE WHEN y IS NULL OR x IS NULL THEN NULL WHEN kind IN {q_in(COARSE_KINDS)} AND geo_level IN ('exact', 'area')
              THEN 'coarsened' ELSE geo_level END AS geo,
         {q_impact("kind", "cnt")} AS impact
  FROM raw)"""
Q_KEY3 = "CAST(floor(lat * 1000 + 0.5) AS BIGINT), CAST(floor(lng * 1000 + 0.5) AS BIGINT), lower(trim(name))"
Q_DEDUPED = f"""{Q_PLACED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {Q_KEY3} ORDER BY row_ord) AS rn FROM placed WHERE lat IS NOT NULL AND lng IS NOT NULL),
  deduped AS (SELECT * FROM ranked WHERE rn = 1)"""
