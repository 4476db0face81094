"""Source registry: named functions returning records, isolated from each other."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import union_in_order
from ..schema import RECORD, conform
from ..session import shared_dir, small_table


class Registry:
    """Sources in roster order.  Adding one is one call; order is part of the result."""

    def __init__(self) -> None:
        self._sources: dict[str, Callable[[SparkSession], DataFrame]] = {}

    def register(self, name: str, fn: Callable[[SparkSession], DataFrame] | None = None):
        if fn is None:
            return lambda f: self.register(name, f)
        self._sources[name] = fn
        return fn

    def names(self) -> list[str]:
        return list(self._sources)

    def roster(self, spark: SparkSession) -> DataFrame:
        rows = [(n, i) for i, n in enumerate(self._sources)]
        return small_table(spark, rows, "source string, source_ord int")

    def plan(self, spark: SparkSession) -> DataFrame:
        """All sources as one lazy union."""
        return union_in_order([conform(fn(spark), RECORD) for fn in self._sources.values()])

    def run_isolated(self, spark: SparkSession, at_once: int = 6) -> tuple[DataFrame, DataFrame]:
        """Stage each source as its own job; a failing source is recorded and skipped.

        Up to ``at_once`` jobs are submitted together, so a source waiting for its last
        task leaves no executor idle; the result keeps roster order.  Returns (records,
        status).  Staging goes to the shared folder, so a lost executor costs a retry of
        its tasks and nothing is recomputed downstream.
        """
        base = shared_dir(spark)

        def stage(entry) -> tuple:
            i, (name, fn) = entry
            try:
                rows = conform(fn(spark), RECORD).withColumn("source_ord", F.lit(i).cast("int"))
                rows.write.parquet(f"{base}/{i:03d}")
                return (name, i, True, None)
            except Exception as e:  # noqa: BLE001 - isolation is the point
                return (name, i, False, str(e).split("\n")[0][:300])

        with ThreadPoolExecutor(at_once) as pool:
            status = list(pool.map(stage, enumerate(self._sources.items())))
        staged = [f"{base}/{i:03d}" for _, i, ok, _ in status if ok]
        records = spark.read.schema(RECORD).parquet(*staged) if staged else spark.createDataFrame([], RECORD)
        return records, small_table(spark, status, "source string, source_ord int, ok boolean, error string")
