"""Row counts of a job, taken while its rows are written."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Counts observed along one job; they are known once the job has written its rows.

    Observing adds no job and no shuffle, but a filter above is not pushed below it.
    """

    def __init__(self) -> None:
        self._parts: list[Observation] = []

    def part(self) -> Observation:
        """Where a step puts its counts."""
        self._parts.append(Observation(f"counts-{uuid.uuid4().hex}"))
        return self._parts[-1]

    def count(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """``df`` with the number of rows that meet each condition."""
        return df.observe(self.part(), *[F.count_if(c).alias(n) for n, c in conditions.items()])

    def values(self) -> dict[str, int]:
        return {name: n for part in self._parts for name, n in part.get.items()}
